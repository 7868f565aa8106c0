"""From project selection to chart counts per (location, provider)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeel.functions.dates import effective_date
from goldkeel.functions.labels import RETRIEVAL_SUMMARY, retrieval_type
from goldkeel.functions.text import (
    DEFAULT_RULES,
    TextRules,
    address_lines,
    cleanse_phone,
    piped_address,
    piped_full_address,
    spaced_address,
)
from goldkeel.operators.groups import (
    HOT_ROWS,
    broadcast_if_small,
    counted,
    first_per_group,
    join_on_unique,
)
from goldkeel.operators.pruning import WORDS, pruned

# Codes of a released, quality-passed, not replicated chart.
DISPOSITION = "QAP"
STATUS = "REL"
REPLICA = "Replication"

PAIR = ["Location__c", "Provider__c"]
NO_TYPE = "\0"  # stands for a missing appointment type or location, which groups like any other
MAX_BROADCAST_PROJECTS = 100_000
MAX_BROADCAST_LINKS = 500_000


def select_projects(
    provider: DataFrame,
    project: str | None = None,
    client: str | None = None,
    client_like: str | None = None,
    project_like: str | None = None,
    rules: TextRules = DEFAULT_RULES,
) -> DataFrame:
    """(client, project, number of provider rows) of the chosen projects."""
    client_col, project_col = F.col("Client_Name__c"), F.col("Project_Name__c")
    chosen = provider.select(client_col, project_col)
    if project is not None:
        chosen = chosen.where(rules.equals(project_col, project))
    if client is not None:
        chosen = chosen.where(rules.equals(client_col, client))
    if client_like is not None:
        chosen = chosen.where(rules.like(client_col, client_like))
    if project_like is not None:
        chosen = chosen.where(rules.like(project_col, project_like))
    names = ["Client_Name__c", "Project_Name__c"]
    return counted(chosen, names, rules.keys(names), "count_recs")


def provider_locations(
    projects: DataFrame,
    junction: DataFrame,
    rules: TextRules = DEFAULT_RULES,
    max_broadcast_projects: int = MAX_BROADCAST_PROJECTS,
) -> DataFrame:
    """One junction row per (location, provider): the earliest modified."""
    names = projects.select(rules.key(F.col("Project_Name__c")).alias("_project")).distinct()
    links = junction.select(
        *PAIR, "CreatedDate", "LastModifiedDate", rules.key(F.col("Project_Name__c")).alias("_project")
    )
    links = links.join(broadcast_if_small(names, max_broadcast_projects), "_project", "left_semi").drop("_project")
    # Smallest (modified, created) per pair, NULL first, in two steps that both
    # aggregate by hash: copies of a pair shrink within map tasks, unsorted.
    dated = links.groupBy(*PAIR, "LastModifiedDate").agg(_least_or_null(F.col("CreatedDate")).alias("_created"))
    blank = F.col("LastModifiedDate").isNull()
    first = dated.groupBy(*PAIR).agg(
        F.max(blank).alias("_blank"),
        F.max(F.when(blank, F.col("_created"))).alias("_of_blank"),
        F.min("LastModifiedDate").alias("_modified"),
        F.min_by("_created", "LastModifiedDate").alias("_of_modified"),
    )
    modified = F.when(~F.col("_blank"), F.col("_modified"))
    created = F.when(F.col("_blank"), F.col("_of_blank")).otherwise(F.col("_of_modified"))
    return first.select(*PAIR, effective_date(modified, created).alias("plj_record_date"))


def _least_or_null(col: Column) -> Column:
    """The smallest value of a group, NULL counting as smaller than any."""
    return F.when(F.max(col.isNull()), F.lit(None)).otherwise(F.min(col))


def contact_keys(provider: DataFrame, strip_country: bool = False) -> DataFrame:
    """Provider rows with address and phone forms used for matching."""
    line1, line2 = F.col("Address_Line_1__c"), F.col("Address_Line_2__c")
    city, state, zip_code = F.col("City__c"), F.col("State__c"), F.col("ZIP_Code__c")
    first, second = F.col("Phone_Number__c"), F.col("Secondary_Phone_Number__c")

    def clean(phone: Column) -> Column:
        return cleanse_phone(phone, strip_country)

    return provider.select(
        F.col("Id").alias("Provider__c"),
        "NPI__c",
        "TIN_ID__c",
        "Provider_Full_Address__c",
        "Provider_Full_Address_With_Suite__c",
        line1.alias("Address_Line"),
        line2.alias("Address_Line_Suite"),
        address_lines(line1, line2).alias("Address_With_Suite"),
        city,
        state,
        zip_code,
        spaced_address(line1, line2, city, state, zip_code).alias("full_address"),
        clean(F.coalesce(first, second)).alias("Phone_Number_Select"),
        clean(first).alias("Phone_Number_1"),
        clean(second).alias("Phone_Number_2"),
        clean(F.col("Fax_Number__c")).alias("Fax_Number__c"),
    )


def passing_charts(
    charts: DataFrame,
    disposition: str = DISPOSITION,
    status: str = STATUS,
    exclude_mrt: str = REPLICA,
    rules: TextRules = DEFAULT_RULES,
) -> DataFrame:
    """Charts with the wanted codes; a chart without retrieval name drops out."""
    return charts.where(
        rules.equals(F.col("FileBound_Disposition_Code__c"), disposition)
        & rules.equals(F.col("FileBound_Status__c"), status)
        & rules.differs(F.col("MRT_Name__c"), exclude_mrt)
    )


def linked_charts(
    links: DataFrame,
    charts: DataFrame,
    disposition: str = DISPOSITION,
    status: str = STATUS,
    exclude_mrt: str = REPLICA,
    rules: TextRules = DEFAULT_RULES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Passing chart rows of the linked (location, provider) pairs."""
    chart_rows = passing_charts(charts, disposition, status, exclude_mrt, rules).select(
        *PAIR,
        F.col("Id").alias("chart_id"),
        effective_date(F.col("LastModifiedDate"), F.col("CreatedDate")).alias("chart_date"),
        "MRT_Name__c",
        "Appointment_Type__c",
    )
    return join_on_unique(chart_rows, links, PAIR, hot_rows)


def qualifying_charts(
    links: DataFrame,
    charts: DataFrame,
    provider: DataFrame,
    disposition: str = DISPOSITION,
    status: str = STATUS,
    exclude_mrt: str = REPLICA,
    rules: TextRules = DEFAULT_RULES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Linked chart rows with the contact fields of their provider."""
    with_contact = links.join(contact_keys(provider), "Provider__c")
    return linked_charts(with_contact, charts, disposition, status, exclude_mrt, rules, hot_rows)


def classify_retrieval(charts: DataFrame, rules: TextRules = DEFAULT_RULES) -> DataFrame:
    """Add ``Retreival_type``, the way the chart came in."""
    # The folded name is a column of its own: computed once, tested many times.
    named = charts.withColumn("_name", rules.folded(F.col("MRT_Name__c")))
    return named.withColumn("Retreival_type", retrieval_type(F.col("_name"), rules)).drop("_name")


def pair_counts(
    links: DataFrame,
    charts: DataFrame,
    provider: DataFrame,
    disposition: str = DISPOSITION,
    status: str = STATUS,
    exclude_mrt: str = REPLICA,
    rules: TextRules = DEFAULT_RULES,
    max_broadcast_links: int | None = None,
    filter_words: int = WORDS,
) -> DataFrame:
    """Qualifying charts counted per (location, provider), with its match keys.

    Nearly everything downstream is constant within such a pair, so charts are
    scanned once and counted before any join. For the links of a few projects
    give ``max_broadcast_links`` and staged links: charts of other pairs are
    left out before they are classified or move, all of them if there are no
    more links than that, most of them by a filter of at most ``filter_words``
    words if there are.
    """
    passing = passing_charts(charts, disposition, status, exclude_mrt, rules).select(*PAIR, "Id", "MRT_Name__c")
    if max_broadcast_links is not None:
        passing = pruned(passing, links, PAIR, max_broadcast_links, filter_words)
    typed = classify_retrieval(passing, rules)
    per_pair = typed.groupBy(*PAIR).agg(
        F.count("Id").alias("chart_count"),
        *[
            F.count(F.when(F.col("Retreival_type") == label, 1)).alias(f"charts_retreived_via_{name}")
            for label, name in RETRIEVAL_SUMMARY
        ],
    )
    line1, line2 = F.col("Address_Line_1__c"), F.col("Address_Line_2__c")
    city, state, zip_code = F.col("City__c"), F.col("State__c"), F.col("ZIP_Code__c")
    suite = F.col("Provider_Full_Address_With_Suite__c")
    keys = provider.select(
        F.col("Id").alias("Provider__c"),
        "NPI__c",
        "TIN_ID__c",
        "Phone_Number__c",
        piped_full_address(suite, city, state, zip_code).alias("FULL_ADDRESS"),
        rules.key(F.col("NPI__c")).alias("key_npi"),
        rules.key(F.col("TIN_ID__c")).alias("key_tin"),
        rules.key(piped_address(line1, line2, city, state, zip_code)).alias("key_address"),
        rules.key(piped_full_address(suite, city, state, zip_code)).alias("key_full_address"),
        rules.key(F.coalesce(F.col("Phone_Number__c"), F.col("Secondary_Phone_Number__c"))).alias("key_phone"),
    )
    return links.join(per_pair, PAIR).join(keys, "Provider__c")


def retrieval_summary(pairs: DataFrame) -> DataFrame:
    """Per location: charts, the most frequent retrieval type, count per type."""
    names = [name for _, name in RETRIEVAL_SUMMARY]
    columns = [f"charts_retreived_via_{name}" for name in names]
    totals = pairs.groupBy("Location__c").agg(
        F.sum("chart_count").alias("charts_at_loc"), *[F.sum(c).alias(c) for c in columns]
    )
    most = F.greatest(*columns)
    best = F.coalesce(*[F.when(F.col(c) == most, name) for c, name in zip(columns, names)])
    return totals.select("Location__c", "charts_at_loc", best.alias("Best_Retreival_Type"), *columns)


def appointment_counts(
    rows: DataFrame, rules: TextRules = DEFAULT_RULES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Chart rows with the rows at their location and the charts of their
    appointment type there.

    Rows are counted per location and type, and these few counts summed to
    locations; both are attached to the rows by one join. Rows of hot
    locations meet theirs by broadcast. Rows without a location share one.
    """
    place = F.coalesce(F.col("Location__c").cast("string"), F.lit(NO_TYPE))
    kind = F.coalesce(rules.key(F.col("Appointment_Type__c")), F.lit(NO_TYPE))
    typed = rows.withColumns({"_place": place, "_type": kind})
    keys = ["_place", "_type"]
    per_type = typed.groupBy(*keys).agg(
        F.count("chart_id").alias("countOfChartsAtLocationbyAppointmentType"), F.count("Provider__c").alias("_rows")
    )
    per_location = per_type.groupBy("_place").agg(F.sum("_rows").alias("provider_charts_at_loc"))
    totals = per_type.drop("_rows").join(per_location, "_place")
    return join_on_unique(typed, totals, keys, hot_rows).select(*rows.columns, *totals.columns[2:])


def first_row_per_location(rows: DataFrame) -> DataFrame:
    """One chart row per location, by earliest link date."""
    return first_per_group(rows, ["Location__c"], {"plj_record_date": F.col("plj_record_date").asc_nulls_first()})


def latest_chart_per_pair(rows: DataFrame) -> DataFrame:
    """One chart row per (location, provider), the latest chart."""
    return first_per_group(rows, PAIR, {"chart_date": F.col("chart_date").desc_nulls_last()})


def sorted_report(df: DataFrame, order: Sequence[str | int | Column]) -> DataFrame:
    """Order a final report, ascending, by column names or 1-based positions;
    by a negative position or a name after ``-``, descending; or by an
    expression with the direction it has."""
    return df.orderBy(*[_ordering(df, o) for o in order])


def _ordering(df: DataFrame, by: str | int | Column) -> Column:
    if isinstance(by, Column):
        return by
    if isinstance(by, int):
        by = ("-" if by < 0 else "") + df.columns[abs(by) - 1]
    return F.col(by[1:]).desc() if by.startswith("-") else F.col(by).asc()
