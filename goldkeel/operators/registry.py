"""Providers against the public NPI registry and the deactivation list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeel.functions.labels import DEACTIVATED, NO_RECORD
from goldkeel.functions.labels import npi_status as npi_status_label
from goldkeel.functions.text import DEFAULT_RULES, TextRules, display_phone
from goldkeel.operators.groups import HOT_ROWS, counted, first_per_group, join_on_unique

INACTIVE = "Inactive"
TAXONOMY_GROUPS = [f"Healthcare_Provider_Taxonomy_Group_{i}" for i in range(1, 16)]


def npi_status(registry: DataFrame, missing: str = DEACTIVATED) -> DataFrame:
    """Registry rows with Individual, Organization or the ``missing`` label."""
    return registry.withColumn("Status_of_npi", npi_status_label(F.col("Entity_Type_Code"), missing))


def _active(provider: DataFrame, rules: TextRules) -> DataFrame:
    return provider.where(rules.differs(F.col("Project_status__c"), INACTIVE) & F.col("NPI__c").isNotNull())


def _of_project(provider: DataFrame, project: str | None, client: str | None, rules: TextRules) -> DataFrame:
    if project is not None:
        provider = provider.where(rules.equals(F.col("Project_Name__c"), project))
    if client is not None:
        provider = provider.where(rules.equals(F.col("Client_Name__c"), client))
    return provider


def _on_npi(provider: DataFrame, registry: DataFrame, rules: TextRules, hot_rows: int) -> DataFrame:
    """Provider rows with an NPI meet their registry row."""
    return join_on_unique(
        provider.withColumn("_npi", rules.key(F.col("NPI__c"))),
        registry.withColumn("_npi", rules.key(F.col("NPI"))),
        ["_npi"],
        hot_rows,
    ).drop("_npi")


def provider_registry_view(
    provider: DataFrame,
    registry: DataFrame,
    deactivation: DataFrame,
    missing: str = DEACTIVATED,
    dedupe_deactivations: bool = False,
    rules: TextRules = DEFAULT_RULES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Providers found in the registry, with status, taxonomy and the
    deactivation entry if any. A list that repeats an NPI repeats its rows
    unless ``dedupe_deactivations`` is set."""
    listed = deactivation.groupBy(rules.key(F.col("NPI")).alias("_listed")).agg(
        F.min("NPI").alias("deactivated_npi"), F.count(F.lit(1)).alias("_copies")
    )
    known = registry.select(
        F.col("NPI").alias("npi_npi"),
        rules.key(F.col("NPI")).alias("_npi"),
        F.col("Healthcare_Provider_Taxonomy_Group_1").alias("Taxonomy_GRP1"),
        F.col("Healthcare_Provider_Taxonomy_Group_2").alias("Taxonomy_Grp2"),
        F.col("Healthcare_Provider_Taxonomy_Code_1").alias("Taxonomy_code1"),
        F.col("Healthcare_Provider_Taxonomy_Code_2").alias("Taxonomy_code2"),
        npi_status_label(F.col("Entity_Type_Code"), missing).alias("Status_of_npi"),
    )
    known = known.join(listed, F.col("_npi") == F.col("_listed"), "left").drop("_listed")
    people = provider.select(
        F.col("NPI__c").alias("provider_npi"),
        rules.key(F.col("NPI__c")).alias("_npi"),
        "Project_Name__c",
        "Client_Name__c",
        "Full_Name__c",
        "Provider_Full_Address_With_Suite__c",
        "Phone_Number__c",
        "Fax_Number__c",
        "Secondary_Phone_Number__c",
        "City__c",
        "State__c",
        "ZIP_Code__c",
        "Provider_Specialty__c",
    )
    view = join_on_unique(people, known, ["_npi"], hot_rows).drop("_npi")
    if not dedupe_deactivations:
        copies = F.when(F.col("_copies") > 1, F.col("_copies")).otherwise(1).cast("int")
        view = view.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
    return view.drop("_copies")


def one_per_client_npi(view: DataFrame, rules: TextRules = DEFAULT_RULES) -> DataFrame:
    """One row per (client, NPI), the smallest over all columns in order."""
    keys = ["Client_Name__c", "npi_npi"]
    return first_per_group(view, keys, {}, rules.keys(keys))


def one_per_client_project(rows: DataFrame, rules: TextRules = DEFAULT_RULES) -> DataFrame:
    """One row per (client, project), the smallest over all columns in order."""
    keys = ["Client_Name__c", "Project_Name__c"]
    return first_per_group(rows, keys, {}, rules.keys(keys))


def status_summary(
    view: DataFrame, exclude_client: str | None = None, rules: TextRules = DEFAULT_RULES
) -> DataFrame:
    """Rows per (project, client, status)."""
    if exclude_client is not None:
        view = view.where(rules.differs(F.col("Client_Name__c"), exclude_client))
    by = ["Project_Name__c", "Client_Name__c", "Status_of_npi"]
    return counted(view, by, rules.keys(by[:2]), "count_recs")


def providers_without_entity(
    provider: DataFrame,
    registry: DataFrame,
    project: str | None = None,
    client: str | None = None,
    rules: TextRules = DEFAULT_RULES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """NPI of every provider row whose registry entry has no entity code."""
    people = _of_project(provider, project, client, rules).select("NPI__c")
    blank = registry.where(F.col("Entity_Type_Code").isNull()).select("NPI")
    return _on_npi(people, blank, rules, hot_rows).select("NPI__c")


def deactivated_in_project(
    provider: DataFrame,
    registry: DataFrame,
    deactivation: DataFrame,
    project: str | None = None,
    client: str | None = None,
    rules: TextRules = DEFAULT_RULES,
) -> DataFrame:
    """How many of those rows the deactivation list confirms, as one number.

    All three inputs are counted per NPI first, so no join has a hot key.
    """

    def per_npi(df: DataFrame, npi: str, name: str) -> DataFrame:
        key = rules.key(F.col(npi)).alias("_npi")
        return df.where(F.col(npi).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))

    people = per_npi(_of_project(provider, project, client, rules), "NPI__c", "_rows")
    blank = per_npi(registry.where(F.col("Entity_Type_Code").isNull()), "NPI", "_entries")
    listed = per_npi(deactivation, "NPI", "_listed")
    product = F.col("_rows") * F.col("_entries") * F.col("_listed")
    return people.join(blank, "_npi").join(listed, "_npi").agg(F.coalesce(F.sum(product), F.lit(0)).alias("count_npi"))


def provider_vs_registry_address(
    provider: DataFrame,
    registry: DataFrame,
    project: str | None = None,
    rules: TextRules = DEFAULT_RULES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Active providers beside their registry mailing address and status."""
    people = _active(_of_project(provider, project, None, rules), rules).select(
        "NPI__c",
        "Full_Name__c",
        "Phone_Number__c",
        "Provider_Full_Address_With_Suite__c",
        "City__c",
        "State__c",
        "CreatedDate",
    )
    known = registry.select(
        "NPI",
        npi_status_label(F.col("Entity_Type_Code"), NO_RECORD).alias("Status_of_npi"),
        "Provider_First_Line_Business_Mailing_Address",
        "Provider_Second_Line_Business_Mailing_Address",
    )
    return _on_npi(people, known, rules, hot_rows)


def contact_report(view: DataFrame) -> DataFrame:
    """The view with display phones."""
    shown = {
        "Phone_Number__c": ("Phone_number", "0"),
        "Fax_Number__c": ("Fax_number", "0"),
        "Secondary_Phone_Number__c": ("Secondary_phone_number", "Not available"),
    }

    def column(name: str) -> Column:
        if name not in shown:
            return F.col(name)
        alias, missing = shown[name]
        return display_phone(F.col(name), missing).alias(alias)

    return view.select(*[column(c) for c in view.columns])


def taxonomy_fallback(registry: DataFrame, limit: int | None = None) -> DataFrame:
    """First taxonomy code, else the second, of entries with an entity code."""
    first, second = F.col("Healthcare_Provider_Taxonomy_Code_1"), F.col("Healthcare_Provider_Taxonomy_Code_2")
    rows = registry.where(F.col("Entity_Type_Code").isNotNull()).select(
        "NPI", first, second, F.coalesce(first, second).alias("taxonomy_code")
    )
    return rows if limit is None else rows.orderBy(*rows.columns).limit(limit)


def taxonomy_lookup(codeset: DataFrame, codes: Sequence[str], rules: TextRules = DEFAULT_RULES) -> DataFrame:
    return codeset.where(rules.key(F.col("taxonomy_code")).isin([rules.literal(c) for c in codes]))


def taxonomy_groups(registry: DataFrame) -> DataFrame:
    return registry.select("NPI", "Entity_Type_Code", *TAXONOMY_GROUPS)


def registry_active_count(registry: DataFrame, rules: TextRules = DEFAULT_RULES) -> DataFrame:
    """Distinct NPIs having an entity code, as one number."""
    active = registry.where(F.col("Entity_Type_Code").isNotNull())
    return active.agg(F.countDistinct(rules.key(F.col("NPI"))).alias("active_npis"))


def find_npi(
    table: DataFrame,
    npi: str,
    not_null: str | None = None,
    order: Sequence[str] = (),
    rules: TextRules = DEFAULT_RULES,
) -> DataFrame:
    """Rows of one NPI in a provider, registry or deactivation table."""
    column = "NPI__c" if "NPI__c" in table.columns else "NPI"
    rows = table.where(rules.equals(F.col(column), npi))
    if not_null is not None:
        rows = rows.where(F.col(not_null).isNotNull())
    return rows.orderBy(*order) if order else rows
