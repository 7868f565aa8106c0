"""Content ids of locations, merge reports and golden records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldkeel.functions.ids import location_id_columns
from goldkeel.functions.labels import RETRIEVAL_SUMMARY
from goldkeel.functions.text import address_lines, cleanse_phone, fix_zip
from goldkeel.operators.groups import HOT_ROWS, GroupTotal, first_per_group, with_group_totals

# Id column and the name of its group size in the merge report.
ID_KINDS = {
    "NEW_LID_ALL": "count_sfLid_at_NewLIdAll",
    "NEW_LID_ADD": "count_sfLid_at_NewLIdAdd",
    "NEW_LID_PHONE": "count_sfLid_at_NewLIdPhone",
    "NEW_LID_ADD_BASE_PHONE": "count_sfLid_at_NewLIdBasePhone",
}

# Column groups of location rows, passed through unchanged.
CONTACT_COLUMNS = [
    "Client_Name__c",
    "Contact_Person__c",
    "Contact_Person_2__c",
    "Practice_Name__c",
    "Provider_Full_Address__c",
    "Provider_Full_Address_With_Suite__c",
]
STORAGE_COLUMNS = ["Record_Storage_Type__c", "EMR_System__c", "EMR_Version__c", "Other_EMR_System__c"]
SOURCE_STATISTICS = [
    "Num_of_Charts_Recovered__c",
    "Charts_Remaining__c",
    "Num_of_Charts_Scheduled__c",
    "of_charts_REL__c",
    "Percent_of_Charts_Recovered__c",
]
OTHER_COLUMNS = [
    "Appointment_Type__c",
    "Workflow_Status__c",
    "Invoices__c",
    "PNP_Reason__c",
    "Location__Latitude__s",
    "Location__Longitude__s",
]
RETRIEVAL_COLUMNS = ["Best_Retreival_Type", *[f"charts_retreived_via_{name}" for _, name in RETRIEVAL_SUMMARY]]

# Text of the separator columns.
SEPARATORS = {
    "DATASET_CONTACT_INFO": "Contact Info=>",
    "DATASET_CHARTS_INFO": "Charts Info=>",
    "DATASET_STORAGE_INFO": "Med. Rec. Storage Info=>",
    "DATASET_OTHER_INFO": "Other Info=>",
}

PERCENT = T.DecimalType(18, 2)


def location_ids(
    location: DataFrame, address_mode: str = "lines", encoding: str = "UTF-8", strip_country: bool = False
) -> DataFrame:
    """Location id, name and the four content ids."""
    ids = location_id_columns(address_mode, encoding, strip_country)
    return location.select(
        F.col("Id").alias("Location__c"), F.col("Name").alias("SFDC_LID"), *[c.alias(n) for n, c in ids.items()]
    )


def location_candidates(
    location: DataFrame,
    retrieval: DataFrame,
    address_mode: str = "lines",
    encoding: str = "UTF-8",
    require_contact: bool = False,
    strip_country: bool = False,
    raw_zip_and_fax: bool = False,
) -> DataFrame:
    """One row per location reached by charts: ids, cleansed contact, chart
    figures. ``raw_zip_and_fax`` leaves these as they are stored."""
    rows = location
    if require_contact:
        rows = rows.where(
            F.col("Provider_Full_Address__c").isNotNull()
            | F.coalesce(F.col("Phone_1__c"), F.col("Phone_2__c")).isNotNull()
        )
    line1, line2 = F.col("Address_Line_1__c"), F.col("Address_Line_2__c")
    statistics = [c for c in SOURCE_STATISTICS if c in rows.columns]

    def clean(name: str) -> Column:
        return cleanse_phone(F.col(name), strip_country).alias(name)

    def fax(name: str) -> Column:
        return F.col(name) if raw_zip_and_fax else clean(name)

    prepared = rows.select(
        F.col("Id").alias("Location__c"),
        F.col("Name").alias("SFDC_LID"),
        *[c.alias(n) for n, c in location_id_columns(address_mode, encoding, strip_country).items()],
        *CONTACT_COLUMNS,
        line1.alias("Address_Line"),
        line2.alias("Address_Suite_No"),
        address_lines(line1, line2).alias("Address_With_Suite"),
        "City__c",
        "State__c",
        F.col("ZIP_Code__c") if raw_zip_and_fax else fix_zip(F.col("ZIP_Code__c")).alias("ZIP_Code__c"),
        clean("Phone_1__c"),
        "Phone_1_Ext__c",
        clean("Phone_2__c"),
        "Phone_2_Ext__c",
        fax("Fax_Number__c"),
        fax("Fax_Number_Console__c"),
        fax("Fax_Number_For_Display__c"),
        *STORAGE_COLUMNS,
        "CreatedDate",
        "Num_of_Charts__c",
        *statistics,
        *OTHER_COLUMNS,
    )
    figures = retrieval.select(
        "Location__c", F.col("charts_at_loc").alias("charts_recovered_at_loc"), *RETRIEVAL_COLUMNS
    )
    return prepared.join(figures, "Location__c")


def merge_report(candidates: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Source id beside its four new ids and the group size under each."""
    report = candidates.select(
        *ID_KINDS, "Location__c", "SFDC_LID", F.col("CreatedDate").alias("sfdcLidCreatedDate")
    )
    totals = [GroupTotal(size, [kind], F.count("SFDC_LID")) for kind, size in ID_KINDS.items()]
    return with_group_totals(report, totals, ["Location__c"], hot_rows)


def merged_ids(candidates: DataFrame, more_than: int = 1) -> DataFrame:
    """Per id kind and new id that stands for more than one source id: its
    rows, distinct locations and distinct source ids.

    Rows are counted per new id and value first, which spreads the rows of an
    id that most locations share; what is summed after that are the counts
    that each task has already combined.
    """
    kinds = F.array(*[F.struct(F.lit(k).alias("id_kind"), F.col(k).alias("new_id")) for k in ID_KINDS])
    values = F.array(
        F.struct(F.lit("location").alias("of"), F.col("Location__c").cast("string").alias("value")),
        F.struct(F.lit("source").alias("of"), F.col("SFDC_LID").cast("string").alias("value")),
    )
    rows = candidates.select("Location__c", "SFDC_LID", F.inline(kinds)).select("id_kind", "new_id", F.inline(values))
    per_value = rows.groupBy("id_kind", "new_id", "of", "value").agg(F.count(F.lit(1)).alias("rows"))
    is_location, has_value = F.col("of") == "location", F.col("value").isNotNull()
    sources = F.sum(F.when(~is_location & has_value, F.col("rows"))).alias("source_rows")
    per_id = per_value.groupBy("id_kind", "new_id").agg(
        F.sum(F.when(is_location, F.col("rows"))).alias("row_count"),
        F.count(F.when(is_location & has_value, 1)).alias("distinct_locations"),
        F.count(F.when(~is_location & has_value, 1)).alias("distinct_source_ids"),
        sources,
    )
    return per_id.where(F.col("source_rows") > more_than).drop("source_rows")


def merge_reduction(candidates: DataFrame) -> DataFrame:
    """Per id kind: rows, distinct locations, distinct new ids, ids saved, and
    the locations and groups that really merged."""
    rows = candidates.select(
        "Location__c",
        F.inline(F.array(*[F.struct(F.lit(k).alias("id_kind"), F.col(k).alias("new_id")) for k in ID_KINDS])),
    )
    groups = rows.groupBy("id_kind", "new_id").agg(F.count(F.lit(1)).alias("_size"))
    merged = F.col("_size") > 1
    per_kind = groups.groupBy("id_kind").agg(
        F.sum("_size").alias("row_count"),
        F.count("new_id").alias("distinct_new_ids"),
        F.coalesce(F.sum(F.when(merged, F.col("_size"))), F.lit(0)).alias("rows_in_merged_groups"),
        F.count(F.when(merged, 1)).alias("merged_groups"),
    )
    locations = rows.groupBy("id_kind").agg(F.countDistinct("Location__c").alias("distinct_locations"))
    return per_kind.join(locations, "id_kind").select(
        "id_kind",
        "row_count",
        "distinct_locations",
        "distinct_new_ids",
        (F.col("row_count") - F.col("distinct_new_ids")).alias("ids_saved"),
        "rows_in_merged_groups",
        "merged_groups",
    )


def percent_recovered(
    recovered: Column, expected: Column, truncate: bool = True, integer_division: bool = False
) -> Column:
    """100 * recovered / expected, NULL for 0 expected; two places, cut not rounded."""
    expected = F.nullif(expected.cast(PERCENT), F.lit(0).cast(PERCENT))
    if integer_division:
        return (F.call_function("div", recovered, expected) * 100).cast(PERCENT)
    if not truncate:
        return (recovered * 100).cast("decimal(20,0)") / expected
    hundredths = F.call_function("div", recovered * 10000, expected)
    return (hundredths.cast("decimal(16,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(PERCENT)


def location_master(
    candidates: DataFrame,
    with_separators: bool = False,
    with_source: bool = False,
    truncate_percent: bool = True,
    integer_division: bool = False,
) -> DataFrame:
    """Golden record per new id: the location with most recovered charts.

    ``with_source`` adds the winning source id, its client and full address,
    and the number of source ids it stands for.
    """
    order = {
        "charts_recovered_at_loc": F.col("charts_recovered_at_loc").desc(),
        "Location__c": F.col("Location__c").asc(),
    }
    golden = first_per_group(candidates, ["NEW_LID_ALL"], order, total_order=True)
    if with_source:
        sizes = candidates.groupBy("NEW_LID_ALL").agg(F.count("SFDC_LID").alias("count_sfLid_at_NewLId"))
        golden = golden.join(sizes, "NEW_LID_ALL")

    def separator(name: str) -> list[Column]:
        return [F.lit(SEPARATORS[name]).alias(name)] if with_separators else []

    source = ["Location__c", "SFDC_LID", "Client_Name__c", "Provider_Full_Address__c", "count_sfLid_at_NewLId"]
    percent = percent_recovered(
        F.col("charts_recovered_at_loc"), F.col("Num_of_Charts__c"), truncate_percent, integer_division
    )
    return golden.select(
        F.col("NEW_LID_ALL").alias("New_lid_all"),
        *(source if with_source else []),
        *separator("DATASET_CONTACT_INFO"),
        "Contact_Person__c",
        "Contact_Person_2__c",
        "Practice_Name__c",
        "Address_Line",
        "Address_Suite_No",
        "Address_With_Suite",
        "City__c",
        "State__c",
        "ZIP_Code__c",
        "Phone_1__c",
        "Phone_1_Ext__c",
        "Phone_2__c",
        "Phone_2_Ext__c",
        "Fax_Number__c",
        "Fax_Number_Console__c",
        "Fax_Number_For_Display__c",
        *separator("DATASET_CHARTS_INFO"),
        "CreatedDate",
        F.col("Num_of_Charts__c").alias("charts_numbers_at_loc"),
        "charts_recovered_at_loc",
        percent.alias("Percent_of_Charts_Recovered__c"),
        *RETRIEVAL_COLUMNS,
        *separator("DATASET_STORAGE_INFO"),
        *STORAGE_COLUMNS,
        *separator("DATASET_OTHER_INFO"),
        *OTHER_COLUMNS,
    )
