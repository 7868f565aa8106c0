from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from goldkeel.operators.charts import retrieval_summary
from goldkeel.operators.locations import (
    ID_KINDS,
    location_candidates,
    location_ids,
    location_master,
    merge_reduction,
    merged_ids,
    merge_report,
    percent_recovered,
)
from goldkeel.operators.profile import uniqueness_check
from goldkeel.sources.bindings import Bindings

SF = "/root/testdata/sf0.001"
RETRIEVAL = "charts_retreived_via_{}"


@pytest.fixture(scope="module")
def location(spark):
    return Bindings(spark, SF).location


@pytest.fixture(scope="module")
def retrieval(spark, location):
    types = ["SFTP", "MailRoom", "Fax", "eMail", "CopyService", "Field", "NullOthers"]
    figures = [F.lit(i if i < 2 else 0).cast("long").alias(RETRIEVAL.format(t)) for i, t in enumerate(types)]
    ids = location.select(F.col("Id").alias("Location__c"), (F.col("Id") % 4).alias("charts_at_loc"))
    return ids.select("*", F.lit("MailRoom").alias("Best_Retreival_Type"), *figures)


def test_best_type_prefers_the_first_of_equals(spark):
    names = ["SFTP", "MailRoom", "Fax", "eMail", "CopyService", "Field", "NullOthers"]
    columns = ", ".join(f"{RETRIEVAL.format(n)} long" for n in names)
    data = [(1, 4, 2, 0, 2, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0, 0, 1, 0), (2, 2, 0, 0, 0, 0, 1, 1, 0)]
    pairs = spark.createDataFrame(data, f"Location__c long, chart_count long, {columns}")
    got = {r["Location__c"]: r for r in retrieval_summary(pairs).collect()}
    assert got[1]["Best_Retreival_Type"] == "SFTP"
    assert got[2]["Best_Retreival_Type"] == "Field"
    assert got[2]["charts_at_loc"] == 3


def test_ids_ignore_formatting_of_phones(location):
    changed = location.withColumn("Phone_1__c", F.translate("Phone_1__c", "() -.", ""))
    assert rows(location_ids(location)) == rows(location_ids(changed))


def test_hash_uses_the_unpadded_zip(location, retrieval):
    short = location.withColumn("ZIP_Code__c", F.lit("8080"))
    long = location.withColumn("ZIP_Code__c", F.lit("08080"))
    one, other = location_candidates(short, retrieval), location_candidates(long, retrieval)
    assert {r[0] for r in one.select("ZIP_Code__c").collect()} == {"08080"}
    assert one.join(other, "NEW_LID_ALL").count() == 0


def test_wrong_address_mode(location):
    with pytest.raises(ValueError, match="address_mode"):
        location_ids(location, address_mode="both")


@pytest.mark.parametrize("hot_rows", [0, 2, 1_000_000])
def test_merge_report_counts(location, retrieval, hot_rows):
    found = location_candidates(location, retrieval)
    report = merge_report(found, hot_rows).collect()
    assert len(report) == location.count()
    for kind, size in ID_KINDS.items():
        for row in report:
            assert row[size] == sum(1 for other in report if other[kind] == row[kind])


def test_one_golden_record_per_id(location, retrieval):
    found = location_candidates(location, retrieval)
    golden = location_master(found, with_source=True)
    assert uniqueness_check(golden, ["New_lid_all"]).first()["repeated_keys"] == 0
    groups = {}
    for r in found.collect():
        groups.setdefault(r["NEW_LID_ALL"], []).append(r)
    for r in golden.collect():
        members = groups.pop(r["New_lid_all"])
        best = min(members, key=lambda m: (-m["charts_recovered_at_loc"], m["Location__c"]))
        assert r["Location__c"] == best["Location__c"]
        assert r["count_sfLid_at_NewLId"] == len(members)
    assert not groups


def test_merge_reduction(location, retrieval):
    found = location_candidates(location, retrieval)
    report = {r["id_kind"]: r for r in merge_reduction(found).collect()}
    ids = [r["NEW_LID_ADD"] for r in found.collect()]
    row = report["NEW_LID_ADD"]
    assert row["row_count"] == row["distinct_locations"] == len(ids)
    assert row["distinct_new_ids"] == len(set(ids))
    assert row["ids_saved"] == len(ids) - len(set(ids))
    assert row["rows_in_merged_groups"] == sum(1 for i in ids if ids.count(i) > 1)
    assert row["merged_groups"] == len({i for i in ids if ids.count(i) > 1})


def test_percent_is_cut_not_rounded(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (5, 0), (7, None), (3, 2)], "r long, n long")
    columns = (F.col("r"), F.col("n"))
    got = [r[0] for r in df.select(percent_recovered(*columns)).collect()]
    assert got == [Decimal("33.33"), Decimal("66.66"), None, None, Decimal("150.00")]
    whole = [r[0] for r in df.select(percent_recovered(*columns, integer_division=True)).collect()]
    assert whole == [Decimal("0.00"), Decimal("0.00"), None, None, Decimal("100.00")]
    plain = [r[0] for r in df.select(percent_recovered(*columns, truncate=False)).collect()]
    assert str(plain[1]).startswith("66.6666") and plain[2] is None
    double = df.select(percent_recovered(F.col("r"), F.col("n").cast("double"))).first()[0]
    assert double == Decimal("33.33")


def merged(spark, data, hot=0):
    types = "Location__c long, SFDC_LID string, " + ", ".join(f"{k} string" for k in ID_KINDS)
    return spark.createDataFrame(data, types).repartition(5)


def test_merged_ids_match_brute_force(spark):
    """One id holds most rows; some source ids and locations are null or repeat."""
    data = []
    for i in range(300):
        lid = "hot" if i % 3 else f"id{i % 17}"
        source = None if i % 11 == 0 else f"LID-{i // 2}"
        data.append((None if i % 13 == 0 else i // 3, source, lid, f"a{i % 5}", None if i % 7 == 0 else "p", str(i)))
    expected = []
    for n, kind in enumerate(ID_KINDS, 2):
        for lid in {r[n] for r in data}:
            mine = [r for r in data if r[n] == lid]
            if sum(r[1] is not None for r in mine) > 1:
                places, sources = ({r[c] for r in mine} - {None} for c in (0, 1))
                expected.append((kind, lid, len(mine), len(places), len(sources)))
    assert rows(merged_ids(merged(spark, data))) == sorted(expected, key=repr)


def test_merged_ids_spread_a_hot_id(spark):
    """The first exchange deals rows by value, too, and sends counts only."""
    from test_groups import plan

    data = [(i, f"L{i}", "hot", "a", "p", "b") for i in range(200)]
    text = plan(merged_ids(merged(spark, data)))
    dealt = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert any("value" in line for line in dealt)
    assert text.count("partial_count(1)") >= 1 and "Expand" not in text


def test_merged_ids_of_few(spark):
    assert rows(merged_ids(merged(spark, []))) == []
    assert rows(merged_ids(merged(spark, [(1, "x", "i", "i", "i", "i")]))) == []


def test_raw_zip_and_fax(location, retrieval):
    raw = location_candidates(location, retrieval, raw_zip_and_fax=True)
    names = ["ZIP_Code__c", "Fax_Number__c", "Fax_Number_Console__c", "Fax_Number_For_Display__c"]
    stored = location.join(raw.select("Location__c"), F.col("Id") == F.col("Location__c"))
    assert rows(raw.select(*names)) == rows(stored.select(*names))
