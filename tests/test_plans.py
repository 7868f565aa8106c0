"""What the plans must look like whatever the data."""

import pytest
from pyspark.sql import functions as F

from goldkeel.functions.text import EXACT
from goldkeel.operators import charts as ch
from goldkeel.operators import counts as co
from goldkeel.session import stage
from goldkeel.sources.bindings import Bindings
from test_groups import plan
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def b(spark):
    return Bindings(spark, SF)


@pytest.fixture
def no_static_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_exact_rules_reach_the_parquet_reader(b):
    text = plan(ch.passing_charts(b.charts, rules=EXACT).select("Id"))
    assert "EqualTo(FileBound_Disposition_Code__c,QAP)" in text
    assert "EqualTo(FileBound_Status__c,REL)" in text


def test_pair_counts_read_only_needed_columns(b):
    links = ch.provider_locations(ch.select_projects(b.provider), b.junction)
    text = plan(ch.pair_counts(links, b.charts, b.provider))
    chart_scans = [l for l in text.splitlines() if l.startswith("ReadSchema") and "MRT_Name__c" in l]
    assert len(chart_scans) == 1
    assert "Appointment_Type__c" not in chart_scans[0] and "CreatedDate" not in chart_scans[0]
    assert "partial_count" in text


def test_cold_counts_share_one_exchange(b):
    links = ch.provider_locations(ch.select_projects(b.provider), b.junction)
    pairs = stage(ch.pair_counts(links, b.charts, b.provider), "pairs")
    text = plan(co._window_counts(pairs, list(co.GRAINS), "lines"))
    assert text.count("hashpartitioning") == 1


@pytest.mark.parametrize("name", ["c03_qualifying_charts", "c08_appointment_counts", "c22_provider_registry_view"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "ArrowEval", "MapInPandas"):
        assert node not in text


def test_a_huge_provider_is_split_by_adaptive_execution(spark, no_static_broadcast):
    """The pair-to-provider join has plain exchanges on both sides, which lets
    adaptive execution split the partition of a hot provider."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        numbers = spark.range(60000)
        hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("long")
        links = stage(
            numbers.select(F.col("id").alias("Location__c"), hot.alias("Provider__c"), F.lit(None).cast("date").alias("plj_record_date")),
            "links",
        )
        charts = stage(
            links.select(
                *ch.PAIR,
                F.col("Location__c").cast("string").alias("Id"),
                F.lit("QAP").alias("FileBound_Disposition_Code__c"),
                F.lit("REL").alias("FileBound_Status__c"),
                F.lit("Fax").alias("MRT_Name__c"),
            ),
            "charts",
        )
        blank = F.lit(None).cast("string")
        text_columns = ["NPI__c", "TIN_ID__c", "Phone_Number__c", "Secondary_Phone_Number__c", "Address_Line_1__c"]
        text_columns += ["Address_Line_2__c", "City__c", "State__c", "ZIP_Code__c", "Provider_Full_Address_With_Suite__c"]
        people = stage(numbers.select(F.col("id").alias("Id"), *[blank.alias(c) for c in text_columns]), "people")
        pairs = ch.pair_counts(links, charts, people)
        pairs.write.format("noop").mode("overwrite").save()
        assert pairs.agg(F.sum("chart_count")).first()[0] == 60000
        collected = pairs.select("Location__c", "Provider__c", "chart_count", "key_npi")
        assert len(collected.collect()) == 60000
        assert "isSkew=true" in collected._jdf.queryExecution().executedPlan().toString() or "skew=true" in (
            collected._jdf.queryExecution().executedPlan().toString()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_all_counts_take_one_sort_a_chain(b):
    """15 counts in five chains: windows of a chain share its sort, and the
    exchange is the only one."""
    links = ch.provider_locations(ch.select_projects(b.provider), b.junction)
    pairs = stage(ch.pair_counts(links, b.charts, b.provider), "pairs")
    text = plan(co._window_counts(pairs, list(co.GRAINS), "lines"))
    tree = text[: text.index("(1) Scan")]
    assert tree.count("Sort (") <= 6
    assert text.count("hashpartitioning") == 1


def test_chase_sums_by_provider_aggregate_by_hash(spark):
    text = plan(QUERIES["c13_chase_list_by_provider"](spark, SF))
    assert "SortAggregate" not in text
    assert "SortAggregate" not in plan(QUERIES["c13_distinct_chase_map"](spark, SF))


def test_bounds_of_a_project_reach_the_reader(b):
    from goldkeel.operators.state import junction_rows

    text = plan(junction_rows(b.junction, "BUILDING|2018|MRR|0"))
    assert "GreaterThanOrEqual(Project_Name__c,BUILDING|2018|MRR|0)" in text
    assert "LessThan(Project_Name__c,building|2018|mrr|0!)" in text


def test_links_are_checked_as_a_table(spark):
    """The check's own two sets of keys, and none of the links' beside them."""
    from workload.queries import QUERIES

    plan = QUERIES["c37_uniqueness_of_links"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    initial = plan.toString().split("Initial Plan")[-1]
    assert "Join" not in initial and initial.count("HashAggregate") == 4
