import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from goldkeel.functions.text import EXACT
from goldkeel.operators import charts as ch
from goldkeel.sources.bindings import Bindings

D = [datetime.date(2017, 1, d) for d in range(1, 10)]
JUNCTION = "Provider__c long, Location__c long, Project_Name__c string, CreatedDate date, LastModifiedDate date"
CHART = (
    "Id string, Provider__c long, Location__c long, CreatedDate date, LastModifiedDate date, "
    "FileBound_Disposition_Code__c string, FileBound_Status__c string, MRT_Name__c string, Appointment_Type__c string"
)


@pytest.fixture(scope="module")
def provider(spark):
    return Bindings(spark, "/root/testdata/sf0.001").provider


def test_select_projects_merges_spellings(spark):
    df = spark.createDataFrame(
        [("Acme", "P 2017"), ("ACME ", "p 2017"), ("Other", "P 2018"), (None, "P 2017")],
        "Client_Name__c string, Project_Name__c string",
    )
    assert rows(ch.select_projects(df, project="P 2017", client="acme")) == [("ACME ", "P 2017", 2)]
    assert rows(ch.select_projects(df, client_like="acm%", project_like="%2017")) == [("ACME ", "P 2017", 2)]
    assert len(rows(ch.select_projects(df))) == 3
    assert rows(ch.select_projects(df, client="Acme", rules=EXACT)) == [("Acme", "P 2017", 1)]


@pytest.mark.parametrize("bound", [0, 100])
def test_earliest_modified_link_wins(spark, bound):
    projects = spark.createDataFrame([("c", "P"), ("d", "P")], "Client_Name__c string, Project_Name__c string")
    junction = spark.createDataFrame(
        [
            (1, 1, "P", D[3], D[4]),
            (1, 1, "P", D[1], D[2]),
            (1, 1, "Q", D[0], None),
            (1, 2, "p ", D[5], D[6]),
            (1, 2, "P", D[4], None),
            (2, 2, "P", None, D[1]),
            (2, 3, "Q", D[1], D[1]),
        ],
        JUNCTION,
    )
    got = ch.provider_locations(projects, junction, max_broadcast_projects=bound)
    assert rows(got) == [(1, 1, D[2]), (2, 1, D[4]), (2, 2, None)]


def test_only_released_passed_charts_with_a_name_qualify(spark, provider):
    charts = spark.createDataFrame(
        [
            ("a", 1, 1, D[0], D[2], "QAP", "REL", "J. Doe", "T1"),
            ("b", 1, 1, D[0], None, "qap ", "rel", "Ciox", "T2"),
            ("c", 1, 1, D[0], None, "QAP", "REL", None, "T1"),
            ("d", 1, 1, D[0], None, "QAP", "REL", "replication", "T1"),
            ("e", 1, 1, D[0], None, "REJ", "REL", "J. Doe", "T1"),
            ("f", 1, 1, D[0], None, "QAP", "PND", "J. Doe", "T1"),
            ("g", 9, 1, D[0], None, "QAP", "REL", "J. Doe", "T1"),
        ],
        CHART,
    )
    links = spark.createDataFrame([(1, 1, D[0])], "Location__c long, Provider__c long, plj_record_date date")
    found = ch.qualifying_charts(links, charts, provider)
    assert rows(found.select("chart_id", "chart_date")) == [("a", D[2]), ("b", D[0])]
    exact = ch.qualifying_charts(links, charts, provider, rules=EXACT)
    assert rows(exact.select("chart_id")) == [("a",), ("d",)]
    pairs = ch.pair_counts(links, charts, provider)
    assert pairs.first()["chart_count"] == 2
    assert pairs.first()["charts_retreived_via_CopyService"] == 1


@pytest.mark.parametrize("hot_rows", [0, 3, 1_000_000])
def test_appointment_counts(spark, hot_rows):
    data = [(1, p, f"c{p}", "T1" if p % 3 else None) for p in range(9)] + [(2, 1, None, "T1"), (2, 2, "x", "T1")]
    df = spark.createDataFrame(data, "Location__c long, Provider__c long, chart_id string, Appointment_Type__c string")
    got = ch.appointment_counts(df, hot_rows=hot_rows)
    expected = [
        (*r, sum(1 for o in data if (o[0], o[3]) == (r[0], r[3]) and o[2]), sum(1 for o in data if o[0] == r[0]))
        for r in data
    ]
    assert rows(got) == sorted(expected, key=repr)


def test_latest_chart_and_first_row(spark):
    df = spark.createDataFrame(
        [(1, 1, D[5], "a", D[1]), (1, 1, D[5], "b", D[3]), (1, 2, D[2], "c", None)],
        "Location__c long, Provider__c long, plj_record_date date, chart_id string, chart_date date",
    )
    assert rows(ch.latest_chart_per_pair(df).select("chart_id")) == [("b",), ("c",)]
    assert rows(ch.first_row_per_location(df).select("chart_id")) == [("c",)]


def test_sorted_report(spark):
    df = spark.createDataFrame([(2, "a"), (1, "b"), (None, "c")], "x int, y string")
    assert [r[1] for r in ch.sorted_report(df, [1]).collect()] == ["c", "b", "a"]
    assert [r[1] for r in ch.sorted_report(df, ["y"]).collect()] == ["a", "b", "c"]


def test_summary_agrees_with_chart_rows(spark, provider):
    b = Bindings(spark, "/root/testdata/sf0.001")
    links = ch.provider_locations(ch.select_projects(provider), b.junction)
    typed = ch.classify_retrieval(ch.qualifying_charts(links, b.charts, provider))
    by_chart = typed.where("Retreival_type = 'Fax'").groupBy("Location__c").count()
    summary = ch.retrieval_summary(ch.pair_counts(links, b.charts, provider))
    by_pair = summary.where("charts_retreived_via_Fax > 0").select("Location__c", F.col("charts_retreived_via_Fax"))
    assert rows(by_chart) == rows(by_pair)


@pytest.mark.parametrize("hot_rows", [0, 1_000_000])
def test_appointment_counts_keep_rows_without_location(spark, hot_rows):
    data = [(None, p, f"c{p}", "T1" if p % 2 else None) for p in range(5)] + [(1, 7, "x", "T1")]
    df = spark.createDataFrame(data, "Location__c long, Provider__c long, chart_id string, Appointment_Type__c string")
    got = ch.appointment_counts(df, hot_rows=hot_rows)
    expected = [
        (*r, sum(1 for o in data if (o[0], o[3]) == (r[0], r[3])), sum(1 for o in data if o[0] == r[0])) for r in data
    ]
    assert rows(got) == sorted(expected, key=repr)


def test_sorted_report_descending_and_by_expression(spark):
    df = spark.createDataFrame([(2, "a"), (1, "b"), (None, "c")], "x int, y string")
    assert [r[1] for r in ch.sorted_report(df, [-1]).collect()] == ["a", "b", "c"]
    assert [r[1] for r in ch.sorted_report(df, ["-y"]).collect()] == ["c", "b", "a"]
    assert [r[1] for r in ch.sorted_report(df, [F.coalesce("x", F.lit(9)).desc()]).collect()] == ["c", "a", "b"]
