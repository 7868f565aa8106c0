import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from conftest import rows
from goldkeel.operators.groups import (
    GroupTotal,
    broadcast_if_small,
    counted,
    first_per_group,
    join_on_unique,
    unseen,
    with_group_totals,
)
from goldkeel.functions.text import DEFAULT_RULES
from goldkeel.session import stage

HOT = [0, 2, 10, 1_000_000]


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key, some keys NULL."""
    data = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 11}", i % 4 or None) for i in range(120)]
    return spark.createDataFrame(data, "id int, k string, v int")


@pytest.mark.parametrize("hot_rows", HOT)
def test_group_totals_match_brute_force(skewed, hot_rows):
    totals = [GroupTotal("n", ["k"], F.count(F.lit(1))), GroupTotal("s", ["k", "v"], F.sum("id"))]
    got = with_group_totals(skewed, totals, ["id"], hot_rows)
    assert got.columns == ["id", "k", "v", "n", "s"]
    data = [tuple(r) for r in skewed.collect()]
    expected = [
        (i, k, v, sum(1 for r in data if r[1] == k), sum(r[0] for r in data if r[1:] == (k, v))) for i, k, v in data
    ]
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("hot_rows", HOT)
def test_join_on_unique_matches_plain_join(spark, skewed, hot_rows):
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k5", 3), ("none", 4), (None, 5)], "k string, w int")
    got = join_on_unique(skewed, right, ["k"], hot_rows).select("id", "k", "v", "w")
    assert rows(got) == rows(skewed.join(right, "k").select("id", "k", "v", "w"))
    keys = skewed.select("k")
    again = join_on_unique(skewed, right, ["k"], hot_rows, key_source=keys).select("id", "k", "v", "w")
    assert rows(again) == rows(got)


def test_copies_of_one_row_survive_a_hot_join(spark):
    left = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)], "k string, v int")
    right = spark.createDataFrame([("a", 9), ("b", 8)], "k string, w int")
    assert rows(join_on_unique(left, right, ["k"], 5)) == rows(left.join(right, "k"))


def test_first_per_group_prunes_before_the_shuffle(skewed):
    got = first_per_group(skewed, ["k"], {"v": F.col("v").desc_nulls_last()})
    data = [tuple(r) for r in skewed.collect()]
    best = {}
    for i, k, v in data:
        rank = (-(v or -1), i)
        if k not in best or rank < best[k][0]:
            best[k] = rank, (i, k, v)
    assert rows(got) == sorted((r for _, r in best.values()), key=repr)
    assert "WindowGroupLimit" in plan(got)


def test_counted_folds_spellings(spark):
    df = spark.createDataFrame([("a",), ("A ",), ("b",), (None,), ("A ",)], "x string")
    assert rows(counted(df, ["x"], DEFAULT_RULES.keys(["x"]), "n")) == [("A ", 3), ("b", 1), (None, 1)]


def test_unseen(spark):
    source = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    target = spark.createDataFrame([("b", 9), ("b", 8), ("c", 7)], "k string, w int")
    assert rows(unseen(source, target, "k")) == [("a", 1)]


def test_broadcast_only_below_the_bound(spark, skewed):
    small = spark.createDataFrame([("hot",), ("k1",)], "k string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(skewed.join(broadcast_if_small(small, 2), "k"))
        assert "BroadcastHashJoin" not in plan(skewed.join(broadcast_if_small(small, 1), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_all_hot_groups_are_found_by_one_job(spark, skewed, hot_rows):
    source = stage(skewed, "skewed")
    totals = [GroupTotal(f"n{i}", keys, F.count(F.lit(1))) for i, keys in enumerate((["k"], ["v"], ["k", "v"], ["id"]))]
    group = f"totals-{hot_rows}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        with_group_totals(source, totals, ["id"], hot_rows)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    executions = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    stages = {s for j in executions for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
    # One query: a map and a reduce step, whatever the number of totals.
    assert len(executions) <= 2 and len(stages) <= 3


def test_more_hot_keys_than_may_be_listed(spark, skewed, monkeypatch):
    from goldkeel.operators import groups

    monkeypatch.setattr(groups, "MAX_HOT_KEYS", 2)
    totals = [GroupTotal("n", ["k"], F.count(F.lit(1))), GroupTotal("m", ["v"], F.sum("id"))]
    assert rows(with_group_totals(skewed, totals, ["id"], 0)) == rows(with_group_totals(skewed, totals, ["id"]))
    assert all(len(codes) <= 2 for codes in groups._hot_codes(skewed, [["k"], ["v"]], 0))
