"""Reports whose place is a column."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from goldkeel.operators.reports import numbered_report
from test_groups import plan

COLUMNS = "a int, b string, c long"


def data(seed, count):
    pick = random.Random(seed)
    # A third of all rows share their first sort key.
    some = [(pick.choice([None, 1, 2, 3]) if i % 3 else 7, pick.choice([None, "x", "y", "Z"]), i) for i in range(count)]
    return some + some[:5]


def asc(value):
    return (value is not None, value if value is not None else 0)


class Desc:
    def __init__(self, value):
        self.key = asc(value)

    def __lt__(self, other):
        return other.key < self.key

    def __eq__(self, other):
        return other.key == self.key


ORDERS = {
    "columns": (["a", "b"], lambda r: (asc(r[0]), asc(r[1]), asc(r[2]))),
    "descending": (["-b", "a"], lambda r: (Desc(r[1]), asc(r[0]), asc(r[2]))),
    "positions": ([-1, 2], lambda r: (Desc(r[0]), asc(r[1]), asc(r[2]))),
    "expression": (None, lambda r: (Desc(r[1] or "q"), asc(r[0]), asc(r[1]), asc(r[2]))),
}


@pytest.mark.parametrize("name", ORDERS)
def test_places_match_a_sort(spark, name):
    order, key = ORDERS[name]
    order = order or [F.coalesce("b", F.lit("q")).desc()]
    some = data(len(name), 400)
    got = numbered_report(spark.createDataFrame(some, COLUMNS).repartition(7), order)
    expected = [(*r, n) for n, r in enumerate(sorted(some, key=key), 1)]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[-1]) == expected


def test_no_task_sees_all_rows(spark):
    some = data(1, 400)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = numbered_report(spark.createDataFrame(some, COLUMNS), ["a"], "rank")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.columns == ["a", "b", "c", "rank"]
    text = plan(got)
    assert "SinglePartition" not in text and "Window" not in text
    assert len(got.inputFiles()) == 4
    # A third of all rows share the first key; they are dealt out, too.
    sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < len(some) / 2
    expected = sorted(some, key=lambda r: (asc(r[0]), asc(r[1]), asc(r[2])))
    assert [tuple(r)[:3] for r in got.orderBy("rank").collect()] == expected


def test_an_empty_report_and_clashing_names(spark):
    df = spark.createDataFrame([], "part long, _part long, `_before` long, rows long")
    assert rows(numbered_report(df, ["part"])) == []
    one = spark.createDataFrame([(1, 2, 3, 4)], "part long, _part long, `_before` long, rows long")
    assert rows(numbered_report(one, [-2])) == [(1, 2, 3, 4, 1)]
