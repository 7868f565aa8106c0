"""Rows left out by the keys of a smaller table."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from goldkeel.operators import charts as ch
from goldkeel.operators import pruning
from goldkeel.session import stage
from goldkeel.sources.bindings import Bindings
from test_groups import plan

KEYS = ["k", "t"]


@pytest.fixture(scope="module")
def many(spark):
    return spark.range(40_000).select(F.col("id").alias("k"), F.concat(F.lit("t"), F.col("id") % 7).alias("t"))


@pytest.mark.parametrize("words", [64, 4096])
def test_a_filter_holds_no_row_back(spark, many, words):
    keys = many.where("k % 40 = 0")
    held = pruning.key_filter(keys, words)
    assert held.count() <= words
    kept = pruning.filtered_by_keys(many, KEYS, held, words)
    assert keys.join(kept, KEYS, "left_anti").count() == 0
    if words == 4096:  # a quarter key a word
        assert kept.count() < 1.02 * keys.count()


def test_null_keys_are_no_members(spark, many):
    keys = spark.createDataFrame([(1, None), (None, "t1"), (2, "t2")], "k long, t string")
    for most in (0, 10):
        kept = pruning.pruned(many, keys, KEYS, most)
        assert rows(kept.where("k in (1, 2)")) == [(2, "t2")] and kept.count() < 5


def test_the_way_follows_the_number_of_keys(spark, many):
    keys = stage(many.where("k < 1000"), "keys")
    by_keys = plan(pruning.pruned(many, keys, KEYS, 1000))
    assert "BroadcastHashJoin" in by_keys and "bit_or" not in by_keys
    by_filter = plan(pruning.pruned(many, keys, KEYS, 999, words=1024))
    assert "BroadcastHashJoin" in by_filter and "bit_or" in by_filter
    assert "Join" not in plan(pruning.pruned(many, keys, KEYS, 999, words=100))


def test_the_filter_is_bounded_whatever_the_keys(spark):
    keys = spark.range(200_000).select(F.col("id").alias("k"), F.lit("t").alias("t"))
    assert pruning.key_filter(keys, 1000).count() == 1000


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_unlinked_charts_do_not_shuffle(spark, most):
    """On either side of the limit the charts of other pairs go before the
    first exchange, and the counts are those of the plain way."""
    b = Bindings(spark, "/root/testdata/sf0.001")
    projects = ch.select_projects(b.provider, project="BUILDING|2018|MRR|0")
    links = stage(ch.provider_locations(projects, b.junction), "links")
    plain = ch.pair_counts(links, b.charts, b.provider)
    got = ch.pair_counts(links, b.charts, b.provider, max_broadcast_links=most)
    assert rows(got) == rows(plain)
    passing = ch.passing_charts(b.charts).select(*ch.PAIR)
    kept = pruning.pruned(passing, links, ch.PAIR, most)
    linked = passing.join(links, ch.PAIR, "left_semi").count()
    assert linked <= kept.count() < 1.02 * linked + 20 < passing.count() / 2
    text = plan(got)
    assert "BroadcastHashJoin LeftSemi" in text
