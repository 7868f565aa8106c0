import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from goldkeel.operators.charts import PAIR
from goldkeel.operators.counts import (
    GRAINS,
    KEYS,
    SESSION_GRAINS,
    chart_count_matrix,
    chart_counts_at,
    grain_keys,
    summed_counts_per_location,
)

COLUMNS = [*PAIR, "chart_count", *KEYS]


@pytest.fixture(scope="module")
def data():
    """Half of the pairs at one location; keys repeat and may be NULL."""
    rng = random.Random(5)
    result = []
    for provider in range(160):
        location = 1 if provider % 2 else rng.randrange(2, 9)
        keys = [rng.choice([None, "a", "b", "c"]) for _ in KEYS]
        result.append((location, provider, rng.randrange(1, 6), *keys))
    return result


@pytest.fixture(scope="module")
def pairs(spark, data):
    types = "Location__c long, Provider__c long, chart_count long, " + ", ".join(f"{k} string" for k in KEYS)
    return spark.createDataFrame(data, types)


def count(data, row, keys):
    positions = [0, *[COLUMNS.index(k) for k in keys]]
    return sum(r[2] for r in data if all(r[p] == row[p] for p in positions))


@pytest.mark.parametrize("mode", ["lines", "full"])
@pytest.mark.parametrize("hot_rows", [0, 10, 1_000_000])
def test_matrix_matches_brute_force(pairs, data, mode, hot_rows):
    got = chart_count_matrix(pairs, address_mode=mode, hot_rows=hot_rows).select(*PAIR, *GRAINS)
    expected = [(r[0], r[1], *[count(data, r, grain_keys(g, mode)) for g in GRAINS]) for r in data]
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("mode", ["lines", "full"])
def test_sums_equal_the_summed_matrix(pairs, mode):
    matrix = chart_count_matrix(pairs, address_mode=mode)
    expected = matrix.groupBy("Location__c").agg(*[F.sum(g).alias(g) for g in GRAINS])
    assert rows(summed_counts_per_location(pairs, address_mode=mode)) == rows(expected)


@pytest.mark.parametrize("mode", ["lines", "full"])
@pytest.mark.parametrize("hot_rows", [0, 40])
def test_hot_locations_change_no_sums(pairs, data, mode, hot_rows):
    got = summed_counts_per_location(pairs, address_mode=mode, hot_rows=hot_rows).select("Location__c", *GRAINS)
    places = sorted({r[0] for r in data})
    expected = [
        (p, *[sum(count(data, r, grain_keys(g, mode)) for r in data if r[0] == p) for g in GRAINS]) for p in places
    ]
    assert rows(got) == sorted(expected, key=repr)


def test_sums_move_pairs_once_and_not_per_grain(pairs):
    plan = summed_counts_per_location(pairs)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange") == 1 and "Expand" not in plan


@pytest.mark.parametrize("of", [summed_counts_per_location, chart_count_matrix])
def test_more_pairs_go_to_more_tasks(pairs, monkeypatch, of):
    from goldkeel.operators import counts

    monkeypatch.setattr(counts, "PAIRS_PER_TASK", 10)
    assert of(pairs).rdd.getNumPartitions() == 16


def test_counts_over_keys_add_up_to_the_location(pairs):
    matrix = chart_count_matrix(pairs)
    per_key = matrix.groupBy("Location__c", "key_npi").agg(F.max("CountOfCharts_atLoc_byNpi").alias("n"))
    total = per_key.groupBy("Location__c").agg(F.sum("n").alias("n"))
    assert rows(total) == rows(matrix.select("Location__c", "charts_at_loc").distinct())


def test_session_grains_are_a_subset():
    assert len(SESSION_GRAINS) == 10 and set(SESSION_GRAINS) < set(GRAINS) and len(GRAINS) == 15


def test_spot_check(spark):
    types = "Location__c long, Provider__c long, chart_count long, NPI__c string, TIN_ID__c string, FULL_ADDRESS string, "
    types += ", ".join(f"{k} string" for k in KEYS)
    data = [
        (1, 1, 3, "7", "t", "A", "7", "t", "a", "a", "5"),
        (1, 2, 2, "7", "t", "A", "7", "t", "a", "a", "5"),
        (1, 3, 9, "7", "u", "A", "7", "u", "a", "a", "5"),
        (2, 4, 4, "8", "t", "A", "8", "t", "a", "a", "5"),
    ]
    df = spark.createDataFrame(data, types)
    got = chart_counts_at(df, npi="7", tin="T", address="a ", phone="5")
    assert [r[-2:] for r in rows(got)] == [(2, 5), (2, 5)]
    assert chart_counts_at(df, npi="7", limit=1).count() == 1


@pytest.mark.parametrize("hot_rows", [0, 40])
def test_hot_locations_change_no_chase_list(spark, hot_rows):
    from goldkeel.operators import charts as ch
    from goldkeel.operators.chase import chase_list
    from goldkeel.operators.locations import location_candidates
    from goldkeel.session import stage
    from goldkeel.sources.bindings import Bindings

    b = Bindings(spark, "/root/testdata/sf0.001")
    links = ch.provider_locations(ch.select_projects(b.provider), b.junction)
    pairs = stage(ch.pair_counts(links, b.charts, b.provider), "pairs")
    found = stage(location_candidates(b.location, ch.retrieval_summary(pairs)), "candidates")
    usual = chase_list(found, pairs, by="lid_provider")
    assert rows(chase_list(found, pairs, by="lid_provider", hot_rows=hot_rows)) == rows(usual)
    plain = ch.qualifying_charts(links, b.charts, b.provider)
    assert rows(ch.qualifying_charts(links, b.charts, b.provider, hot_rows=1).select(*plain.columns)) == rows(plain)


def groups_of(spark, texts):
    from goldkeel.operators.chase import SHOWN, provider_groups

    types = "Provider__c long, " + ", ".join(f"{c} string" for c in SHOWN)
    pairs = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)] * 3, types)
    return provider_groups(pairs)


TEXTS = [
    ("7", "t", "A", "5"), ("7", "T ", "a", "5"), ("7", "t", None, "5"), (None, "t", "A", "5"),
    (None, None, None, None), ("7", None, "t", "5"), ("8", "t", "A", "5"),
]


@pytest.mark.parametrize("collide", [False, True])
def test_provider_groups_follow_the_texts(spark, monkeypatch, collide):
    if collide:  # as if all texts had one hash code
        monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(1).cast("long"))
    groups = groups_of(spark, TEXTS)
    named = {tuple(r[:2]): tuple(r[2:]) for r in groups.texts.collect()}
    members = {r["Provider__c"]: named[(r["_code"], r["_place"])] for r in groups.members.collect()}
    assert members[0] == members[1] == ("7", "T ", "a", "5")
    assert {i: m for i, m in members.items() if i > 1} == {i: t for i, t in enumerate(TEXTS) if i > 1}
    assert len(named) == 6


def test_distinct_chase_map(spark):
    from goldkeel.operators.chase import SHOWN, distinct_chase_map

    types = "Location__c long, Provider__c long, " + ", ".join(f"{c} string" for c in SHOWN) + ", key_phone string"
    pairs = spark.createDataFrame([(i % 4, p, *t, t[3]) for i in range(8) for p, t in enumerate(TEXTS)], types)
    lids = spark.createDataFrame([("x", 0), ("x", 1), ("y", 2)], "NEW_LID_ALL string, Location__c long")
    got = rows(distinct_chase_map(lids, pairs, hot_rows=5))
    assert got == rows(distinct_chase_map(lids, pairs)) and len(got) == 2 * 6
