"""Chart counts at a location by combinations of NPI, TIN, address and phone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldkeel.functions.text import DEFAULT_RULES, TextRules
from goldkeel.operators.charts import PAIR
from goldkeel.operators.groups import HOT_ROWS, GroupTotal, hot_groups, with_group_totals

PAIRS_PER_TASK = 50_000  # each becomes up to 15 rows there
KEYS = ("key_npi", "key_tin", "key_address", "key_full_address", "key_phone")

# Count column and the keys it is taken over beside the location.
GRAINS: Mapping[str, tuple[str, ...]] = {
    "charts_at_loc": (),
    "CountOfCharts_atLoc_byNpiTinAddPhone": ("key_npi", "key_tin", "key_address", "key_phone"),
    "CountOfCharts_atLoc_byNpiAddPhone": ("key_npi", "key_address", "key_phone"),
    "CountOfCharts_atLoc_byNpiPhone": ("key_npi", "key_phone"),
    "CountOfCharts_atLoc_byNpiAdd": ("key_npi", "key_address"),
    "CountOfCharts_atLoc_byNpiTinAdd": ("key_npi", "key_tin", "key_address"),
    "CountOfCharts_atLoc_byNpiTin": ("key_npi", "key_tin"),
    "CountOfCharts_atLoc_byNpiTinPhone": ("key_npi", "key_tin", "key_phone"),
    "CountOfCharts_atLoc_byTinAddPhone": ("key_tin", "key_address", "key_phone"),
    "CountOfCharts_atLoc_byTinPhone": ("key_tin", "key_phone"),
    "CountOfCharts_atLoc_byTinAdd": ("key_tin", "key_full_address"),
    "CountOfCharts_atLoc_byPhone": ("key_phone",),
    "CountOfCharts_atLoc_byAddress": ("key_address",),
    "CountOfCharts_atLoc_byNpi": ("key_npi",),
    "CountOfCharts_atLoc_byTin": ("key_tin",),
}

# The grains the earlier form of the chase list sums.
SESSION_GRAINS = (
    "charts_at_loc",
    "CountOfCharts_atLoc_byNpiTinAddPhone",
    "CountOfCharts_atLoc_byNpiAddPhone",
    "CountOfCharts_atLoc_byNpiPhone",
    "CountOfCharts_atLoc_byNpiAdd",
    "CountOfCharts_atLoc_byTinAddPhone",
    "CountOfCharts_atLoc_byTinPhone",
    "CountOfCharts_atLoc_byTinAdd",
    "CountOfCharts_atLoc_byPhone",
    "CountOfCharts_atLoc_byAddress",
)


def grain_keys(name: str, address_mode: str = "lines") -> list[str]:
    """Key columns of a grain; in mode 'full' every address is the full one."""
    keys = GRAINS[name]
    if address_mode == "full":
        return ["key_full_address" if k == "key_address" else k for k in keys]
    return list(keys)


def _names(grains: Sequence[str] | None) -> list[str]:
    return list(GRAINS if grains is None else grains)


def _window_counts(pairs: DataFrame, names: Sequence[str], address_mode: str) -> DataFrame:
    """All counts by windows after a single exchange on the location.

    The windows of a chain partition by more and more of the same columns and
    order by the rest, so that one sort serves them all. Each chain has a copy
    of the location to partition by: the optimizer moves a window below one
    whose partition includes its own, which would take the chains apart.
    """
    chains = _chains({name: grain_keys(name, address_mode) for name in names})
    copies = {f"_location_{n}": F.col("Location__c") for n in range(len(chains))}
    counted = _by_location(pairs).withColumns(copies)
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    for location, chain in zip(copies, chains, strict=True):
        columns = list(dict.fromkeys(k for _, keys in reversed(chain) for k in keys))
        for name, keys in chain:
            window = Window.partitionBy(location, *columns[: len(keys)])
            rest = columns[len(keys) :]
            window = window.orderBy(*rest).rowsBetween(*whole) if rest else window
            counted = counted.withColumn(name, F.sum("chart_count").over(window))
    return counted.select(*pairs.columns, *names)


def _chains(keys: Mapping[str, Sequence[str]]) -> list[list[tuple[str, Sequence[str]]]]:
    """Grains in few chains, each grain's keys within those of the one before."""
    chains: list[list[tuple[str, Sequence[str]]]] = []
    for name in sorted(keys, key=lambda n: -len(keys[n])):
        home = next((c for c in chains if set(keys[name]) <= set(c[-1][1])), None)
        if home is None:
            chains.append(home := [])
        home.append((name, keys[name]))
    return chains


def _keyed_counts(pairs: DataFrame, names: Sequence[str], address_mode: str, hot_rows: int) -> DataFrame:
    """All counts by one total per (grain, location, keys).

    Each pair becomes one narrow row per grain, which spreads a single huge
    location over the cluster; the counts come back as columns of the pair.
    """

    def masked(name: str) -> str:
        kept = grain_keys(name, address_mode)
        fields = [f"'{k}', {k if k in kept else 'cast(null as string)'}" for k in KEYS]
        return f"named_struct('grain', '{name}', {', '.join(fields)})"

    one_per_grain = F.expr(f"inline(array({', '.join(masked(n) for n in names)}))")
    rows = pairs.select(*PAIR, "chart_count", one_per_grain)
    total = GroupTotal("total", ["grain", "Location__c", *KEYS], F.sum("chart_count"))
    rows = with_group_totals(rows, [total], PAIR, hot_rows)
    wide = rows.groupBy(*PAIR).agg(*[F.max(F.when(F.col("grain") == n, F.col("total"))).alias(n) for n in names])
    return pairs.join(wide, PAIR)


def chart_count_matrix(
    pairs: DataFrame,
    grains: Sequence[str] | None = None,
    address_mode: str = "lines",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pairs with the number of charts at their location under each grain.

    Stage ``pairs`` first: their locations are counted before the plan is made.
    """
    names = _names(grains)
    hot = hot_groups(pairs, ["Location__c"], hot_rows)
    if hot is None:
        return _window_counts(pairs, names, address_mode)
    by_window = _window_counts(pairs.join(hot, "Location__c", "left_anti"), names, address_mode)
    by_key = _keyed_counts(pairs.join(hot, "Location__c", "left_semi"), names, address_mode, hot_rows)
    return by_window.unionByName(by_key)


def summed_counts_per_location(
    pairs: DataFrame,
    grains: Sequence[str] | None = None,
    address_mode: str = "lines",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per location, the sum over its pairs of each grain's count.

    A group of p pairs with c charts contributes p * c, so two aggregations
    suffice and no pair row has to meet its group again. Pairs move once, by
    location, and take their grains there; those of hot locations are spread by
    grouping sets. Stage ``pairs`` first, as for the matrix.
    """
    names = _names(grains)
    narrow = pairs.select("Location__c", "chart_count", *KEYS)
    hot = hot_groups(narrow, ["Location__c"], hot_rows)
    if hot is None:
        return _sums_in_place(narrow, names, address_mode)
    cold = _sums_in_place(narrow.join(hot, "Location__c", "left_anti"), names, address_mode)
    spread = _sums_by_sets(narrow.join(hot, "Location__c", "left_semi"), names, address_mode)
    return cold.unionByName(spread)


def _by_location(pairs: DataFrame) -> DataFrame:
    """Pairs dealt out by location to tasks of about ``PAIRS_PER_TASK``."""
    parts = max(pairs.sparkSession.sparkContext.defaultParallelism, -(-pairs.count() // PAIRS_PER_TASK))
    return pairs.repartition(parts, "Location__c")


def _sums_in_place(pairs: DataFrame, names: Sequence[str], address_mode: str) -> DataFrame:
    """A row per pair and grain, made and added up in the task of the location."""

    def masked(number: int, name: str) -> Column:
        kept = grain_keys(name, address_mode)
        keys = [(F.col(k) if k in kept else F.lit(None).cast(pairs.schema[k].dataType)).alias(k) for k in KEYS]
        return F.struct(F.lit(number).alias("_grain"), *keys)

    one_per_grain = F.inline(F.array(*[masked(i, n) for i, n in enumerate(names)]))
    rows = _by_location(pairs).select("Location__c", "chart_count", one_per_grain)
    product = F.sum("chart_count") * F.count(F.lit(1))
    grouped = rows.groupBy("Location__c", "_grain", *KEYS).agg(product.alias("_product"))
    return grouped.groupBy("Location__c").agg(
        *[F.sum(F.when(F.col("_grain") == i, F.col("_product"))).alias(n) for i, n in enumerate(names)]
    )


def _sums_by_sets(pairs: DataFrame, names: Sequence[str], address_mode: str) -> DataFrame:
    """One row per pair and grain travels by all its keys."""
    sets = [[F.col("Location__c"), *[F.col(k) for k in grain_keys(n, address_mode)]] for n in names]
    group_id = {n: _grouping_id(grain_keys(n, address_mode)) for n in names}
    product = F.sum("chart_count") * F.count(F.lit(1))
    grouped = pairs.groupingSets(sets, F.col("Location__c"), *[F.col(k) for k in KEYS]).agg(
        F.grouping_id().alias("_grain"), product.alias("_product")
    )
    return grouped.groupBy("Location__c").agg(
        *[F.sum(F.when(F.col("_grain") == group_id[n], F.col("_product"))).alias(n) for n in names]
    )


def _grouping_id(kept: Sequence[str]) -> int:
    """Spark's grouping id: a set bit per key that is grouped away."""
    bits = ["0", *["0" if k in kept else "1" for k in KEYS]]
    return int("".join(bits), 2)


def chart_counts_at(
    pairs: DataFrame,
    npi: str | None = None,
    tin: str | None = None,
    address: str | None = None,
    phone: str | None = None,
    limit: int | None = None,
    rules: TextRules = DEFAULT_RULES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Spot check of one key: its pairs, how many share the key at the
    location, and how many charts they hold. A key left out is not tested."""
    wanted = {"key_npi": npi, "key_tin": tin, "key_full_address": address, "key_phone": phone}
    rows = pairs
    for key, value in wanted.items():
        if value is not None:
            rows = rows.where(F.col(key) == rules.literal(value))
    keys = ["Location__c", *wanted]
    totals = [
        GroupTotal("pairs_at_key", keys, F.count(F.lit(1))),
        GroupTotal("CountOfCharts_atLoc_byNpiTinAddPhone", keys, F.sum("chart_count")),
    ]
    found = with_group_totals(rows, totals, ["Provider__c"], hot_rows).select(
        *PAIR,
        "NPI__c",
        "TIN_ID__c",
        "FULL_ADDRESS",
        F.col("key_phone").alias("Phone_Number"),
        "pairs_at_key",
        "CountOfCharts_atLoc_byNpiTinAddPhone",
    )
    if limit is None:
        return found
    return found.orderBy("NPI__c", "TIN_ID__c", "FULL_ADDRESS", "Phone_Number", *PAIR).limit(limit)
