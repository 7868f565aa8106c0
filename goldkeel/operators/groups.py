"""Building blocks that keep every task bounded when a few keys are huge.

A key is *hot* when it holds more than ``hot_rows`` rows, or, should more than
``MAX_HOT_KEYS`` keys do so, when it holds more than ``N / MAX_HOT_KEYS`` of a
table's N rows. Fewer than ``MAX_HOT_KEYS`` keys can, so the list of hot keys
is bounded by this rule itself and may be broadcast. It only decides how rows
travel, never which rows count. What stays together in one task is at most
``max(hot_rows, N / MAX_HOT_KEYS)`` rows of a key. Operators count the rows per
key first, which map tasks combine before the shuffle; that count is a job that
runs while the plan is made. Without hot keys, the usual case, the plain join
or window is all that remains of the plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 50_000


def hot_groups(
    df: DataFrame, keys: Sequence[str], hot_rows: int, aggregates: Sequence[Column] = ()
) -> DataFrame | None:
    """The hot keys, with aggregates over their rows, or None if there are none."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
    largest = sizes.where(F.col("_rows") > hot_rows).limit(MAX_HOT_KEYS + 1).collect()
    if len(largest) > MAX_HOT_KEYS:
        largest = sizes.where(F.col("_rows") > max(hot_rows, df.count() / MAX_HOT_KEYS)).collect()
    if not largest:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(largest, sizes.schema).drop("_rows"))


def first_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Mapping[str, Column],
    folded: Mapping[str, Column] | None = None,
    total_order: bool = False,
) -> DataFrame:
    """One row per key, the first in ``order``; remaining columns break ties
    unless the order is total already.

    ``folded`` may replace key columns by the value they group under. Spark
    turns the rank filter into a group limit before the shuffle, so each map
    task sends at most one row per key, however large the group.
    """
    folded = folded or {}
    settled = {*(k for k in keys if k not in folded), *order}
    ties = [] if total_order else [F.col(c).asc() for c in df.columns if c not in settled]
    window = Window.partitionBy(*[folded.get(k, F.col(k)) for k in keys]).orderBy(*order.values(), *ties)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def counted(df: DataFrame, by: Sequence[str], folded: Mapping[str, Column], count: str) -> DataFrame:
    """Rows per group of folded text, showing the smallest original spelling.

    Spellings are counted by hash first; only the few distinct ones are folded.
    """
    spellings = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count))
    keys = {c: folded.get(c, F.col(c)).alias("_key_" + c) for c in by}
    # The smallest of a set, as a minimum of texts would sort all rows.
    least = [F.array_min(F.collect_set(c)).alias(c) for c in by]
    merged = spellings.groupBy(*keys.values()).agg(*least, F.sum(count).alias(count))
    # Always true; it keeps the counts, and with them the first step, in plans
    # that only use the names.
    return merged.where(F.col(count) > 0).select(*by, count)


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[prefix + key])
    return condition


def _hot_codes(df: DataFrame, key_sets: Sequence[Sequence[str]], hot_rows: int) -> list[list[int]]:
    """Hash codes of the hot keys under each set of key columns, from one count."""
    codes = F.array(*[F.xxhash64(*keys) for keys in key_sets])
    sizes = df.select(F.posexplode(codes).alias("no", "code")).groupBy("no", "code").agg(F.count(F.lit(1)).alias("rows"))
    most = MAX_HOT_KEYS * len(key_sets)
    largest = sizes.where(F.col("rows") > hot_rows).limit(most + 1).collect()
    if len(largest) > most:
        largest = sizes.where(F.col("rows") > max(hot_rows, df.count() / MAX_HOT_KEYS)).collect()
    return [[r["code"] for r in largest if r["no"] == no] for no in range(len(key_sets))]


class GroupTotal(NamedTuple):
    """An aggregate over the rows that share some key columns."""

    name: str
    keys: Sequence[str]
    aggregate: Column


def with_group_totals(
    df: DataFrame, totals: Sequence[GroupTotal], spread_by: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add aggregates over key groups as columns, keeping every row.

    Cold groups are totalled by a window. Rows of hot groups take their total
    from the broadcast list, and their window partition is scattered by the
    hash of ``spread_by``, so no task ever holds a hot group. The hot groups of
    all totals are found by one job that reads the input once more; stage it if
    it is costly.
    """
    result = df
    hot_codes = _hot_codes(df, [total.keys for total in totals], hot_rows)
    for total, codes in zip(totals, hot_codes, strict=True):
        keys, columns = list(total.keys), result.columns
        if not codes:
            result = result.withColumn(total.name, total.aggregate.over(Window.partitionBy(*keys)))
            continue
        # Keys that share the code of a hot one are treated as hot, too.
        listed = F.broadcast(df.sparkSession.createDataFrame([(c,) for c in codes], "_code long"))
        hot = df.join(listed, F.xxhash64(*keys) == F.col("_code"), "left_semi")
        hot = F.broadcast(hot.groupBy(*keys).agg(total.aggregate.alias("_total")))
        hot = hot.select(*[F.col(k).alias("_key_" + k) for k in keys], "_total", F.lit(True).alias("_is_hot"))
        marked = result.join(hot, _same_keys(result, hot, keys, "_key_"), "left")
        spread = F.when(F.col("_is_hot"), F.xxhash64(*spread_by)).otherwise(F.lit(0))
        window = Window.partitionBy(*keys, "_spread")
        value = F.when(F.col("_is_hot"), F.col("_total")).otherwise(total.aggregate.over(window))
        result = marked.withColumn("_spread", spread).select(*columns, value.alias(total.name))
    return result


def join_on_unique(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Inner join of many rows to a table with about one row per key.

    Rows of hot keys meet their partner by broadcast, provided that the table
    does hold few rows of them; the rest is an ordinary shuffle join. Both
    tables name the key columns alike. If ``left`` is costly, ``key_source``
    may name a cheaper table with at least its rows.
    """
    keys = list(keys)
    left = left.dropna(subset=keys)
    hot = hot_groups(left if key_source is None else key_source.dropna(subset=keys), keys, hot_rows)
    if hot is None:
        return left.join(right, keys)
    partners = right.join(hot, keys, "left_semi")
    if partners.limit(MAX_HOT_KEYS + 1).count() > MAX_HOT_KEYS:
        return left.join(right, keys)
    by_broadcast = left.join(F.broadcast(partners), keys)
    by_shuffle = left.join(hot, keys, "left_anti").join(right, keys)
    return by_shuffle.unionByName(by_broadcast)


def unseen(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is not in the target.

    Only the target's key column is read, and it meets the (usually far
    smaller) source first, so a small source never makes the target shuffle.
    """
    known = target.select(key).join(source.select(key), key, "left_semi")
    return source.join(known, key, "left_anti")


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark for broadcast after counting at most ``max_rows + 1`` rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
