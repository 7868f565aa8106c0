"""Exact top-k inner products by a bit-sliced index.

The index holds vectors in blocks. A block keeps no vector whole: for each
attribute it has one bitmap per binary digit of the quantised values, a bit per
row. A query adds the slices its own digits ask for, all rows of a block at
once and 64 to a machine word: slices of one weight are added three at a time
into a sum and a carry of the next weight. What is left is again a list of
bitmaps, the digits of every row's score. From the most significant one
downward a row is certainly among the best, or still level with the last of
them; rows level after the last digit have equal scores, and ids decide.

Blocks of queries meet blocks of the index by a join on the lane of the index
block, which shuffles both, so that neither side is ever gathered. A pair of
blocks passes on ``k`` rows for each query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldkeel.session import stage

ROWS = 16384  # vectors of an index block
QUERIES = 512  # vectors of a query block
LANES = 1024
SCALE = 256
BLOCK = "ids binary, slices binary, lowest binary, digits int"


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bitmaps by attribute and digit, smallest value by attribute) of rows of
    integers; a digit is that of the value less the attribute's smallest."""
    lowest = values.min(axis=0)
    above = (values - lowest).T
    digits = max(1, int(above.max(initial=0)).bit_length())
    words = -(-len(values) // 64)
    maps = np.zeros((len(lowest), digits, words * 8), np.uint8)
    for digit in range(digits):
        packed = np.packbits((above >> digit & 1).astype(np.uint8), axis=1, bitorder="little")
        maps[:, digit, : packed.shape[1]] = packed
    return maps.view("<u8"), lowest


def _added(planes: list[list[np.ndarray]], words: int) -> list[np.ndarray]:
    """The digits of the sum, lowest first, of bitmaps given by their weight."""
    total, carried = [], [np.zeros((0, words), np.uint64)]
    weight = 0
    while weight < len(planes) or any(len(c) for c in carried):
        level = np.concatenate(carried + (planes[weight] if weight < len(planes) else []))
        carried = [np.zeros((0, words), np.uint64)]
        while len(level) > 1:
            third = max(1, len(level) // 3)
            a, b = level[:third], level[third : 2 * third]
            either = a ^ b
            if len(level) == 2:
                carried.append(a & b)
                level = either
                break
            c = level[2 * third : 3 * third]
            carried.append((a & b) | (either & c))
            level = np.concatenate([either ^ c, level[3 * third :]])
        total.append(level[0] if len(level) else np.zeros(words, np.uint64))
        weight += 1
    return total


def scores_in_slices(maps: np.ndarray, lowest: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """(digits, offset): a row's score is its number in the digits plus the
    offset. A negative factor takes the complement of an attribute, so that
    only sums occur."""
    width, digits, words = maps.shape
    size = [abs(int(x)) for x in query]
    highest = (1 << digits) - 1
    offset = sum(int(x) * int(low) - (n * highest if x < 0 else 0) for x, low, n in zip(query, lowest, size, strict=True))
    planes: list[list[np.ndarray]] = []
    for bit in range(max(size, default=0).bit_length()):
        asked = np.array([n >> bit & 1 == 1 for n in size])
        plus, minus = maps[asked & (query > 0)], ~maps[asked & (query < 0)]
        for digit in range(digits):
            while len(planes) <= bit + digit:
                planes.append([])
            planes[bit + digit] += [plus[:, digit], minus[:, digit]]
    return _added(planes, words), offset


def best_rows(digits: list[np.ndarray], among: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest numbers among the rows of a bitmap, the
    earliest of equal ones, in no order."""
    sure, level = np.zeros_like(among), among.copy()
    for digit in reversed(digits):
        ones = level & digit
        count = int(np.bitwise_count(sure | ones).sum())
        if count > k:
            level = ones
        else:
            sure, level = sure | ones, level & ~digit
            if count == k:
                break

    def places(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    certain = places(sure)
    return np.concatenate([certain, places(level)[: k - len(certain)]])


def numbers_at(digits: list[np.ndarray], places: np.ndarray) -> list[int]:
    """The numbers that the digits spell at some rows."""
    found = [0] * len(places)
    for weight, digit in enumerate(digits):
        for n, bit in enumerate(digit[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)):
            found[n] |= int(bit) << weight
    return found


def _rows(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, values) of a batch; short vectors go on with zeros."""
    ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.zeros((len(ids), width), np.int64)
    held = batch.column("values")
    sizes = np.diff(held.offsets.to_numpy())
    row = np.repeat(np.arange(len(ids)), sizes)
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    values[row, place] = held.flatten().to_numpy(zero_copy_only=False)
    return ids, values


def _blocks(batches: Iterator[pa.RecordBatch], width: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a partition, ``most`` at a time, each block by rising id."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def whole(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        ids, values = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(ids, kind="stable")
        return ids[order], values[order]

    for batch in batches:
        for low in range(0, batch.num_rows, most):
            ids, values = _rows(batch.slice(low, most), width)
            room = most - sum(len(i) for i, _ in held)
            held.append((ids[:room], values[:room]))
            if len(ids) >= room:
                yield whole(held)
                held = [(ids[room:], values[room:])] if len(ids) > room else []
    if held:
        yield whole(held)


def build_index(vectors: DataFrame, total: int, width: int, rows: int = ROWS) -> DataFrame:
    """One row per block: sorted ids, slices, smallest values, and its lane."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in _blocks(batches, width, rows):
            maps, lowest = slices_of(values)
            held = [[ids.tobytes()], [maps.tobytes()], [lowest.tobytes()], [maps.shape[1]]]
            kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int32()]
            columns = [pa.array(x, kind) for x, kind in zip(held, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "slices", "lowest", "digits"])

    blocks = max(1, math.ceil(total / rows))
    built = vectors.repartition(blocks).mapInArrow(run, BLOCK)
    return built.withColumn("lane", F.spark_partition_id() % min(blocks, LANES))


def query_blocks(queries: DataFrame, total: int, width: int, most: int = QUERIES) -> DataFrame:
    """(query_ids, marks, factors) in blocks; a mark tells apart the vectors of
    one id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in _blocks(batches, width + 1, most):
            columns = [pa.array([x.tobytes()], pa.binary()) for x in (ids, values[:, -1], values[:, :-1])]
            yield pa.RecordBatch.from_arrays(columns, names=["query_ids", "marks", "factors"])

    # The mark travels as a last component, behind those of the width.
    filler = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("values"))
    marked = F.concat("values", filler, F.array(F.xxhash64("values")))
    blocks = queries.distinct().select("id", marked.alias("values")).repartition(max(1, math.ceil(total / most)))
    return blocks.mapInArrow(run, "query_ids binary, marks binary, factors binary")


def _searched(pairs: DataFrame, width: int, k: int) -> DataFrame:
    """(query_id, mark, vec_id, score) of the best rows of every pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                lowest = np.frombuffer(row["lowest"], np.int64)
                maps = np.frombuffer(row["slices"], "<u8").reshape(width, row["digits"], -(-len(ids) // 64))
                everyone = np.zeros(maps.shape[2] * 64, np.uint8)
                everyone[: len(ids)] = 1
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                factors = np.frombuffer(row["factors"], np.int64).reshape(len(query_ids), width)
                marks = np.frombuffer(row["marks"], np.int64).tolist()
                found: tuple[list, ...] = ([], [], [], [])
                for query_id, mark, query in zip(query_ids.tolist(), marks, factors, strict=True):
                    others = everyone.copy()
                    others[np.searchsorted(ids, query_id) : np.searchsorted(ids, query_id, side="right")] = 0
                    among = np.packbits(others, bitorder="little").view("<u8")
                    digits, offset = scores_in_slices(maps, lowest, query)
                    places = best_rows(digits, among, k)
                    found[0].extend([query_id] * len(places))
                    found[1].extend([mark] * len(places))
                    found[2].extend(ids[places].tolist())
                    found[3].extend(n + offset for n in numbers_at(digits, places))
                columns = [pa.array(x, pa.int64()) for x in found]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "mark", "vec_id", "score"])

    return pairs.mapInArrow(run, "query_id long, mark long, vec_id long, score long")


def top_k(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    every: int = 50,
    k: int = 5,
    scale: int = SCALE,
    rows: int = ROWS,
    queries: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by
    ``every``, the ``k`` others of the largest inner product.

    A component x counts as ``floor(scale * x)``; all arithmetic is in integers
    and exact. Equal scores go by the smaller id. Fewer others than ``k`` are
    all returned. A null id or vector and null or non-finite components keep a
    row out of both sides. Shorter vectors go on with zeros. Rows that share an
    id are one item: none is a candidate of its own queries, as candidates of
    others and as queries each counts, so a repeated query id has the best of
    all its rows, a pair of ids with one score once. Other columns are not
    read. An empty table gives no rows. Scores that could pass 64 bits raise
    ``OverflowError``.
    """
    chosen = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**40 / scale))
    infinite = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = chosen.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~infinite)
    integers = F.transform("vector", lambda x: F.floor(x * scale))
    is_query = F.pmod("id", F.lit(every)) == 0
    total, asked, width, largest, fits = whole.agg(
        F.count(F.lit(1)),
        F.count(F.when(is_query, 1)),
        F.coalesce(F.max(F.size("vector")), F.lit(0)),
        F.coalesce(F.max(F.array_max(F.transform(integers, F.abs))), F.lit(0)),
        F.coalesce(F.min(finite), F.lit(True)),
    ).first()
    if not fits or width * largest * largest >= 1 << 63:
        raise OverflowError("scores could pass 64 bits; use a smaller scale")
    whole = whole.select("id", integers.alias("values"))
    index = stage(build_index(whole, total, width, rows), "index")
    asking = stage(query_blocks(whole.where(is_query), asked, width, queries), "queries")
    lanes = min(max(1, math.ceil(total / rows)), LANES)
    # Each lane of the index sees each block of queries once. Spark takes these
    # copies for as small as the packed file of one, so it must not broadcast them.
    spread = asking.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    found = _searched(index.hint("merge").join(spread, "lane"), width, k)
    place = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), "vec_id"))
    best = found.withColumn("rank", place).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
