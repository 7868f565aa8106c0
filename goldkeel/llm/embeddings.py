"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Two vectors within an angle have a midpoint within half of it from both. The
midpoint lies in some cell, so each vector visits, beside its own, every cell
whose border (the plane between the two centroids) is no farther than that half
angle's chord: each pair within the angle meets in the midpoint's cell. The
centroids therefore only decide how much is compared; what is found is exact.

Equal vectors of a label are one class first. A cell with many visitors is
split into blocks, and each pair of blocks compared by one matrix product. A
pair that meets in several cells counts in the first of them. Only counts and a
spanning forest leave a block, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeel.llm.components import connected_components
from goldkeel.session import stage

COSINE = 0.98
BLOCK = 512  # vectors on each side of a product
SAMPLE_PER_CELL = 24  # vectors the centroids are fitted on, for each cell
ROUNDS = 5
CELLS = 4096  # of centroids, which go to every task; with more vectors cells have more blocks
ROWS = 1024  # vectors assigned at a time, fewer if there are many cells
SLACK = 1e-9


def unit_rows(arrays: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of length one, shorter ones padded with zeros."""
    out = np.zeros((len(arrays), width))
    flat = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(arrays.offsets.to_numpy())
    if len(flat) == out.size:
        out = flat.reshape(out.shape)
    else:
        row = np.repeat(np.arange(len(sizes)), sizes)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    out /= np.abs(out).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def fit_centroids(classes: DataFrame, cells: int, width: int) -> np.ndarray:
    """Centroids of spherical k-means on a sample of about ``SAMPLE_PER_CELL``
    vectors for each cell. Only centroids pass the driver."""
    total = classes.count()
    share = min(1.0, SAMPLE_PER_CELL * cells / max(total, 1))
    lot = F.pmod(F.xxhash64(F.lit("centroids"), "rep", "label"), F.lit(1_000_000))
    sample = stage(classes.where(lot < math.ceil(share * 1_000_000)).select("rep", "label", "vector"), "sample")
    first = sample.orderBy(F.xxhash64("rep", "label"), "rep", "label").limit(cells).select("vector")
    centroids = unit_rows(pa.array([r[0] for r in first.collect()], pa.list_(pa.float64())), width)
    for _ in range(ROUNDS):

        def sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray = centroids) -> Iterator[pa.RecordBatch]:
            totals = np.zeros_like(centroids)
            for batch in batches:
                rows = unit_rows(batch.column("vector"), width)
                np.add.at(totals, np.argmax(rows @ centroids.T, axis=1), rows)
            used = np.flatnonzero(np.abs(totals).sum(axis=1))
            for part in np.array_split(used, max(1, len(used) // ROWS)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), pa.array(list(totals[part]), pa.list_(pa.float64()))],
                    names=["cell", "total"],
                )

        added = sample.select("vector").mapInArrow(sums, "cell int, total array<double>")
        one = added.select("cell", F.posexplode("total").alias("place", "value"))
        one = one.groupBy("cell", "place").agg(F.sum("value").alias("value")).toPandas()
        moved = np.zeros_like(centroids)
        moved[one["cell"], one["place"]] = one["value"]
        norms = np.sqrt((moved * moved).sum(axis=1, keepdims=True))
        centroids = np.where(norms > 0, moved / np.where(norms > 0, norms, 1), centroids)
    return centroids


def visits(rows: np.ndarray, centroids: np.ndarray, chord: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of every cell each row visits, by row and then cell."""
    near = rows @ centroids.T
    own = np.argmax(near, axis=1)
    gap = near[np.arange(len(rows)), own][:, None] - near
    apart = np.sqrt(np.maximum(0, 2 - 2 * (centroids[own] @ centroids.T)))
    return np.nonzero(gap <= chord * apart + SLACK)


def _meetings(classes: DataFrame, centroids: np.ndarray, cosine: float) -> DataFrame:
    half = math.acos(cosine) / 2
    chord, width = 2 * math.sin(half / 2), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(16, min(ROWS, (1 << 20) // len(centroids)))
            for low in range(0, whole.num_rows, step):
                batch = whole.slice(low, step)
                row, cell = visits(unit_rows(batch.column("vector"), width), centroids, chord)
                firsts = np.searchsorted(row, row)  # where a row's visits begin
                earlier = [cell[a:b].astype(np.int32) for a, b in zip(firsts, range(len(row)), strict=True)]
                taken = [batch.column(n).take(pa.array(row)) for n in ("label", "dims", "rep", "size", "vector")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), *taken, pa.array(earlier, pa.list_(pa.int32()))],
                    names=["cell", "label", "dims", "rep", "size", "vector", "earlier"],
                )

    kinds = dict(classes.dtypes)
    schema = (
        f"cell int, label {kinds['label']}, dims int, rep long, size long, vector {kinds['vector']}, earlier array<int>"
    )
    return classes.select("label", "dims", "rep", "size", "vector").mapInArrow(run, schema)


def compare(table: pa.Table, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rep, vectors linked, smallest rep reached within the block pair) of one
    cell's pair of blocks; ``side`` tells the blocks apart, 2 is a block with
    itself."""
    width = int(table.column("dims")[0].as_py())
    rows = unit_rows(table.column("vector").combine_chunks(), width)
    side, rep, size = (table.column(n).to_numpy() for n in ("side", "rep", "size"))
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    near = rows[left] @ rows[right].T
    for i, j in zip(*np.nonzero(np.abs(near - cosine) < SLACK), strict=True):
        x, y = (np.asarray(table.column("vector")[int(k)].as_py(), np.float64) for k in (left[i], right[j]))
        near[i, j] = x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y))
    linked = (near >= cosine) & (left[:, None] != right[None, :])
    earlier = [np.asarray(x) for x in table.column("earlier").to_pylist()]
    cells, column = np.unique(np.concatenate([np.zeros(0, int), *earlier]), return_inverse=True)
    met = np.zeros((len(rows), len(cells)), np.float32)
    met[np.repeat(np.arange(len(rows)), [len(e) for e in earlier]), column] = 1
    counted = linked & (met[left] @ met[right].T == 0)
    links = np.zeros(len(rows), np.int64)
    links[left] += counted @ size[right]
    if (side != 2).any():
        links[right] += counted.T @ size[left]
    # The smallest representative spreads along links until it rests.
    least = rep.copy()
    while True:
        spread = least.copy()
        if linked.any():
            far = np.iinfo(np.int64).max
            np.minimum.at(spread, left, np.where(linked, least[right][None, :], far).min(axis=1))
            np.minimum.at(spread, right, np.where(linked, least[left][:, None], far).min(axis=0))
        if np.array_equal(spread, least):
            return rep, links, least
        least = spread


def near_links(classes: DataFrame, centroids: np.ndarray, cosine: float, block: int) -> DataFrame:
    """(rep, links, least): for each class and meeting, how many vectors link
    with it there and the smallest class it reaches there."""
    met = stage(_meetings(classes, centroids, cosine), "meetings")
    keys = ["label", "dims", "cell"]
    # As many rows as there are cells and labels.
    sizes = met.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    marked = met.join(sizes, keys)
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    paired = marked.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    dealt = paired.select(
        *keys,
        F.least("own", "other").alias("one"),
        F.greatest("own", "other").alias("two"),
        side.alias("side"),
        "rep",
        "size",
        "vector",
        "earlier",
    )

    def run(table: pa.Table) -> pa.Table:
        rep, links, least = compare(table, cosine)
        told = (links > 0) | (least != rep)
        return pa.table({"rep": rep[told], "links": links[told], "least": least[told]})

    return dealt.groupBy(*keys, "one", "two").applyInArrow(run, "rep long, links long, least long")


def near_duplicates(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    block: int = BLOCK,
    cells: int = CELLS,
) -> DataFrame:
    """(id, ``n_links``, ``component_id``, ``kept``) of every row.

    Vectors link if their labels and lengths are equal and their cosine is at
    least ``cosine``. A null id, label or vector, a null or non-finite component
    and a zero vector link nothing: no links, a component of one's own (null
    for a null id), kept unless the id is null. Repeated rows count as vectors
    of their own; rows that share an id share a component. Other columns are
    not read. An empty table gives none.
    """
    chosen = vectors.select(F.col(id).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    ) & F.exists("vector", lambda x: x != 0)
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite
    rows = chosen.withColumn("usable", F.coalesce(usable, F.lit(False)))
    grouped = rows.where("usable").groupBy("label", "vector").agg(
        F.min("id").cast("long").alias("rep"), F.count(F.lit(1)).alias("size")
    )
    classes = stage(grouped.withColumn("dims", F.size("vector")), "classes")
    total, width = classes.agg(F.count(F.lit(1)), F.max("dims")).first()
    found = None
    if total:
        centroids = fit_centroids(classes, min(cells, math.ceil(math.sqrt(total))), width)
        found = stage(near_links(classes, centroids, cosine, block), "links")
    else:
        found = vectors.sparkSession.createDataFrame([], "rep long, links long, least long")
    parts = connected_components(found.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    # A rep may stand for several classes if ids repeat; links go by label and vector then.
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = (
        classes.join(counts, "rep", "left")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select(
            "label",
            "vector",
            F.lit(True).alias("usable"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    joined = rows.join(named, ["label", "vector", "usable"], "left")
    component = F.coalesce("component", "id").cast("long")
    return joined.select(
        F.col("id").alias(id),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
