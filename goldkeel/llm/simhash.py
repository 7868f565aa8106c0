"""Near-duplicate texts by SimHash, linked through the anchors of a covering code.

The anchors are the code words of two binary Golay codes side by side, which
cover the low 46 bits of a fingerprint: in each half every word lies within
the covering radius 3 of exactly one code word. Two fingerprints at up to k
bits have a midpoint at up to k / 2 bits, rounded up, from both, and the
midpoint has an anchor; so a fingerprint goes to every anchor it could share
with a partner: those that exceed the radius by at most so many bits, both
halves added up. At
each anchor all arrivals are compared over their full 64 bits. The search is
exact: no link is missed, whatever the data.

Equal fingerprints are one class before anything is replicated. An anchor with
very many arrivals is split into blocks, and each pair of blocks compared in
its own group. Within a group only a spanning forest is kept: the result needs
reachability, so a dense group never emits all its pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeel.llm.components import connected_components
from goldkeel.operators.groups import broadcast_if_small
from goldkeel.session import stage

# Fixed values of the binary Golay code: length, covering radius and the
# generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
LENGTH = 23
RADIUS = 3
GENERATOR = 0b110001110101

SEED = 42  # of XXH64
SHINGLE_WORDS = 4
MAX_BITS = 4
CHUNK = 1 << 16  # shingles hashed at a time
BLOCK = 4096  # arrivals of an anchor that are compared in one group
MAX_SPLIT = 100_000  # split anchors whose list goes to every task; a longer one is joined by a shuffle


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text, as an unsigned number.

    Words are what ASCII white space separates, A-Z in lower case. A bit is set
    if it is in more than half of the shingles' XXH64, repeats included. Fewer
    words than a shingle make one shingle; no word gives zero.
    """
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    width = min(words, len(tokens))
    starts = list(itertools.accumulate((len(t) + 1 for t in tokens), initial=0))
    n = len(tokens) - width + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, CHUNK):
        high = min(n, low + CHUNK)
        spans = zip(starts[low:high], starts[low + width : high + width], strict=True)
        hashes = np.array([digest(joined[s : e - 1], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS, to: str = "fp") -> DataFrame:
    """Add the fingerprint as a signed long; a null text counts as empty."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, words) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(to, of(F.col(text)))


class GolayAnchors:
    """Code words near a 23-bit word, looked up by the word's syndrome."""

    def __init__(self, beyond: int) -> None:
        units = [self._remainder(1 << i) for i in range(LENGTH)]
        size = 1 << (LENGTH - 12)
        lists: list[list[list[int]]] = [[[] for _ in range(size)] for _ in range(beyond + 1)]
        for weight in range(RADIUS + beyond + 1):
            for places in itertools.combinations(range(LENGTH), weight):
                syndrome = error = 0
                for i in places:
                    syndrome ^= units[i]
                    error |= 1 << i
                lists[max(0, weight - RADIUS)][syndrome].append(error)
        self.errors, self.starts = [], []
        for by_syndrome in lists:
            self.errors.append(np.array([e for es in by_syndrome for e in es], np.int64))
            self.starts.append(np.cumsum([0, *map(len, by_syndrome)]))
        self.bytes = np.zeros((3, 256), np.int64)
        for place, value in itertools.product(range(3), range(256)):
            for bit in range(8):
                if value >> bit & 1 and 8 * place + bit < LENGTH:
                    self.bytes[place, value] ^= units[8 * place + bit]

    @staticmethod
    def _remainder(word: int) -> int:
        for bit in range(LENGTH - 1, LENGTH - 13, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    def near(self, words: np.ndarray, beyond: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of word, code word's 12 information bits) of all code words
        that exceed the radius by exactly ``beyond`` bits; 0 is the one inside."""
        syndromes = self.bytes[0][words & 255] ^ self.bytes[1][words >> 8 & 255] ^ self.bytes[2][words >> 16]
        low, high = self.starts[beyond][syndromes], self.starts[beyond][syndromes + 1]
        index = np.repeat(np.arange(len(words)), high - low)
        place = np.arange(len(index)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[index]
        return index, (words[index] ^ self.errors[beyond][place]) >> 11


def anchors_of(code: GolayAnchors, fps: np.ndarray, beyond: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of fingerprint, anchor) for every anchor a fingerprint visits."""
    mask = (1 << LENGTH) - 1
    halves = [fps & mask, fps >> LENGTH & mask]
    lists = [[code.near(half, b) for b in range(beyond + 1)] for half in halves]
    index, anchor = [], []
    for b0, b1 in itertools.product(range(beyond + 1), repeat=2):
        if b0 + b1 > beyond:
            continue
        (i0, c0), (i1, c1) = lists[0][b0], lists[1][b1]
        counts = np.bincount(i1, minlength=len(fps))
        firsts = np.cumsum(counts) - counts
        times = counts[i0]
        left = np.repeat(np.arange(len(i0)), times)
        place = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + firsts[i0[left]]
        index.append(i0[left])
        anchor.append(c0[left] << 12 | c1[place])
    return np.concatenate(index), np.concatenate(anchor)


def bits_beyond(max_bits: int) -> int:
    """By how many bits visited anchors exceed the radius: a midpoint of two
    fingerprints at an odd number of bits is nearer to one than to the other."""
    return (max_bits + 1) // 2


def _visits(classes: DataFrame, max_bits: int) -> DataFrame:
    beyond = bits_beyond(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = GolayAnchors(beyond)
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                fps, reps = (part.column(n).to_numpy(zero_copy_only=False) for n in ("fp", "rep"))
                index, anchor = anchors_of(code, fps, beyond)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype(np.int32)), pa.array(fps[index]), pa.array(reps[index])],
                    names=["anchor", "fp", "rep"],
                )

    return classes.select("fp", "rep").mapInArrow(run, "anchor int, fp long, rep long")


def _forest(key: np.ndarray, fp: np.ndarray, rep: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (rep, smallest rep of its group) within runs of equal keys.

    Rows are compared at growing distance within their run; rows already known
    to be together are not compared again, so a dense run soon gets cheap.
    """
    n = len(key)
    group = np.arange(n)
    left, shift = np.arange(n), 0
    while True:
        shift += 1
        left = left[: np.searchsorted(left, n - shift)]
        left = left[key[left] == key[left + shift]]
        if not len(left):
            break
        apart = left[group[left] != group[left + shift]]
        near = apart[np.bitwise_count((fp[apart] ^ fp[apart + shift]).view(np.uint64)) <= max_bits]
        if len(near):
            parent = group  # group[i] is a root, and a root points to itself

            def root(i: int, parent: np.ndarray = parent) -> int:
                while parent[i] != i:
                    i = parent[i]
                return i

            for i in near.tolist():
                a, b = root(i), root(i + shift)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            while not np.array_equal(up := parent[parent], parent):
                parent = up
            group = parent
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, group, rep)
    to = least[group]
    linked = to != rep
    return rep[linked], to[linked]


def _compare(visits: DataFrame, max_bits: int) -> DataFrame:
    def links(key: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
        a, b = _forest(key, fp, rep, max_bits)
        pairs = np.unique(np.stack([a, b], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            now = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("anchor", "pair", "fp", "rep")]
            if kept is not None:
                now = [np.concatenate(x) for x in zip(kept, now, strict=True)]
            anchor, pair = now[:2]
            # Runs of one anchor and pair, numbered; the last may go on in the next batch.
            run_no = np.cumsum(np.append(0, (anchor[1:] != anchor[:-1]) | (pair[1:] != pair[:-1])))
            run_no = run_no[: len(anchor)]
            end = int(np.searchsorted(run_no, run_no[-1])) if len(anchor) else 0
            if end:
                yield links(run_no[:end], *(x[:end] for x in now[2:]))
            kept = [x[end:] for x in now]
        if kept is not None and len(kept[0]):
            yield links(np.zeros(len(kept[0]), np.int64), *kept[2:])

    dealt = visits.repartition("anchor", "pair").sortWithinPartitions("anchor", "pair")
    return dealt.mapInArrow(run, "a long, b long")


def near_links(classes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between the representatives ``rep`` of classes with
    distinct fingerprints ``fp``, enough to reach whatever is reachable over
    links of at most ``max_bits`` differing bits.

    An anchor with more than ``block`` arrivals is split into blocks of about
    that size, so no group grows with the data. The list of split anchors is
    broadcast only if it is counted to be short.
    """
    visits = _visits(classes, max_bits)
    split = visits.groupBy("anchor").count().where(F.col("count") > block)
    split = stage(split.select("anchor", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "split")
    marked = visits.join(broadcast_if_small(split, MAX_SPLIT), "anchor", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    paired = marked.select("anchor", "fp", "rep", own.alias("own"), other)
    pair = F.least("own", "other").cast("long") * (1 << 31) + F.greatest("own", "other")
    return _compare(paired.select("anchor", pair.alias("pair"), "fp", "rep"), max_bits)


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` (signed long), ``component_id``,
    the smallest id reachable over fingerprints at up to ``max_bits`` bits.

    Empty and null texts have fingerprint zero and link like any other; very
    long texts are read whole. Repeated rows stay. Fingerprints are what links:
    rows that share an id but are not near belong to components of their own. A
    row with a null id links nothing and has a null component. Of ``docs`` only
    the two named columns are read. An empty table gives none.
    """
    return grouped(docs, id, text, words, max_bits, block).drop("group")


def grouped(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    block: int = BLOCK,
) -> DataFrame:
    """The same rows, with ``group``, a name no other component has: two of
    them may have one smallest id if ids repeat."""
    chosen = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    rows = stage(fingerprints(chosen, "text", words).drop("text"), "fingerprints")
    named = rows.where("id is not null")
    smallest = named.groupBy("fp").agg(F.min("id").alias("least"))
    # A class is named by its fingerprint, as ids may repeat.
    classes = stage(smallest.withColumn("rep", F.col("fp")), "classes")
    found = connected_components(near_links(classes, max_bits, block))
    placed = classes.join(found, classes.rep == found.node, "left").select(
        "fp", "least", F.coalesce("component", "rep").alias("group")
    )
    placed = stage(placed, "groups")
    components = placed.groupBy("group").agg(F.min("least").alias("component"))
    joined = rows.join(placed.join(components, "group").select("fp", "group", "component"), "fp", "left")
    component = F.when(F.col("id").isNotNull(), F.col("component"))
    return joined.select(F.col("id").alias(id), "fp", component.alias("component_id"), "group")
