"""Byte-level BPE of whole texts, in overlapping chunks, and its inverse.

A long text is cut into chunks that overlap, each pre-tokenised and encoded by
a task of its own. The pattern of pre-tokens looks ahead but never back, so two
readings that share a boundary agree from there on: chunks are stitched at a
boundary that both found. Where the overlap holds none, as in one endless word,
the text is read on from the last sure boundary until a chunk agrees. Decoding
joins the bytes of the tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeel.llm.bpe_merges import Merges, PieceCache, spellings_of, splitter
from goldkeel.llm.common import columns, fresh, text_or_empty
from goldkeel.llm.token_counts import slices

CHUNK = 32_768  # characters a chunk begins after the one before
OVERLAP = 512
# A pre-token that ends so many characters before a chunk's end was found
# without looking at what lies beyond: contractions need two, white space one.
SURE = 4
# Bytes of texts, and tokens, that a worker holds decoded or encoded at a time,
# unless one text has more.
PORTION = 1 << 20
TOKENS = 1 << 18


def _portions(batch: pa.Array, sizes: pa.Array, most: int) -> Iterator[pa.Array]:
    """A batch in parts whose values have about ``most`` units together. What a
    worker and the executor hold of the results is that of a part, then, not
    of all rows that Spark sends at a time."""
    units = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = (np.cumsum(units) - units) // most
    firsts = np.flatnonzero(np.append(True, np.diff(number) > 0)).tolist()
    for begin, end in zip(firsts, [*firsts[1:], len(batch)], strict=True):
        yield batch.slice(begin, end - begin)


def encode_short(column: Column, ranks: str, pattern: str, decoded: bool = False) -> Column:
    """Token ids of texts that need no cutting; null gives null. With
    ``decoded`` a struct of the ``ids`` and the ``bytes`` they decode to, made
    by the same worker: one for each of the two would hold twice the memory."""

    @F.arrow_udf("struct<ids: array<int>, bytes: binary>" if decoded else "array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges = Merges.from_ranks(ranks)
        cache, words = PieceCache(merges), splitter(pattern)
        spellings = spellings_of(ranks) if decoded else None
        for batch in batches:
            for portion in _portions(batch, pc.binary_length(batch), PORTION):
                ids = _encode_all(portion, cache, words)
                if decoded:
                    ids = pa.StructArray.from_arrays([ids, _decode_all(ids, spellings)], names=["ids", "bytes"])
                yield ids

    # Used more than once, it would be worked out anew for each use.
    return encoded.asNondeterministic()(column)


def _encode_all(texts: pa.Array, cache: PieceCache, words: regex.Pattern) -> pa.Array:
    totals, symbols = np.zeros(len(texts), np.int64), []
    # Texts become Python strings one at a time.
    for owners, pieces in slices(words, None, (value.as_py() for value in texts)):
        places = cache.places(pieces)
        totals += np.bincount(owners, cache.sizes[places], len(texts)).astype(np.int64)
        symbols.append(cache.symbols(places))
    offsets = np.append(0, np.cumsum(totals)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(symbols)))
    return pa.ListArray.from_arrays(lists.offsets, lists.values, mask=texts.is_null())


def _read_chunks(chunks: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(key, start, text, lengths, counts, ids) of chunks: how long their
    pre-tokens are, how many ids each has, and the ids, all packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, words = PieceCache(Merges.from_ranks(ranks)), splitter(pattern)
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                pieces = words.findall(one.column("text")[0].as_py())
                places = cache.places(pieces)
                lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
                found = (lengths, cache.sizes[places], cache.symbols(places))
                lists = [pa.array([_pack(x)], pa.binary()) for x in found]
                yield pa.RecordBatch.from_arrays([*one.columns, *lists], names=[*one.schema.names, *FOUND])

    return chunks.mapInArrow(run, "key string, start long, text string, lengths binary, counts binary, ids binary")


FOUND = ("lengths", "counts", "ids")


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers, none negative, in the fewest bytes each that hold them all."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return kind.char.encode() + numbers.astype(kind).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, packed[:1].decode(), offset=1).astype(np.int64)


def stitch(chunks: list[dict], merges: Merges, pattern: str, step: int = CHUNK) -> np.ndarray:
    """The ids of a whole text from its chunks in order of their start."""
    words, cache = splitter(pattern), PieceCache(merges)
    text = "".join(c["text"][:step] for c in chunks[:-1]) + chunks[-1]["text"]
    out: list[np.ndarray] = []
    at = 0
    for number, chunk in enumerate(chunks):
        end = chunk["start"] + len(chunk["text"])
        last = number == len(chunks) - 1
        if at >= end and not last:
            continue
        lengths, counts, ids = (_unpack(chunk[n]) for n in FOUND)
        ends = np.cumsum(lengths) + chunk["start"]
        starts = np.append(chunk["start"], ends)
        # Read on to a boundary of this chunk; none is needed at the very start.
        first = int(np.searchsorted(starts, at))
        while at < len(text) and (first >= len(starts) or starts[first] != at):
            piece = words.match(text, at)[0]
            out.append(cache.symbols(cache.places([piece])))
            at += len(piece)
            first = int(np.searchsorted(starts, at))
            if at >= end and not last:
                break
        if first >= len(starts) or starts[first] != at:
            continue
        sure = len(ends) if last else int(np.searchsorted(ends, end - SURE, side="right"))
        if sure > first:
            offsets = np.append(0, np.cumsum(counts))
            out.append(ids[offsets[first] : offsets[sure]])
            at = int(ends[sure - 1])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _encode_long(
    texts: DataFrame, ranks: str, pattern: str, step: int, overlap: int, decoded: bool = False
) -> DataFrame:
    """(key, ids) of the distinct of long texts, with ``decoded`` the ``bytes``
    that the ids decode to as well, made where the ids are. Equal texts meet
    as chunks, so none moves whole before it is read."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.length("text") - 1 - overlap), F.lit(step))
    cut = texts.select("key", "text", F.explode(starts).alias("start")).select(
        "key", F.col("start").cast("long"), F.substring("text", F.col("start") + 1, F.lit(step + overlap)).alias("text")
    )
    read = _read_chunks(cut.groupBy("key", "start").agg(F.first("text").alias("text")), ranks, pattern)

    def join(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(key=lambda r: r["start"])
        ids = stitch(rows, Merges.from_ranks(ranks), pattern, step)
        whole = {"key": [rows[0]["key"]], "ids": [ids.astype(np.int32)]}
        if decoded:
            whole["bytes"] = [_bytes(ids, *spellings_of(ranks))]
        return pa.table(whole)

    return read.groupBy("key").applyInArrow(join, "key string, ids array<int>" + ", bytes binary" * decoded)


def encode(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    text: str = "text",
    to: str = "ids",
    step: int = CHUNK,
    overlap: int = OVERLAP,
    decoded: str | None = None,
) -> DataFrame:
    """Add the token ids of every whole text; null counts as empty, no ids.
    ``decoded`` names a column to add as well, of the bytes the ids decode to.

    Texts of up to one step are encoded where they lie. Of longer ones the
    distinct are cut, read in parallel and stitched, each by itself, and come
    back by the text's SHA-256. Rows, ids and repeats stay as they are; the
    new columns must not exist yet.
    """
    held, key, ids = fresh("whole", docs), fresh("text_key", docs), fresh("found_ids", docs)
    whole = docs.withColumn(held, text_or_empty(text))
    is_long = F.length(held) > step
    with_bytes = decoded is not None
    short = whole.where(~is_long).withColumn(ids, encode_short(F.col(held), ranks, pattern, with_bytes))
    keyed = whole.where(is_long).withColumn(key, F.sha2(held, 256))
    texts = keyed.select(F.col(key).alias("key"), F.col(held).alias("text"))
    found = _encode_long(texts, ranks, pattern, step, overlap, with_bytes)
    found = found.select(F.col("key").alias(key), (F.struct("ids", "bytes") if with_bytes else F.col("ids")).alias(ids))
    every = short.unionByName(keyed.join(found, key).drop(key))
    made = {to: F.col(ids)["ids"], decoded: F.col(ids)["bytes"]} if with_bytes else {to: F.col(ids)}
    return every.select(*columns(docs), *[made[name].alias(name) for name in made])


def decode(ids: Column, ranks: str) -> Column:
    """The bytes of token ids, joined; null gives null, no ids no bytes."""

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spellings = spellings_of(ranks)
        for batch in batches:
            for portion in _portions(batch, pc.list_value_length(batch), TOKENS):
                yield _decode_all(portion, spellings)

    return decoded(ids)


def _decode_all(lists: pa.Array, spellings: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Array:
    return pa.array([_bytes(ids.values, *spellings) if ids.is_valid else None for ids in lists], pa.binary())


def _bytes(ids: pa.Array | np.ndarray, sizes: np.ndarray, starts: np.ndarray, pool: np.ndarray) -> bytes:
    every = np.asarray(ids)
    parts = []
    for begin in range(0, len(every), TOKENS):
        numbers = every[begin : begin + TOKENS]
        lengths = sizes[numbers]
        ends = np.cumsum(lengths)
        index = np.arange(ends[-1]) - np.repeat(ends - lengths - starts[numbers], lengths)
        parts.append(pool[index].tobytes())
    return b"".join(parts)


def digests(
    encoded: DataFrame, ranks: str, id: str = "doc_id", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """(id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``): the count of
    tokens, the digest of their decimal ids joined by one space, and of the
    bytes they decode to, which ``decoded`` holds if it is given."""
    joined = F.array_join(F.col(ids).cast("array<string>"), " ")
    return encoded.select(
        F.col(id),
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decode(F.col(ids), ranks) if decoded is None else F.col(decoded), 256).alias("decoded_sha256"),
    )
