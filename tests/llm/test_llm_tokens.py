"""Token counts and byte-level BPE against the libraries of the vocabulary."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from tokenizers import Tokenizer

from goldkeel.llm import byte_bpe, queries, stages, token_counts
from goldkeel.llm.bpe_merges import Merges, PieceCache, splitter

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return Tokenizer.from_file(VOCABULARY)


def odd_texts():
    dice = random.Random(5)
    letters = ["a", "b", " ", "  ", "\n", "'ll", "don't", "é", "日", "😀", "1", "٢", "́", "!", "\x00"]
    made = ["".join(dice.choice(letters) for _ in range(dice.randrange(60))) for _ in range(60)]
    return ["", "a" * 5000 + " b", " " * 3000 + "x'll " * 700, "'" * 999 + "ll don't " * 300, "é😀 " * 1500, *made]


def test_merging_equals_the_library(library):
    cache, words = PieceCache(Merges.from_ranks(RANKS)), splitter(PATTERN)
    for text in odd_texts():
        assert cache.symbols(cache.places(words.findall(text))).tolist() == library.encode_ordinary(text)


def test_a_small_cache_changes_nothing(library):
    cache, words = PieceCache(Merges.from_ranks(RANKS), most=3), splitter(PATTERN)
    for text in ("one two three four five six", "one two seven eight", "one"):
        assert cache.symbols(cache.places(words.findall(text))).tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize(("step", "overlap"), [(100, 16), (977, 5), (1000, 64)])
def test_stitched_chunks_equal_the_whole(spark, library, step, overlap):
    texts = [*odd_texts(), None]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(1, texts[1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = byte_bpe.encode(docs, RANKS, PATTERN, step=step, overlap=overlap).collect()
    assert len(got) == len(rows)
    for row in got:
        assert list(row.ids) == library.encode_ordinary(row.text or "")
        assert row.key == "x"


def test_decoding_gives_the_bytes_back(spark):
    rows = [(i, t) for i, t in enumerate(odd_texts())] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    encoded = byte_bpe.encode(docs, RANKS, PATTERN)
    got = encoded.select("text", byte_bpe.decode(encoded.ids, RANKS).alias("bytes")).collect()
    assert all((r.text or "").encode() == bytes(r.bytes) for r in got)


def test_encoding_decodes_as_well(spark, library):
    texts = [*odd_texts(), None, "a b " * 700]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(1, texts[1], "x"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_bytes string")
    got = byte_bpe.encode(docs, RANKS, PATTERN, step=1000, overlap=64, decoded="decoded").collect()
    assert sorted(((r.doc_id, r.text, r.ids_bytes) for r in got), key=repr) == sorted(rows, key=repr)
    for row in got:
        assert list(row.ids) == library.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()


def test_one_worker_a_task_encodes_and_decodes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for made in (queries.op9_byte_bpe(spark, SF), stages.encode_tokens(spark, docs, SF)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1  # of short texts; long ones are decoded where they are stitched


def test_batches_go_in_portions():
    batch = pa.array(["ab", None, "é", "", "x" * 50, "y", None, "z"])
    parts = list(byte_bpe._portions(batch, pc.binary_length(batch), 4))
    assert pa.concat_arrays(parts).equals(batch)
    assert [p.to_pylist() for p in parts] == [["ab", None, "é"], ["", "x" * 50], ["y", None, "z"]]
    empty = pa.array([], pa.string())
    assert [len(p) for p in byte_bpe._portions(empty, pc.binary_length(empty), 4)] == [0]


@pytest.mark.parametrize(("numbers", "size"), [([], 1), ([0, 255], 3), ([256, 1], 5), ([65536], 5)])
def test_numbers_travel_packed(numbers, size):
    packed = byte_bpe._pack(np.array(numbers, np.int64))
    assert (len(packed), byte_bpe._unpack(packed).tolist()) == (size, numbers)


def test_long_texts_move_only_as_chunks(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    plan = byte_bpe.encode(docs, RANKS, PATTERN, step=2, overlap=1)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 4  # chunks, what was read of them by text, both sides of the join back


def test_many_ids_are_decoded_in_parts(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "TOKENS", 3)
    text = "one two three é😀 four  five\n"
    ids = np.array(library.encode_ordinary(text), np.int32)
    assert byte_bpe._bytes(ids, *byte_bpe.spellings_of(RANKS)) == text.encode()
    assert byte_bpe._bytes(ids[:0], *byte_bpe.spellings_of(RANKS)) == b""


def test_query_of_encoding_equals_the_library(spark, library):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = queries.op9_byte_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for row in got:
        text = texts[row.doc_id] or ""
        ids = library.encode_ordinary(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (row.n_tokens, row.ids_sha256) == (len(ids), digest)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_counts_equal_the_library(spark, counter):
    texts = [*odd_texts(), "<|endoftext|>a <|endoftext|>", None]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(None, "x y", 7), (None, "x y", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = token_counts.token_counts(docs, VOCABULARY, PATTERN).collect()
    assert len(got) == len(rows)
    for row in got:
        text = (texts[row.doc_id] if row.doc_id is not None else "x y") or ""
        n = len(counter.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 512)


def test_query_of_counts_equals_the_library(spark, counter):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for row in queries.op4_token_counts(spark, SF).collect():
        assert row.n_tokens == len(counter.encode(texts[row.doc_id] or "", add_special_tokens=False).ids)


def test_long_texts_are_counted_in_slices(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE", 40)
    text = "one two three four five six seven " * 9
    parts = list(token_counts.slices(splitter(PATTERN), None, [text, None, "x"]))
    assert [p for _, pieces in parts for p in pieces] == [*splitter(PATTERN).findall(text), "x"]
    assert np.unique(np.concatenate([o for o, _ in parts])).tolist() == [0, 2]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(docs, VOCABULARY, PATTERN).count() == 0
    assert byte_bpe.digests(byte_bpe.encode(docs, RANKS, PATTERN), RANKS).count() == 0
