"""Token counts of whole texts by rank-synchronous merging of pre-tokens."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeel.llm.bpe_merges import Merges, PieceCache, splitter
from goldkeel.llm.common import text_or_empty

LIMIT = 512
SLICE = 1 << 20  # characters pre-tokenised at a time


def special_strings(vocabulary: str) -> list[str]:
    """The strings that a vocabulary in JSON form adds as tokens of their own."""
    with open(vocabulary, encoding="utf-8") as file:
        return [token["content"] for token in json.load(file).get("added_tokens", [])]


def count_tokens(column: Column, vocabulary: str, pattern: str) -> Column:
    """Number of tokens under a byte-level vocabulary in JSON form.

    A special string of the vocabulary inside a text is one token, which is its
    default, and ends the pre-token before it. No other special tokens, no
    truncation. Null gives null, an empty text 0, a very long one is counted
    whole.
    """

    special = sorted(special_strings(vocabulary), key=len, reverse=True)
    cut = regex.compile("|".join(map(regex.escape, special))) if special else None

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache, words = PieceCache(Merges.from_json(vocabulary)), splitter(pattern)

        def count(texts: pd.Series) -> np.ndarray:
            totals = np.zeros(len(texts), np.int64)
            for owners, pieces in slices(words, cut, texts):
                places = cache.places(pieces)
                totals += np.bincount(owners, cache.sizes[places], len(texts)).astype(np.int64)
            return totals + [len(cut.findall(t)) if cut and t else 0 for t in texts]

        for texts in batches:
            yield pd.Series(count(texts)).where(texts.notna().to_numpy()).astype("Int64")

    return counted(column)


def slices(
    words: regex.Pattern, cut: regex.Pattern | None, texts: Iterable[str | None]
) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Pre-tokens of many texts with the number of their text, in lists of
    bounded length; long texts go over several lists."""
    owners: list[int] = []
    sizes: list[int] = []
    pieces: list[str] = []
    waiting = 0
    for number, text in enumerate(texts):
        for part in cut.split(text or "") if cut else [text or ""]:
            if len(part) <= SLICE:
                found = iter([words.findall(part)])
            else:
                found = map(list, itertools.batched((m[0] for m in words.finditer(part)), SLICE // 4))
            for some in found:
                owners.append(number)
                sizes.append(len(some))
                pieces += some
                waiting += len(some)
                if waiting >= SLICE // 4:
                    yield np.repeat(owners, sizes), pieces
                    owners, sizes, pieces, waiting = [], [], [], 0
    yield np.repeat(np.array(owners, np.int64), sizes), pieces


def token_counts(
    docs: DataFrame, vocabulary: str, pattern: str, id: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """(id, ``n_bytes``, ``n_tokens``, ``over_limit``) of every row.

    A null text counts as empty: no bytes, no tokens. Repeated rows and null
    ids stay as they are, other columns of ``docs`` are not read.
    """
    chosen = docs.select(F.col(id), text_or_empty(text).alias("_text"))
    counted = chosen.select(
        F.col(id),
        F.octet_length("_text").cast("long").alias("n_bytes"),
        count_tokens(F.col("_text"), vocabulary, pattern).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
