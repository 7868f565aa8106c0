"""Language of texts by multinomial naive Bayes over hashed character n-grams.

A text becomes its letters in lower case with single blanks between words. Its
1- to 3-grams fall into a fixed number of buckets. Training counts buckets per
language; the matrix of log probabilities, buckets by languages, goes to all
tasks. Scoring treats a batch as one sparse matrix of texts by buckets, held as
the list of buckets of all its texts, and sums the rows of the dense matrix
that the list names, text by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeel.llm.common import fold_of

BUCKETS = 1 << 16
LONGEST = 3  # letters of an n-gram
PER_LANGUAGE = 4_000  # texts of a language to learn from, at most about so many
SMOOTHING = 0.1
SLICE = 1 << 18  # characters scored at a time
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """Of each code below 0x10000 its lower case if it is a letter, else a blank."""
    table = np.full(0x10000, 32, np.uint64)
    for code in range(0x10000):
        letter = chr(code)
        if letter.isalpha():
            table[code] = ord(letter.lower()[0])
    return table


class NGrams:
    def __init__(self) -> None:
        self.letters = _letters()

    def codes(self, text: str | None) -> np.ndarray:
        """Letters of a text, words apart by one blank each, blanks around
        them; nothing if there is no letter."""
        raw = np.frombuffer((text or "").encode("utf-32-le"), np.uint32)
        codes = self.letters[np.minimum(raw, 0xFFFF)]
        far = np.flatnonzero(raw > 0xFFFF)
        if len(far):
            codes[far] = [c if chr(c).isalpha() else 32 for c in raw[far].tolist()]
        codes = np.concatenate([[np.uint64(32)], codes, [np.uint64(32)]]).astype(np.uint64)
        blank = codes == 32
        codes = codes[~(blank & np.append(False, blank[:-1]))]
        return codes if len(codes) > 1 else codes[:0]

    def buckets(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(buckets of all texts' n-grams, how many of them each text has)."""
        codes = np.concatenate([np.zeros(0, np.uint64), *texts])
        ends = np.cumsum([len(t) for t in texts])
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        found, owners = [], []
        with np.errstate(over="ignore"):
            gram = np.zeros(len(codes), np.uint64)
            for n in range(1, LONGEST + 1):
                gram = gram[: len(codes) - n + 1] * FACTOR + codes[n - 1 :] + np.uint64(n)
                inside = np.arange(len(gram)) + n <= ends[owner[: len(gram)]]
                found.append(((gram * FACTOR) >> np.uint64(48))[inside])
                owners.append(owner[: len(gram)][inside])
        place = np.concatenate(owners)
        order = np.argsort(place, kind="stable")
        return np.concatenate(found)[order].astype(np.int64) % BUCKETS, np.bincount(place, minlength=len(texts))


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray  # log probability, buckets by languages


def slices(grams: NGrams, texts: pd.Series) -> Iterator[list[np.ndarray]]:
    part: list[np.ndarray] = []
    size = 0
    for text in texts:
        part.append(grams.codes(text))
        size += len(part[-1])
        if size >= SLICE:
            yield part
            part, size = [], 0
    yield part


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Train on (id, text, lang) rows: of each language the texts whose id's
    hash falls within about ``PER_LANGUAGE`` of its rows, each text whole.

    Rows with a null language, or a text without letters, teach nothing.
    """
    known = docs.select(F.col("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null")
    counts = known.groupBy("lang").count()
    sizes = {r["lang"]: r["count"] for r in counts.collect()}
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, PER_LANGUAGE / n))]) if sizes else None
    if share is None:
        return Model([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    lot = F.pmod(F.xxhash64(F.lit("language"), "id"), F.lit(1_000_000)) / 1_000_000
    sample = known.where(lot < F.try_element_at(share, F.col("lang")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, totals = NGrams(), {}
        for batch in batches:
            for language, texts in batch.groupby("lang")["text"]:
                total = totals.setdefault(language, np.zeros(BUCKETS, np.int64))
                for part in slices(grams, texts):
                    total += np.bincount(grams.buckets(part)[0], minlength=BUCKETS)
        for language, total in totals.items():
            used = np.flatnonzero(total)
            yield pd.DataFrame({"lang": language, "bucket": used, "n": total[used]})

    counted = sample.select("text", "lang").mapInPandas(run, "lang string, bucket long, n long")
    # At most buckets times languages rows.
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique())
    grid = np.full((BUCKETS, len(languages)), SMOOTHING)
    grid[table["bucket"], [languages.index(x) for x in table["lang"]]] += table["n"]
    prior = np.log(np.array([sizes[x] for x in languages], float) / max(1, sum(sizes.values())))
    return Model(languages, prior, np.log(grid / grid.sum(axis=0)).astype(np.float32))


def score(model: Model, grams: NGrams, texts: list[np.ndarray]) -> np.ndarray:
    """Log scores, texts by languages, up to a constant of each text."""
    buckets, sizes = grams.buckets(texts)
    out = np.tile(model.prior, (len(texts), 1))
    full = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[full]
    for k in range(len(model.languages)):
        if len(full):
            out[full, k] += np.add.reduceat(model.weights[buckets, k].astype(np.float64), starts)
    return out


def language(column: Column, model: Model) -> Column:
    """Struct of ``lang_pred`` and ``score``, the probability of that language;
    ``und`` and 0 for null and for texts without a letter. Ties go to the
    language first in the alphabet."""

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams, names = NGrams(), np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            langs, scores = [], []
            for part in slices(grams, batch):
                if not part:
                    continue
                logs = score(model, grams, part)
                known = np.array([len(t) > 0 for t in part]) & bool(model.languages)
                best = np.argmax(logs, axis=1) if model.languages else np.zeros(len(part), int)
                if model.languages:
                    chance = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                else:
                    chance = np.zeros(len(part))
                langs.append(names[np.where(known, best, len(model.languages))])
                scores.append(np.where(known, chance, 0.0))
            empty = np.zeros(0)
            yield pd.DataFrame(
                {"lang_pred": np.concatenate([empty.astype(object), *langs]), "score": np.concatenate([empty, *scores])}
            )

    return predicted(column)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``.

    Learned from the rows of the other folds; ``lang`` is only the label.
    Repeated rows and null ids stay. Null texts and texts without a letter are
    ``und``, very long ones are scored whole. Without any label all are ``und``.
    Other columns are not read; an empty table gives none.
    """
    held_out = fold_of("doc_id", FOLDS) == HELD_OUT
    model = learn(docs.where(~held_out).select(F.col("doc_id").alias("id"), "text", "lang"))
    found = docs.select("doc_id", held_out.alias("held_out"), language(F.col("text"), model).alias("_found"))
    return found.select("doc_id", "held_out", "_found.lang_pred", "_found.score")
