"""Toxicity by a weighted lexicon, matched in one pass over the folded text.

Folding undoes disguises: look-alike letters of other alphabets, digits and
signs that stand for letters, case. The lexicon holds word beginnings and whole
words whose share among toxic rows exceeds that among clean ones beyond doubt;
its weights are the log odds. Phrases in which a lexicon word is mostly harmless
are exceptions: a match inside one counts for nothing. An Aho-Corasick automaton
finds all entries at once. The sum of weights, alone and per word of text, goes
through a logistic curve, all fitted on labelled rows.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeel.llm.common import fold_of, sampled

# What the first string's letters are mistaken for, one by one.
CYRILLIC = ("абеіјкмносрѕтухвԁһ", "abeijkmhocpstyxbdh")
GREEK = ("αβεικνορτυχγ", "abeiknoptuxy")
SIGNS = ("013457@$", "oieastas")

SHORTEST, LONGEST = 3, 8  # letters of a word beginning
LEAST_Z = 2.6  # a term's log odds over its standard error
LEAST_ODDS = 3.3
TOXIC_SAMPLE = 4_000  # labelled rows to learn from, at most about so many
CLEAN_SAMPLE = 8_000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2


def _folding() -> dict[int, str]:
    folds = {chr(c): " " for c in range(0x80) if not chr(c).isalpha()}
    folds |= {chr(c): " " for c in (*range(0xA0, 0xC0), *range(0x2000, 0x2070))}
    for letters, plain in (CYRILLIC, GREEK, SIGNS):
        folds |= dict(zip(letters, plain, strict=True))
    # Full-width forms lie at a fixed distance from ASCII.
    folds |= {chr(c + 0xFEE0): chr(c).lower() for c in range(0x21, 0x7F) if chr(c).isalpha()}
    folds |= {chr(c): chr(c).lower() for c in range(0x41, 0x5B)}
    # Marks that show nothing.
    folds |= {c: "" for c in "­​‌‍⁠﻿"}
    return {ord(c): v for c, v in folds.items()}


FOLDING = _folding()


def fold(text: str) -> str:
    """The text in plain lower-case letters, anything else a blank."""
    return f" {text.lower().translate(FOLDING)} "


@dataclass
class Model:
    """Weights of folded terms, each beginning with a blank, as does a word;
    whole words end with one. Exceptions are folded phrases. ``curve`` holds
    the constant and the factors of the two features."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (-math.inf, 0.0, 0.0)


class Matcher:
    def __init__(self, terms: dict[str, float], exceptions: list[str]) -> None:
        self.automaton = ahocorasick.Automaton()
        for term, weight in terms.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of entries outside exceptions; of entries that
        begin at the same word, the one that weighs most."""
        if not len(self.automaton):
            return []
        best: dict[int, tuple[int, float]] = {}
        harmless: list[tuple[int, int]] = []
        for last, (size, weight) in self.automaton.iter(folded):
            start = last + 1 - size
            if weight is None:
                harmless.append((start, last + 1))
            elif start not in best or weight > best[start][1]:
                best[start] = (last + 1, weight)
        if harmless:
            best = {s: v for s, v in best.items() if not any(a <= s and v[0] <= b for a, b in harmless)}
        return [(s, e, w) for s, (e, w) in best.items()]

    def evidence(self, text: str | None) -> tuple[float, int]:
        """(sum of weights, number of words)."""
        folded = fold(text or "")
        return sum(w for _, _, w in self.matches(folded)), len(folded.split())


def features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Constant, evidence, and evidence for each hundred words."""
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 1))], axis=1)


def _log_odds(toxic_rows: int, clean_rows: int) -> tuple[Column, Column]:
    """(log odds, standard error) of the share of ``toxic`` among toxic rows."""
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    return F.log(toxic / (toxic_rows + 1)) - F.log(clean / (clean_rows + 1)), F.sqrt(1 / toxic + 1 / clean)


def _digest(column: Column) -> Column:
    """SHA-256 of a text's folded words, all of them."""

    @F.pandas_udf("binary")
    def digest(texts: pd.Series) -> pd.Series:
        words = (" ".join(fold(t or "").split()) for t in texts)
        return pd.Series([hashlib.sha256(w.encode()).digest() for w in words], dtype=object)

    return digest(column)


def training_rows(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, toxic) of the labelled rows to learn from.

    Only labels outside the held-out fold are read. Of rows of a label whose
    whole folded texts are equal one remains, so that copies don't count as
    evidence; texts that differ in any word all stay.
    """
    known = labels.where(F.col("toxic").isNotNull() & (fold_of("doc_id", FOLDS) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = sampled(known.where("toxic = 1"), "doc_id", TOXIC_SAMPLE, "toxic").unionByName(
        sampled(known.where("toxic = 0"), "doc_id", CLEAN_SAMPLE, "clean")
    )
    # At most the two sample sizes, give or take, hence small enough to send.
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("_id") == F.col("doc_id")
    )
    first = F.min(F.struct("_id", "text")).alias("first")
    return rows.groupBy(_digest(F.col("text")).alias("_digest"), "toxic").agg(first).select("first.text", "toxic")


def _count_terms(rows: DataFrame) -> DataFrame:
    """(term, toxic, clean): in how many rows of either label a term occurs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                words = set(fold(text or "").split())
                found = {f" {w[:n]}" for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}
                found |= {f" {w} " for w in words if len(w) <= 40}
                counts[int(label)].update(found)
        terms = list(counts[0].keys() | counts[1].keys())
        if terms:
            yield pd.DataFrame({"term": terms, "toxic": [counts[1][t] for t in terms], "clean": [counts[0][t] for t in terms]})

    return rows.mapInPandas(run, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )


def _choose(accepted: list[tuple[str, float]]) -> dict[str, float]:
    scored = [(-round(odds, 6), term.endswith(" "), -len(term), term, odds) for term, odds in accepted]
    chosen: dict[str, float] = {}
    covered: set[str] = set()  # all beginnings of chosen terms
    for *_, term, odds in sorted(scored):
        beginnings = [term[:n] for n in range(2, len(term) + 1)]
        if not any(b in chosen for b in beginnings) and term not in covered:
            chosen[term] = odds
            covered.update(beginnings)
    return chosen


def _count_phrases(rows: DataFrame, terms: dict[str, float]) -> DataFrame:
    """(phrase, toxic, clean) of two words of which one holds a term."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(terms, [])
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                folded = fold(text or "")
                found = set()
                for start, _, _ in matcher.matches(folded):
                    before, after = folded[max(0, start - 80) : start].split(), folded[start : start + 120].split()
                    found.update(f" {a} {b} " for a, b in zip(before[-1:], after, strict=False))
                    found.update(f" {a} {b} " for a, b in zip(after[:1], after[1:], strict=False))
                counts[int(label)].update(found)
        phrases = list(counts[0].keys() | counts[1].keys())
        if phrases:
            yield pd.DataFrame(
                {"term": phrases, "toxic": [counts[1][p] for p in phrases], "clean": [counts[0][p] for p in phrases]}
            )

    return rows.mapInPandas(run, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, float, float]:
    """Logistic regression by Newton's method; factors are never negative."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - ridge * w
        w = w + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), gradient)
    return w[0], max(w[1], 0.0), max(w[2], 0.0)


def learn(rows: DataFrame) -> Model:
    """A model from (text, toxic) rows, a bounded sample.

    Without toxic rows it knows no term and scores all texts zero.
    """
    rows = rows.persist()
    try:
        sizes = {int(r["toxic"]): r["count"] for r in rows.groupBy("toxic").count().collect()}
        toxic_rows, clean_rows = sizes.get(1, 0), sizes.get(0, 0)
        if not toxic_rows:
            return Model()
        odds, error = _log_odds(toxic_rows, clean_rows)
        # Tested before they leave Spark: only accepted terms and phrases reach the driver, all of them.
        beyond_doubt = (F.col("toxic") >= 3) & (odds >= LEAST_ODDS) & (odds / error >= LEAST_Z)
        accepted = _count_terms(rows).where(beyond_doubt).select("term", odds.alias("odds"))
        terms = _choose([tuple(r) for r in accepted.collect()])
        mostly_harmless = (F.col("clean") >= 3) & ((odds < 0) | (odds + error < 1))
        exceptions = [r.term for r in _count_phrases(rows, terms).where(mostly_harmless).select("term").collect()]
        model = Model(terms, exceptions)
        seen = rows.select(evidence(F.col("text"), model).alias("e"), "toxic").toPandas()
        found = np.array([(e["weight"], e["words"]) for e in seen["e"]], float)
        model.curve = _fit(features(found[:, 0], found[:, 1]), seen["toxic"].to_numpy(float))
        return model
    finally:
        rows.unpersist()


def evidence(column: Column, model: Model) -> Column:
    terms, exceptions = model.terms, model.exceptions

    @F.pandas_udf("struct<weight: double, words: long>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(terms, exceptions)
        for texts in batches:
            yield pd.DataFrame([matcher.evidence(t) for t in texts], columns=["weight", "words"]).astype(
                {"weight": float, "words": int}
            )

    return found(column)


def toxicity(column: Column, model: Model) -> Column:
    """The score of a text between 0 and 1; null counts as empty."""
    terms, exceptions, curve = model.terms, model.exceptions, np.array(model.curve)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(terms, exceptions)
        for texts in batches:
            if not len(texts) or not terms:
                yield pd.Series(np.zeros(len(texts)))
                continue
            found = np.array([matcher.evidence(t) for t in texts], float)
            yield pd.Series(1 / (1 + np.exp(-(features(found[:, 0], found[:, 1]) @ curve))))

    return scored(column)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Repeated rows and null ids stay; null and empty texts have no evidence and
    get the lowest score there is; very long texts are searched whole. Other
    columns are not read; an empty table gives none. Labels that are null or belong to no
    document teach nothing; contradicting labels of an id count as toxic.
    """
    model = learn(training_rows(docs, labels))
    scored = docs.select(
        "doc_id",
        (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        toxicity(F.col("text"), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
