"""The learned operators against plain computations of the same thing."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from goldkeel.llm import language_id, toxicity


def plain_grams(text):
    """1- to 3-grams of the letters of a text, words apart by one blank."""
    letters = re.sub(r"[^a-zéüñ]+", " ", f" {(text or '').lower()} ")
    if letters == " ":
        return []
    return [letters[i : i + n] for n in (1, 2, 3) for i in range(len(letters) - n + 1)]


def plain_bucket(gram):
    number, factor = 0, 0x9E3779B97F4A7C15
    for n, letter in enumerate(gram, 1):
        number = (number * factor + ord(letter) + n) % 2**64
    return (number * factor % 2**64 >> 48) % language_id.BUCKETS


def plain_bayes(training, texts):
    rows, counts = Counter(), defaultdict(Counter)
    for text, lang in training:
        if lang is not None:
            rows[lang] += 1
            counts[lang].update(map(plain_bucket, plain_grams(text)))
    result = []
    for text in texts:
        grams = plain_grams(text)
        if not grams:
            result.append(("und", 0.0))
            continue
        logs = {}
        for lang in sorted(rows):
            total = sum(counts[lang].values()) + 0.1 * language_id.BUCKETS
            logs[lang] = math.log(rows[lang] / sum(rows.values()))
            logs[lang] += sum(math.log((counts[lang][plain_bucket(g)] + 0.1) / total) for g in grams)
        best = max(sorted(logs), key=logs.get)
        result.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return result


def test_languages_equal_plain_naive_bayes(spark):
    dice = random.Random(3)
    letters = {"aa": "abcde", "bb": "cdefgé", "cc": "xyzabü"}

    def text(lang, n):
        return " ".join("".join(dice.choice(letters[lang]) for _ in range(dice.randrange(1, 7))) for _ in range(n))

    training = [(text(lang, dice.randrange(1, 12)), lang) for lang in letters for _ in range(20 + 10 * len(letters[lang]))]
    training += [(None, "aa"), ("123 !", "bb"), ("abc", None)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(training)], "id long, text string, lang string")
    model = language_id.learn(frame)
    texts = [text(dice.choice(list(letters)), n) for n in (1, 1, 2, 3, 5, 40)] + [None, "", "7 - 8", "éé", "ABC, def!"]
    asked = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = asked.select("id", language_id.language(F.col("text"), model).alias("f")).orderBy("id").collect()
    for row, (lang, chance) in zip(found, plain_bayes(training, texts), strict=True):
        assert row["f"]["lang_pred"] == lang and row["f"]["score"] == pytest.approx(chance, abs=1e-4)


def plain_evidence(folded, terms, exceptions):
    best = {}
    for term, weight in terms.items():
        for start in range(len(folded)):
            if folded.startswith(term, start) and weight > best.get(start, (0, -math.inf))[1]:
                best[start] = (start + len(term), weight)
    harmless = [(s, s + len(p)) for p in exceptions for s in range(len(folded)) if folded.startswith(p, s)]
    return sum(w for s, (e, w) in best.items() if not any(a <= s and e <= b for a, b in harmless))


@pytest.mark.parametrize("seed", range(4))
def test_evidence_equals_plain_search(seed):
    dice = random.Random(seed)
    word = lambda n: "".join(dice.choice("ab") for _ in range(n))
    terms = {f" {word(dice.randrange(1, 5))}{dice.choice(['', ' '])}": 1 + dice.random() for _ in range(12)}
    exceptions = [f" {word(2)} {word(3)} " for _ in range(6)]
    model = toxicity.Matcher(terms, exceptions)
    for _ in range(80):
        text = " ".join(word(dice.randrange(1, 6)) for _ in range(dice.randrange(12)))
        weight, count = model.evidence(text)
        assert weight == pytest.approx(plain_evidence(toxicity.fold(text), terms, exceptions))
        assert count == len(text.split())


def test_scores_follow_the_curve(spark):
    terms, exceptions, curve = {" bad": 2.0, " worse ": 3.0}, [" bad luck "], (-2.0, 0.7, 0.4)
    model = toxicity.Model(terms, exceptions, curve)
    texts = ["b4d luck", "BAD thing, worse", "", None, "fine " * 20_000 + "bad", "ｂａｄ"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = frame.select("id", toxicity.toxicity(F.col("text"), model).alias("s")).orderBy("id").collect()
    for row, text in zip(got, texts, strict=True):
        folded = toxicity.fold(text or "")
        weight, count = plain_evidence(folded, terms, exceptions), max(1, len(folded.split()))
        z = curve[0] + curve[1] * math.log1p(weight) + curve[2] * math.log1p(100 * weight / count)
        assert row["s"] == pytest.approx(1 / (1 + math.exp(-z)))
