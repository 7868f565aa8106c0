"""Collocations, exact top-k and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from goldkeel.llm import bit_slices, collocations, spelling

DOCS = "doc_id long, text string, lang string, chunk string, words string, slot int, n long"


def documents(spark, texts):
    """Texts with ids and languages, beside columns named like inner ones."""
    data = [(i, text, lang, "x", "y", 1, 2) for i, (text, lang) in enumerate(texts)]
    return spark.createDataFrame(data, DOCS)


# Collocations


def brute_collocations(texts, least, best=2000, factor=2_000_000, percent=80):
    low = str.maketrans(collocations.UPPER, collocations.LOWER)
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang or "und"][tuple(words[i : i + n])] += 1
    found = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in frequent.items():
            inside = [
                b for q, b in frequent.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * b >= percent * a for b in inside):
                continue
            score, _, x, y = min(
                (factor * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            scored.append((-score, -a, " ".join(p).encode(), x, y))
        for rank, (score, a, p, x, y) in enumerate(sorted(scored)[:best], 1):
            found.append((lang, rank, p.decode(), -a, x, y, totals[lang], -score))
    return sorted(found, key=repr)


def random_texts(seed, count):
    pick = random.Random(seed)
    words = ["of", "the", "Red", "red", "house", "new", "yörk", "A-B", "x'y", "İ", "city", "10%", "a b"]
    gaps, stops = [" ", "  ", "\t", " \t "], [".", ",\n", "; ", "\r\n", "!?", "\x0b", "\x0c"]
    texts = []
    for _ in range(count):
        parts = [pick.choice(gaps) + pick.choice(words[: pick.randint(3, len(words))]) for _ in range(pick.randint(0, 60))]
        parts = [p + pick.choice(stops) if pick.random() < 0.15 else p for p in parts]
        texts.append(("".join(parts), pick.choice(["en", "fr", None])))
    return texts + [(None, "en"), ("", "fr"), (" \t .,\n", None), ("red house", "und")] + texts[:5]


@pytest.mark.parametrize("spacing,slots,farthest", [(16, 1 << 21, 1024), (2, 8, 5), (1, 1, 3)])
def test_collocations_match_brute_force(spark, monkeypatch, spacing, slots, farthest):
    texts = random_texts(spacing, 120)
    plain = collocations.chunk_dictionary
    monkeypatch.setattr(
        collocations, "chunk_dictionary", lambda d, t, la, s: plain(d, t, la, s, farthest)
    )
    found = collocations.collocations(documents(spark, texts), least=5, spacing=spacing, slots=slots, best=40)
    assert rows(found) == brute_collocations(texts, 5, 40)


def test_collocations_of_a_long_text_and_of_one_word(spark):
    long = " ".join(random.Random(3).choice("abcdefgh") for _ in range(30_000))
    texts = [(long, "en"), ("ha " * 20_000, "fr")]
    found = collocations.collocations(documents(spark, texts), best=300)
    assert rows(found) == brute_collocations(texts, 30, 300)
    chunks = collocations.chunk_dictionary(documents(spark, texts))
    assert chunks.agg(F.max("owned")).first()[0] <= collocations.FARTHEST


def test_equal_passages_are_chunked_alike(spark):
    passage = " ".join(f"w{i % 97}x{i % 13}" for i in range(400))
    one = collocations.chunk_dictionary(documents(spark, [(passage, "en")])).count()
    texts = [(f"{'lead ' * i}{passage}{' tail' * i}", "en") for i in range(12)]
    both = collocations.chunk_dictionary(documents(spark, texts))
    assert both.count() < 2 * one + 24
    assert both.agg(F.sum(F.col("times") * F.col("owned"))).first()[0] == 12 * 400 + 2 * sum(range(12))


def test_scores_beyond_64_bits_are_exact(spark):
    a = 6 * 10**12
    parts = spark.createDataFrame([("en", "x", a + 1), ("en", "y", a + 2)], "lang string, phrase string, f long")
    pair = spark.createDataFrame([("en", "x y", 2, a)], "lang string, phrase string, size int, a long")
    assert collocations._scored(pair, parts, 2_000_000).first()["score"] == 2_000_000 * a // (2 * a + 3)


def test_collocations_of_an_empty_table(spark):
    assert rows(collocations.collocations(documents(spark, []))) == []


# Exact top-k

VECTORS = "vec_id long, embedding array<double>, label int, lane int, ids string"


def brute_top(data, k=5, every=50):
    numbers = [
        (i, [int(np.floor(256 * x)) for x in v])
        for i, v in data
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    found = []
    for q, v in {(i, tuple(v)) for i, v in numbers if i % every == 0}:
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in numbers if i != q)
        found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found, key=repr)


def vectors(spark, data):
    return spark.createDataFrame([(i, v, 1, 7, "x") for i, v in data], VECTORS)


@pytest.mark.parametrize("block,queries", [(16384, 512), (64, 2), (5, 3)])
def test_top_k_matches_brute_force(spark, block, queries):
    pick = np.random.default_rng(block)
    data = [(i, pick.normal(size=6).tolist()) for i in range(-60, 240)]
    data += [(1000 + i, [0.5] * 6) for i in range(30)]  # ties
    data += [(50, data[3][1]), (50, [9.0] * 6), (7, [1.0] * 6), (7, [1.0] * 6)]  # repeats
    data += [(None, [1.0] * 6), (300, None), (350, [1.0, None]), (400, [float("nan")] * 6), (450, [float("inf")] * 6)]
    data += [(500, []), (550, [1.5, -2.5]), (600, [0.0] * 6)]
    found = bit_slices.top_k(vectors(spark, data), rows=block, queries=queries)
    assert rows(found) == brute_top(data)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_top_k_gathers_no_blocks_in_the_driver(spark, adaptive):
    data = [(i, [float(i % 7), 1.0]) for i in range(200)]
    usual = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        found = bit_slices.top_k(vectors(spark, data), rows=5, queries=3)
        assert rows(found) == brute_top(data)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", usual)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_top_k_of_few_and_of_none(spark):
    assert rows(bit_slices.top_k(vectors(spark, []))) == []
    assert rows(bit_slices.top_k(vectors(spark, [(50, [1.0])]))) == []
    few = [(0, [1.0, 2.0]), (1, [-1.0, 0.0]), (2, [3.0, -1.0])]
    assert rows(bit_slices.top_k(vectors(spark, few))) == brute_top(few)


def test_top_k_refuses_scores_beyond_64_bits(spark):
    with pytest.raises(OverflowError):
        bit_slices.top_k(vectors(spark, [(0, [1e9]), (1, [1e9])]))


def test_slices_add_up():
    pick = np.random.default_rng(1)
    values = pick.integers(-300, 300, (200, 9))
    maps, lowest = bit_slices.slices_of(values)
    for query in (*pick.integers(-300, 300, (20, 9)), np.zeros(9, np.int64)):
        digits, offset = bit_slices.scores_in_slices(maps, lowest, query)
        got = [n + offset for n in bit_slices.numbers_at(digits, np.arange(200))]
        assert got == (values @ query).tolist()


# Spelling variants


def one_error(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(texts):
    low = str.maketrans(spelling.UPPER, spelling.LOWER)
    counts = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(low)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                place = h % len(run)
                run = run[:place] + run[place + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if one_error(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n), key=repr)


def edited(pick, word):
    letters = "abéÿÖ"
    i = pick.randrange(len(word) + 1)
    kind = pick.randrange(3)
    return word[:i] + ("" if kind == 0 else pick.choice(letters)) + word[i + (kind != 2) :]


def spelled(seed, bases, count):
    pick = random.Random(seed)
    words = ["".join(pick.choice("abéÖs") for _ in range(pick.randint(4, 9))) for _ in range(bases)]
    words += ["house", "horse", "houses", "housess", "aaaaa", "aaaaaa", "baaaa", "aaaab", "x" * 300, "x" * 301]
    for _ in range(2):
        words += [edited(pick, w) for w in words]
    texts = []
    for i in range(count):
        some = [pick.choice(words) for _ in range(200)]
        texts.append((i, "".join(w + pick.choice([" ", ".", "7", "_", "-"]) for w in some)))
    return texts + [(None, texts[0][1]), (5, texts[5][1]), (90, None), (91, ""), (92, "12 .")]


@pytest.mark.parametrize("block", [32768, 8])
def test_variants_match_brute_force(spark, block):
    texts = spelled(block, 60, 40)
    docs = spark.createDataFrame(
        [(i, t, "a", 1, "w") for i, t in texts], "doc_id long, text string, word string, n int, form string"
    )
    assert rows(spelling.variants(docs, block=block)) == brute_variants(texts)


def test_variants_follow_chains(spark):
    counts = {"abcde": 3, "abcdf": 6, "abcgf": 12, "abhgf": 24, "xbhgf": 48}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    near = {r["word"]: r for r in spelling.near_words(words).collect()}
    assert near["abcde"]["form"] == "abcdf" and near["abhgf"]["form"] == "xbhgf"
    forms = spark.createDataFrame([(w, v) for w, v in zip(list(counts), list(counts)[1:], strict=False)], "word string, form string")
    assert set(dict(rows(spelling._roots(forms))).values()) == {"xbhgf"}


def test_variants_with_very_long_words(spark):
    long = "ab" * 10_000
    texts = [(0, " ".join([long] * 9 + [long + "c"] * 4 + ["b" + long] * 3 + [long[:-1]] * 3))]
    found = rows(spelling.variants(spark.createDataFrame(texts, "doc_id long, text string")))
    assert found == brute_variants(texts)


def test_variants_of_an_empty_table(spark):
    assert rows(spelling.variants(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_variants_need_words_of_five_letters(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "doc_id long, text string"), shortest=4)
