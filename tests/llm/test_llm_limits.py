"""Hard inputs: repeated ids, names that clash, long texts, forced small limits."""

import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import rows
from pyspark.sql import functions as F

from goldkeel.llm import (
    bpe_merges,
    common,
    decontaminate,
    embeddings,
    html_text,
    pii,
    queries,
    simhash,
    stages,
    token_counts,
    url_rules,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Names that stages and operators use for columns of their own.
TAKEN = [
    "toxicity", "matches", "fp", "group", "row", "times", "firsts", "base", "all_spans", "spans", "id", "key", "found",
    "text_key", "whole", "found_ids", "component_id", "email_matches", "email_spans", "_spans", "_times", "a`b c.d",
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    items = [(9, "a passage of the benchmark that nobody may train on")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def words(seed, n):
    dice = random.Random(seed)
    return " ".join("".join(dice.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def near_copy(text):
    return text.replace(" ", "  ", 3)


@pytest.fixture(scope="module")
def repeated(spark):
    """Ids that unrelated texts share, near copies among them, null ids."""
    some = [words(i, 60) for i in range(6)]
    data = [
        (1, some[0]), (1, some[1]), (1, near_copy(some[0])), (2, some[1]), (2, some[2]), (3, some[3]), (4, near_copy(some[3])),
        (5, some[2]), (None, some[4]), (None, some[4]), (6, None), (7, ""), (6, some[5]), (6, some[5]),
    ]
    return data


def kept_by_hand(data):
    fps = [simhash.simhash(t) for _, t in data]
    named = [n for n, (i, _) in enumerate(data) if i is not None]
    group = {n: n for n in named}
    for a in named:
        for b in named:
            if (fps[a] ^ fps[b]).bit_count() <= 4 and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {n: new if g == old else g for n, g in group.items()}
    kept = [data[n] for n in range(len(data)) if n not in group]
    for g in set(group.values()):
        kept.append(min((data[n] for n in named if group[n] == g), key=lambda r: (r[0], r[1] is not None, r[1] or "")))
    return sorted(kept, key=repr)


def test_unrelated_documents_that_share_an_id_stay(spark, folder, repeated):
    docs = spark.createDataFrame(repeated, "doc_id long, text string")
    assert rows(stages.one_of_each_group(spark, docs, folder)) == kept_by_hand(repeated)


def test_components_of_repeated_ids(spark, repeated):
    found = simhash.near_duplicates(spark.createDataFrame(repeated, "doc_id long, text string"))
    assert found.columns == ["doc_id", "fp", "component_id"]
    by_text = {(r.doc_id, r.fp): r.component_id for r in found.collect()}
    assert by_text[(3, by_fp(repeated[5][1]))] == by_text[(4, by_fp(repeated[6][1]))] == 3
    assert by_text[(1, by_fp(repeated[0][1]))] == 1 and by_text[(5, by_fp(repeated[7][1]))] == 2


def by_fp(text):
    return int(np.array([simhash.simhash(text)], np.uint64).view(np.int64)[0])


def test_stages_survive_any_column_name(spark, folder, repeated):
    plain = spark.createDataFrame([(*r, 5) for r in repeated], "doc_id long, text string, n_chars int")
    extra = plain.select("*", *[F.lit(i).alias(name) for i, name in enumerate(TAKEN)])
    for stage in (stages.drop_toxic, stages.one_of_each_group, stages.drop_contaminated, stages.mask_personal_data):
        out = stage(spark, extra, folder)
        assert out.columns == extra.columns
        assert rows(out.select("doc_id", "text", "n_chars")) == rows(stage(spark, plain, folder))
        for i, name in enumerate(TAKEN):
            assert {r[0] for r in out.select(common.columns(out)[3 + i]).collect()} == {i}
    assert rows(stages.encode_tokens(spark, extra, folder)) == rows(stages.encode_tokens(spark, plain, folder))


def test_matches_survive_any_column_name(spark, folder):
    items = spark.createDataFrame([(i, words(100 + i, 12)) for i in range(5)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(i, f"{words(200 + i, 30)} {words(100 + i % 7, 12)} end", 1, 2) for i in range(20)] + [(50, None, 1, 2)],
        "doc_id long, text string, text_key int, found int",
    )
    one = decontaminate.with_matches(docs, items, "m")
    many = decontaminate.with_matches(docs, items, "m", block_chars=150)
    assert rows(many) == rows(one) and one.where(F.size("m") > 0).count() == 15
    assert many.columns == one.columns


def test_a_letter_is_found_as_a_word_only(spark):
    items = spark.createDataFrame([(1, "a"), (2, "中"), (3, "x-")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a banana, A."), (2, "banana bandana"), (3, "本中国"), (4, "x-y x-")], "doc_id long, text string")
    found = decontaminate.contaminated(docs, items).select("doc_id", "item_id", "start")
    assert rows(found) == [(1, 1, 0), (1, 1, 10), (3, 2, 1), (4, 3, 0), (4, 3, 4)]


def test_samples_never_vanish(spark):
    ids = spark.range(40_000).withColumnRenamed("id", "doc_id")
    size = common.sampled(ids, "doc_id", 400, "seed").count()
    assert 300 < size < 500
    assert common.sampled(ids, "doc_id", 40_000, "seed").count() == 40_000
    # A share below a millionth still is one.
    least = 3 * (1 << 62) // 10**10
    assert least > 0


@pytest.mark.parametrize("block", [1, 7])
def test_small_groups_of_an_anchor(spark, block):
    dice = random.Random(block)
    centre = dice.getrandbits(64)
    fps = list({centre ^ sum(1 << b for b in dice.sample(range(64), dice.randrange(9))) for _ in range(60)})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(f, f) for f in signed], "fp long, rep long")
    links = simhash.near_links(classes, 4, block)
    group = {f: f for f in fps}
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = {f: new if g == old else g for f, g in group.items()}
    from goldkeel.llm.components import connected_components

    found = dict(connected_components(links).collect())
    names = {}
    for f, s in zip(fps, signed, strict=True):
        names.setdefault(group[f], set()).add(found.get(s, s))
    assert all(len(n) == 1 for n in names.values()) and len(set().union(*names.values())) == len(names)


@pytest.mark.parametrize("cells", [1, 3])
def test_few_cells_change_no_link(spark, cells):
    dice = np.random.default_rng(cells)
    centres = dice.normal(size=(6, 5))
    data = [(i, (centres[i % 6] + dice.normal(scale=0.05, size=5)).tolist(), i % 2) for i in range(90)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    assert rows(embeddings.near_duplicates(frame, cells=cells, block=11)) == rows(embeddings.near_duplicates(frame))


def test_running_totals(spark):
    sizes = [0, 1, 2, 255, 256, 257, 1000, 70_000]
    dice = random.Random(1)
    data = [([dice.randrange(5) for _ in range(n)],) for n in sizes]
    frame = spark.createDataFrame(data, "x array<int>")
    got = frame.select("x", pii.running(F.col("x"), lambda a, b: a + b), pii.running(F.col("x"), F.greatest)).collect()
    for x, sums, most in got:
        assert sums == np.cumsum(x).tolist() and most == np.maximum.accumulate(np.array(x, int)).tolist()


def test_a_text_of_many_spans(spark):
    """40,000 addresses in a text of about one megabyte."""
    text = " ".join(f"user{i}@host{i % 97}.example" for i in range(40_000))
    mixed = "ü" + text[:9000] + "é +49 (0)30 1234567, 10.0.0.1"
    docs = spark.createDataFrame([(1, text), (2, mixed)], "doc_id long, text string")
    begin = time.time()
    report = {r.doc_id: r for r in pii.report(docs).collect()}
    assert report[1].n_email == 40_000
    expected = [f"email:{m.start()}:{m.end()}" for m in re.finditer(r"\S+@\S+", text)]
    assert report[1].spans.split(",") == expected
    masked = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert masked[1] == " ".join(["[EMAIL]"] * 40_000)
    assert masked[2].startswith("ü[EMAIL] [EMAIL]") and masked[2].endswith("é [PHONE], [IP]")
    assert time.time() - begin < 60  # it took minutes before


def test_a_word_of_many_letters(spark):
    ranks = bpe_merges.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    merges = bpe_merges.Merges.from_ranks(RANKS)
    dice = random.Random(5)
    kinds = [("abcdefghij", 100_000), ("中文字", 5000), ("a", 4001), ("0123456789abcdef", 2000), ("ab", 513)]
    long = ["".join(dice.choice(letters) for _ in range(n)) for letters, n in kinds]
    begin = time.time()
    symbols, sizes = merges.encode([w.encode() for w in ["x", *long, "", "hello"]])
    assert time.time() - begin < 10
    at = np.cumsum(sizes)
    for word, end, size in zip(["x", *long, "", "hello"], at, sizes, strict=True):
        assert symbols[end - size : end].tolist() == library.encode_ordinary(word)
    docs = spark.createDataFrame([(1, long[0]), (2, None)], "doc_id long, text string")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.token_counts(docs, vocabulary, public_tokenizers.PATTERN)
    assert dict(counted.select("doc_id", "n_tokens").collect()) == {1: int(sizes[1]), 2: 0}


def test_rules_hold_for_any_path(spark):
    paths = ["/es/\U0010ffffx", "/es/\U0010ffff", "/es/", "/es", "/es0", "/es/\x00", "/fr/\U0010fffe"]
    pages = spark.createDataFrame([(i, f"http://a.net{p}") for i, p in enumerate(paths)], "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = {r.page_id: r.rule for r in url_rules.judge(pages, rules).collect()}
    assert [got[i] for i in range(len(paths))] == ["net/es/", "net/es/", "net/es/", None, None, "net/es/", "net/fr/"]


def test_hosts_of_many_labels_and_capped_shares(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "SHARES", 3)
    host = ".".join("abc"[i % 3] for i in range(3000)) + ".example.com"
    urls = [(i, f"http://{host if i % 2 else 'www.example.com'}/en/{i}") for i in range(50)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(pages, rules, share=2).collect()}
    assert set(got.items()) == {
        (i, ("example.com/en/", "block") if i % 2 else ("www.example.com/en/", "allow")) for i in range(50)
    }


def test_breaks_are_white_space_and_hidden_elements_are_left_out():
    page = (
        "<body><nav><a href='/'>home</a></nav><article><h1>Title of it</h1><p>one two three<br>four five six seven</p>"
        "<div hidden><div>never</div> shown</div><p>eight nine <span style='color: red; display: none'>zap</span>ten"
        " eleven <i aria-hidden=true>icon</i>twelve</p><p hidden-note='x'>thirteen fourteen fifteen</p></article></body>"
    )
    assert html_text.main_text(page) == (
        "Title of it\none two three four five six seven\neight nine ten eleven twelve\nthirteen fourteen fifteen"
    )


def test_the_best_region_by_trying_all():
    dice = random.Random(4)
    for _ in range(300):
        values = [dice.choice([-3, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(dice.randrange(12))]
        sums = {(i, j): sum(values[i:j]) for i in range(len(values)) for j in range(i + 1, len(values) + 1)}
        best = max(sums.values(), default=0)
        begin, end = html_text.best_region(values)
        if best <= 0:
            assert (begin, end) == (0, 0)
        else:
            assert sum(values[begin:end]) == best
            assert end == min(j for (i, j), s in sums.items() if s == best)
