"""Language, toxicity, benchmark passages, personal data, pages and urls."""

import hashlib
import random
import re
import zlib

import pytest

from goldkeel.llm import decontaminate, html_text, language_id, pii, queries, stages, toxicity, url_rules

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def levenshtein_within(passage, text):
    """Fewest edits that turn the passage into some part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_passages_are_found_exactly_within_the_budget():
    dice = random.Random(7)
    word = lambda: "".join(dice.choice("abcde") for _ in range(dice.randrange(2, 7)))
    items = [(i, " ".join(word() for _ in range(12))) for i in range(12)] + [(50, "tiny"), (51, None)]
    passages = decontaminate.Passages(items)
    for _ in range(80):
        i = dice.randrange(12)
        letters = list(items[i][1])
        for _ in range(dice.choice([0, 1, 3, 5, 6, 7, 12])):
            at = dice.randrange(len(letters))
            letters[at : at + dice.randrange(2)] = dice.choice(["", "x", "y"])
        text = decontaminate.normalised(" ".join(word() for _ in range(9)) + " " + "".join(letters) + " " + word())
        got = [m for m in passages.search([text])[0] if m[0] == i]
        edits = levenshtein_within(items[i][1], text)
        assert bool(got) == (edits <= int(passages.edits[i]))
        if got:
            assert min(m[3] for m in got) == edits
            assert levenshtein_within(items[i][1], text[got[0][1] : got[0][2]]) == got[0][3]


@pytest.mark.parametrize("size", [1, 2, 5, 9, 10, 15, 16, 19, 20, 23, 24, 29, 30, 31, 32])
def test_short_passages_have_their_full_budget(size):
    dice = random.Random(size)
    some = lambda n: "".join(dice.choice("abcdefgh") for _ in range(n))
    passage = some(size)
    passages = decontaminate.Passages([(1, passage), (2, some(60))])
    for _ in range(60):
        letters = list(passage)
        for _ in range(dice.randrange(size // 10 + 2)):
            at = dice.randrange(len(letters) or 1)
            letters[at : at + dice.randrange(2)] = dice.choice(["", "x", "y"])
        text = "z" * 20 + "".join(letters) + some(20)
        got = [m for m in passages.search([text])[0] if m[0] == 1]
        edits = levenshtein_within(passage, text)
        assert bool(got) == (edits <= size // 10)
        assert not got or min(m[3] for m in got) == edits


def test_long_texts_are_searched_in_windows(monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", 200)
    passage = "the passage that a benchmark holds word for word"
    text = decontaminate.normalised("filler words " * 40 + passage + " more words" * 60 + " " + passage)
    found = decontaminate.Passages([(3, passage)]).search_long(text)
    assert [text[s:e] for _, s, e, _ in found] == [passage, passage]


def test_contaminated_rows(spark):
    passage = "What is the boiling  point of Water at sea level in degrees?"
    rows = [(1, f"a b {passage.upper()}\nc"), (1, f"a b {passage.upper()}\nc"), (2, "clean text"), (3, None), (None, passage), (5, "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(9, passage), (8, passage), (7, None), (None, passage), (6, "")], "item_id long, text string")
    got = sorted((tuple(r)[:2] for r in decontaminate.contaminated(docs, items).collect()), key=repr)
    assert got == sorted([(1, 8), (1, 9), (1, 8), (1, 9), (None, 8), (None, 9)], key=repr)
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def test_blocks_of_passages_change_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(tuple(r) for r in decontaminate.contaminated(docs, items).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2000)
    assert sorted(tuple(r) for r in decontaminate.contaminated(docs, items).collect()) == whole


def test_query_finds_every_exact_passage(spark):
    items = [decontaminate.normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    exact = {i for i, t in texts if any(p in decontaminate.normalised(t) for p in items)}
    assert exact <= {r.doc_id for r in queries.op5_decontamination(spark, SF).collect()}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m[0])]


def personal_texts():
    dice = random.Random(8)
    parts = (
        "a@b.c|a@b.c_d@e.f.|1.2.3.4|256.1.1.1|1.2.3.4.5.6.7.8|4111 1111 1111 1111|4111-1111-1111-1111 | |"
        "+1 (512) 555-4564|+12|++49 30 1234567|5|😀|é|x|-|00000000255.1.2.3|4111111111111111 2|.|@|("
    ).split("|")
    made = ["".join(dice.choice(parts) for _ in range(dice.randrange(1, 12))) for _ in range(300)]
    return [*made, "7" * 3000, "a." * 900, "x@" + "a." * 900 + "b", "+1" + " 1" * 900, "A1" * 900, "", None]


def check_report(rows, texts):
    for row in rows:
        base = base_spans(texts[row.doc_id] or "")
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s.startswith(k) for s in base) for k in PATTERNS]
        assert row.spans.startswith(",".join(base))


def test_spans_equal_plain_matching(spark):
    texts = dict(enumerate(personal_texts()))
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, spans string")
    got = pii.report(docs).collect()
    assert len(got) == len(texts)
    check_report(got, texts)


def test_query_of_spans_equals_plain_matching(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    check_report(queries.op10_pii(spark, SF).collect(), texts)


def test_checksums_and_context_add_spans(spark):
    rows = [(1, "pay to GB82 WEST 1234 5698 7654 32 now"), (2, "GB82 WEST 1234 5698 7654 33"), (3, "ssn 123-45-6789"), (4, "no 123-45-6789")]
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "iban:7:34", 2: "", 3: "social:4:15", 4: ""}


def test_masking(spark):
    rows = [(1, "to a@b.c, +1 (512) 555-4564!", 3), (2, None, 0), (3, "4111111111111111 1.2.3.4", 1), (4, "clean", 5)]
    got = {r.doc_id: r.text for r in pii.masked(spark.createDataFrame(rows, "doc_id long, text string, spans int")).collect()}
    assert got == {1: "to [EMAIL], [PHONE]!", 2: None, 3: "[CARD] [IP]", 4: "clean"}
    assert pii.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_folding_undoes_disguises():
    assert fold_words("1D10T! iдiоt ｉｄｉｏｔ i\u200bdiot") == ["idiot", "iдiot", "idiot", "idiot"]
    assert toxicity.fold("").split() == []


def fold_words(text):
    return toxicity.fold(text).split()


def test_exceptions_count_for_nothing():
    matcher = toxicity.Matcher({" idiot": 2.0, " scum ": 3.0}, [" idiot proof "])
    assert matcher.evidence("An idiotic scum") == (5.0, 3)
    assert matcher.evidence("idiot-proof scums") == (0.0, 3)
    assert toxicity.Matcher({}, []).evidence(None) == (0, 0)


def toxic_corpus(rows=600):
    dice = random.Random(9)
    docs, labels = [], []
    for i in range(rows):
        words = ["".join(dice.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            words[dice.randrange(60)] = dice.choice(["grumbix", "grumbixen", "Sn0rk"])
            words[dice.randrange(60)] = "snork"
        docs.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_learned_toxicity(spark):
    docs, labels = toxic_corpus()
    extra = [(1000, None, "en", "s", 1), (1001, "", "en", "s", 1), (None, "snork " * 9, "en", "s", 1)]
    frame = spark.createDataFrame(docs + extra, DOCS)
    got = toxicity.score_documents(frame, spark.createDataFrame(labels + [(7, None, None)], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs) + 3
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100
    assert all(r.predicted == truth[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    lowest = min(r.score for r in got)
    assert {r.score for r in got if r.doc_id in (1000, 1001)} == {lowest}


def test_texts_that_share_an_opening_or_an_ending_all_teach(spark):
    line = "the same line of words at the top or at the bottom of each page of a site"
    texts = [f"{line} own{i}" for i in range(20)] + [f"mine{i} {line}" for i in range(20)] + [f"{line} {i * 'w'}x {line}" for i in range(20)]
    copies = [texts[0], texts[0].upper() + " !", texts[0].replace("own", "0wn")]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(2 * [*texts, *copies]) if toxicity_fold(i) != toxicity.HELD_OUT]
    labels = [(r[0], 1, int(r[0] >= len(texts) + 3)) for r in rows]
    got = toxicity.training_rows(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    expected = {(fold_text(r[1]), label[2]) for r, label in zip(rows, labels, strict=True)}
    assert sorted((fold_text(r.text), r.toxic) for r in got.collect()) == sorted(expected)


def test_common_words_crowd_no_toxic_term_out(spark):
    dice = random.Random(12)
    common = " ".join("".join(dice.choice("abcdefghijklm") for _ in range(8)) for _ in range(7000))
    toxic = [(common + (" snork" if i < 30 else ""), 1) for i in range(40)]
    clean = [(common if i < 8 else "plain words", 0) for i in range(40)]
    assert toxicity.learn(spark.createDataFrame(toxic + clean, "text string, toxic int")).terms.keys() == {" snork"}


def toxicity_fold(i):
    return zlib.crc32(str(i).encode()) % toxicity.FOLDS


def fold_text(text):
    return " ".join(fold_words(text))


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "x", "en", "s", 1)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [tuple(r)[2:] for r in toxicity.score_documents(docs, none).collect()] == [(0.0, 0)]
    assert toxicity.score_documents(docs.limit(0), none).count() == 0


def test_languages_of_held_out_texts(spark):
    got = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    held = got.where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in held)


def test_languages_of_odd_rows(spark):
    rows = [(i, "the and of", "en", "s", 1) for i in range(9)] + [(i, "der die das", "de", "s", 1) for i in range(10, 19)]
    odd = [(20, None, "en", "s", 1), (21, "", None, "s", 1), (22, "12 !?", "en", "s", 1), (None, "the", None, "s", 1), (23, "the " * 300000, None, "s", 1)]
    got = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(rows + odd, DOCS)).collect()}
    assert [got[i].lang_pred for i in (20, 21, 22, None, 23, 0, 10)] == ["und", "und", "und", "en", "en", "en", "de"]
    assert got[20].score == 0
    nothing = spark.createDataFrame([(1, "the", None, "s", 1)], DOCS)
    assert [r.lang_pred for r in language_id.identify(nothing).collect()] == ["und"]
    assert language_id.identify(nothing.limit(0)).count() == 0


WORDS = "Lorem ipsum dolor sit amet consectetur. "
MARKED = {
    "article": (
        f"<nav><a href=x>Home</a></nav><div class='ad'>{WORDS}</div><article><h1>A &amp; B</h1><p>{WORDS * 2}<b>x</b>\n y"
        f"<div class='ad'>{WORDS}</div><p>{WORDS}</article><footer>&copy; {WORDS}</footer>",
        ["A & B", (WORDS * 2).strip() + " x y", WORDS.strip()],
    ),
    "no article": (
        f"<body class='has sidebar'><ul class=menu><li><a>One</a></ul><div class=post><h2>T</h2><p>{WORDS * 3}</p></div>"
        f"<div class='sidebar'>{WORDS * 3}</div><div id=comments><p>{WORDS * 9}</p></div><form><label>{WORDS}</label></form>",
        ["T", (WORDS * 3).strip()],
    ),
    "hidden": (f"<p>{WORDS}<script>var t='</p>';</script><style>p{{}}</style><!-- {WORDS} --></p>", [WORDS.strip()]),
    "plain": ("just text", ["just text"]),
    "endless tag": ("before <a href='x", ["before"]),
}


@pytest.mark.parametrize("name", MARKED)
def test_main_text(name):
    page, blocks = MARKED[name]
    assert html_text.main_text(page) == "\n".join(blocks)


def test_pages(spark):
    rows = [(1, "u", MARKED["plain"][0], "x"), (1, "u", MARKED["plain"][0], "x"), (2, None, None, "x"), (None, "u", "", "x")]
    rows.append((3, "u", "<div>" * 20000 + "x" + "<" * 20000, "x"))
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 5
    assert {r.page_id: r.n_chars for r in got}[2] == 0
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_of_pages_keeps_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in queries.op2_html_extraction(spark, SF).collect():
        inner = re.search("<article>(.*)</article>", pages[row.page_id], re.S)[1]
        blocks = [" ".join(html_text.html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert row.text == "\n".join(b for b in blocks if b)


def judged(url, rules):
    if url is None or "://" not in url:
        return ("", "", None, "allow")
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if f".{host}".endswith("." + h) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_urls_equal_trying_every_rule(spark):
    dice = random.Random(2)
    letters = lambda n: "".join(dice.choice("ab/") for _ in range(dice.randrange(n)))
    rules = {}
    for _ in range(60):
        rule = (dice.choice(["com", "a.com", "b.a.com", "net"]), "/" + letters(6))
        rules[rule] = (*rule, dice.choice(["allow", "block"]))
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "x.net", "xa.com", "A.COM"]
    urls = [(i, f"http://{dice.choice(hosts)}/{letters(8)}") for i in range(300)]
    odd = [None, "", "x", "http://", "http://com", "http://a.com?q", "://a.com/#x", "http://.com/", "http://com./", "http://é.com/ü", "a://b://c.com/", "http://a.com/" + "z" * 5000]
    urls += [(1000 + i, u) for i, u in enumerate(odd)] * 2
    pages = spark.createDataFrame([(*u, "x") for u in urls], "page_id long, url string, host string")
    frame = spark.createDataFrame([*rules.values(), (None, "/", "block"), ("x", None, None)], "host string, path string, verdict string")
    got = url_rules.judge(pages, frame, share=11).collect()
    assert len(got) == len(urls)
    known = dict(urls)
    for row in got:
        assert tuple(row)[1:] == judged(known[row.page_id], rules.values())
    assert url_rules.judge(pages.limit(0), frame).count() == 0
    assert {r.verdict for r in url_rules.judge(pages, frame.limit(0)).collect()} == {"allow"}


def test_query_of_urls(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    for row in queries.op6_url_filters(spark, SF).collect():
        assert tuple(row)[1:] == judged(pages[row.page_id], queries.URL_RULES)


def pipeline_rows():
    dice = random.Random(11)
    text = lambda n: " ".join("".join(dice.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    copied = text(80)
    return [(1, copied), (2, copied), (3, text(60)), (4, None), (5, ""), (6, "write to a@b.cc " + text(40)), (7, text(50)), (7, text(50)), (None, text(30))]


def test_stages_keep_columns_and_clean_rows(spark, tmp_path):
    docs = spark.createDataFrame([(*r, "en", "s", 5) for r in pipeline_rows()], DOCS)
    spark.createDataFrame([(9, "a passage of the benchmark that nobody may train on")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    ids = lambda df: sorted((r.doc_id for r in df.collect()), key=repr)
    everything = ids(docs)
    for stage in (stages.drop_toxic, stages.drop_contaminated, stages.mask_personal_data):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and ids(out) == everything
    one = stages.one_of_each_group(spark, docs, str(tmp_path))
    assert one.columns == docs.columns
    # 4 and 5 are both without words; the two texts under 7 have nothing in common.
    assert ids(one) == sorted([1, 3, 4, 6, 7, 7, None], key=repr)
    masked = {r.doc_id: r for r in stages.mask_personal_data(spark, docs, str(tmp_path)).collect()}
    assert masked[6].text.startswith("write to [EMAIL] ") and masked[6].n_chars == len(masked[6].text)
    tokens = stages.encode_tokens(spark, docs, str(tmp_path)).collect()
    assert len(tokens) == len(everything) and all(r.round_trip for r in tokens)
    for stage in (stages.drop_toxic, stages.one_of_each_group, stages.drop_contaminated, stages.mask_personal_data, stages.encode_tokens):
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_pipeline_equals_its_operators(spark):
    import corpus_pipeline
    from goldkeel.llm import simhash

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    clean = {r.doc_id for r in toxicity.score_documents(docs, labels).where("predicted = 0").collect()}
    texts = {i: t for i, t in docs.select("doc_id", "text").collect() if i in clean}
    fps = {i: simhash.simhash(t) for i, t in texts.items()}
    kept = []
    seen = {i: i for i in fps}
    for i in sorted(fps):
        for j in sorted(fps):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and seen[j] > seen[i]:
                seen = {k: seen[i] if v == seen[j] else v for k, v in seen.items()}
    kept = {i for i in fps if seen[i] == i}
    bad = {r.doc_id for r in decontaminate.contaminated(docs, items).collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == kept - bad
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
