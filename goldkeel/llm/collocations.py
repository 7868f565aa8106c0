"""Phrase collocations counted by prefix-free parsing.

Pieces of text are cut into chunks where the hash of the next three words says
so, so that equal passages are cut alike wherever they stand. Each chunk also
holds the three words after it: a phrase of up to four words that starts in a
chunk lies in it whole, and is counted there and nowhere else. Distinct chunks
form a dictionary with the number of times each was parsed; phrases are
counted inside the dictionary alone, each weighted by that number.

A phrase can only be frequent if the shorter phrases in it are. So words are
counted first, then pairs of frequent words, then phrases made of frequent
pairs. What is frequent is passed on as a set of hash slots, at most ``SLOTS``
of them: a collision lets a phrase be counted in vain, none is ever missed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldkeel.operators.groups import join_on_unique
from goldkeel.session import stage

LONGEST = 4  # words of a phrase
AHEAD = LONGEST - 1  # words that chunks overlap, and words that trigger a cut
SPACING = 16  # words from cut to cut, on average
FARTHEST = 1024  # words after which a cut is made in any case
SLOTS = 1 << 21
LOTS = 64  # parts of a language that are ranked before the language is
STOPS = ".,;:!?\n\x0b\x0c\r"  # signs between pieces
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out only once."""
    return F.get(F.transform(F.array(value), body), 0)


def _chunks(piece: Column, spacing: int, farthest: int) -> Column:
    """The chunks of a piece of more than ``spacing`` words."""

    def cut(words: Column) -> Column:
        size = F.size(words)

        def is_cut(i: Column) -> Column:
            next_words = [F.get(words, i + k) for k in range(AHEAD)]
            triggered = (i + AHEAD <= size) & (F.pmod(F.xxhash64(*next_words), F.lit(spacing)) == 0)
            return (i == 0) | (i % farthest == 0) | triggered

        starts = F.filter(F.sequence(F.lit(0), size - 1), is_cut)
        return _let(F.concat(starts, F.array(size)), lambda edges: held(words, edges))

    def held(words: Column, edges: Column) -> Column:
        def chunk(start: Column, n: Column) -> Column:
            owned = F.get(edges, n + 1) - start
            text = F.array_join(F.slice(words, start + 1, owned + AHEAD), " ")
            return F.struct(text.alias("chunk"), owned.alias("owned"))

        return F.transform(F.slice(edges, 1, F.size(edges) - 1), chunk)

    return _let(F.split(piece, " "), cut)


def chunk_dictionary(
    docs: DataFrame, text: str = "text", lang: str = "lang", spacing: int = SPACING, farthest: int = FARTHEST
) -> DataFrame:
    """(lang, chunk, owned, times): each distinct chunk, the number of its words
    at which phrases start, and how often it was parsed. A piece of no more
    than ``spacing`` words is one chunk."""
    # Blanks become one kind, and so do the signs between pieces.
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER + "\t" + STOPS, LOWER + " " + "." * len(STOPS))
    pieces = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.explode(F.split(F.regexp_replace(plain, "  +", " "), r"\.")).alias("piece"),
    )
    pieces = pieces.select("lang", F.trim("piece").alias("piece")).where("piece <> ''")
    size = F.length("piece") - F.length(F.replace("piece", F.lit(" "), F.lit(""))) + 1
    pieces = pieces.select("lang", "piece", size.alias("size"))
    # Null, and thus one row, for pieces that are a chunk as they are.
    parts = F.when(F.col("size") > spacing, _chunks(F.col("piece"), spacing, farthest))
    cut = pieces.select("lang", "piece", "size", F.explode_outer(parts).alias("part"))
    chunks = cut.select(
        "lang", F.coalesce("part.chunk", "piece").alias("chunk"), F.coalesce("part.owned", "size").alias("owned")
    )
    return chunks.groupBy("lang", "chunk", "owned").agg(F.count(F.lit(1)).alias("times"))


def _slot(words: list[Column], slots: int) -> Column:
    return F.pmod(F.xxhash64("lang", F.concat_ws(" ", *words)), F.lit(slots))


def _held(counts: DataFrame, slots: int) -> DataFrame:
    """Slots of the counted phrases, to be broadcast: ``slots`` rows at most."""
    return F.broadcast(counts.select(F.pmod(F.xxhash64("lang", "phrase"), F.lit(slots)).alias("slot")).distinct())


def _grams(dictionary: DataFrame, longest: int, shortest: int) -> DataFrame:
    """(lang, times, w0, w1, ...): the words from each place at which a phrase
    of ``shortest`` words or more starts, nulls beyond the end."""
    words = dictionary.select("lang", "times", "owned", F.split("chunk", " ").alias("words"))
    starts = F.least(F.col("owned"), F.size("words") - (shortest - 1))
    shifted = [F.slice("words", k + 1, F.size("words")).alias(f"w{k}") for k in range(longest)]
    places = F.explode(F.slice(F.arrays_zip(*shifted), 1, starts)).alias("at")
    return words.where(starts > 0).select("lang", "times", places).select("lang", "times", "at.*")


def phrase_counts(dictionary: DataFrame, least: int, slots: int = SLOTS) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of 1 to 4 words that occur at
    least ``least`` times. Stage ``dictionary`` first, it is read three times."""
    word = [F.col(f"w{k}") for k in range(LONGEST)]

    def counts(grams: DataFrame, phrase: Column, size: Column) -> DataFrame:
        kept = grams.select("lang", phrase.alias("phrase"), size.cast("int").alias("size"), "times")
        summed = kept.groupBy("lang", "phrase", "size").agg(F.sum("times").alias("f"))
        return summed.where(F.col("f") >= least)

    single = stage(counts(_grams(dictionary, 1, 1), word[0], F.lit(1)), "words")
    frequent = _held(single, slots)
    pairs = _grams(dictionary, 2, 2)
    for k in range(2):
        pairs = pairs.join(frequent, _slot([word[k]], slots) == frequent["slot"], "left_semi")
    double = stage(counts(pairs, F.concat_ws(" ", *word[:2]), F.lit(2)), "pairs")

    frequent = _held(double, slots)
    longer = _grams(dictionary, 4, 3)
    for k in range(2):
        longer = longer.join(frequent, _slot(word[k : k + 2], slots) == frequent["slot"], "left_semi")
    last = F.when(word[3].isNotNull(), _slot(word[2:], slots))
    longer = longer.join(frequent, last == frequent["slot"], "left")
    # One row for the phrase of three words, one for that of four.
    sizes = F.when(F.col("slot").isNotNull(), F.array(F.lit(3), F.lit(4))).otherwise(F.array(F.lit(3)))
    longer = longer.select("lang", "times", *word, F.explode(sizes).alias("n"))
    phrase = F.concat_ws(" ", *word[:3], F.when(F.col("n") == 4, word[3]))
    rest = stage(counts(longer, phrase, F.col("n")), "phrases")
    return single.unionByName(double).unionByName(rest)


def _scored(candidates: DataFrame, parts: DataFrame, factor: int) -> DataFrame:
    """Candidates with ``l``, ``r`` and ``score`` of the cut that scores lowest."""
    words = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns(
        {
            "left": F.array_join(F.slice(words, 1, F.col("k")), " "),
            "right": F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "),
        }
    )
    for side, count in (("left", "l"), ("right", "r")):
        of_part = parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(count))
        cuts = join_on_unique(cuts, of_part, ["lang", side])
    score = F.expr(
        f"(cast({factor} as decimal(10,0)) * cast(a as decimal(20,0))) div "
        "(cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    )
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _uncovered(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates that no longer one holding them nearly matches in number."""
    words = F.split("phrase", " ")
    inner = candidates.where("size > 2").select(
        "lang",
        F.col("a").alias("longer"),
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda n: F.transform(
                        F.sequence(F.lit(1), F.col("size") - n + 1),
                        lambda i: F.array_join(F.slice(words, i, n), " "),
                    ),
                )
            )
        ).alias("phrase"),
    )
    covers = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = (F.lit(100).cast("decimal(3,0)") * F.col("longer").cast("decimal(20,0)")) >= (
        F.lit(percent).cast("decimal(3,0)") * F.col("a").cast("decimal(20,0)")
    )
    joined = candidates.join(covers, ["lang", "phrase"], "left")
    return joined.where(F.col("longer").isNull() | ~covered).drop("longer")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 30,
    factor: int = 2_000_000,
    percent: int = 80,
    best: int = 2000,
    spacing: int = SPACING,
    slots: int = SLOTS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of 2 to 4 words of
    each language whose words belong together, best first.

    ``a`` is how often a phrase occurs, ``n`` the words of its language, ``l``
    and ``r`` how often the two parts of its weakest cut occur; the score is
    ``floor(factor * a / (l + r))``. Phrases rarer than ``least`` do not count,
    nor those inside a longer one that is ``percent`` as frequent or more.

    A null text is empty, and empty texts, or ones of nothing but separators,
    hold no phrase; a null language is ``und``. Repeated rows count each time.
    Very long texts count whole: they become pieces, and pieces chunks of some
    ``FARTHEST`` words at most. Equal scores go by the larger ``a``, then by the
    phrase in byte order. Other columns are not read. An empty table gives no
    rows. Only A-Z are lower-cased.
    """
    dictionary = stage(chunk_dictionary(docs, text, lang, spacing), "chunks")
    totals = dictionary.groupBy("lang").agg(F.sum(F.col("times") * F.col("owned")).alias("n"))
    counts = phrase_counts(dictionary, least, slots)
    candidates = counts.where("size > 1").withColumnRenamed("f", "a")
    kept = _uncovered(candidates, percent)
    scored = stage(_scored(kept, counts.where(F.col("size") < LONGEST), factor), "scores")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    lot = F.pmod(F.xxhash64("phrase"), F.lit(LOTS))
    shortlist = scored.withColumn("lot", lot)
    for keys in (["lang", "lot"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        shortlist = shortlist.withColumn("rank", place).where(F.col("rank") <= best)
    found = shortlist.join(totals, "lang")
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

