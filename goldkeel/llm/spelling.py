"""Spelling variants of a vocabulary by a bit-sliced position index.

The index of a block of words has a bitmap for each (position, letter): a bit
per word that has this letter there. A word is looked up in all words of the
block at once, 64 to a machine word: going through its letters, one set holds
the words that agree so far without an error, another those that agree but for
one. An error is a letter replaced, missing or added, after which positions are
compared shifted by one; words of a block have one length, so the length of the
word looked up says which of the three it can be.

Words one error apart agree in their first two letters or in their last two, if
they have five or more. So a block holds words of one length that begin, or
end, alike, and is split if it is large; pairs found by their ends count only
if their beginnings differ.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeel.session import stage

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EDGE = 2  # letters by which blocks are formed
SHORTEST = 5  # letters of a word, so that one error leaves one of its edges whole
BLOCK = 32768  # words of a block
CELLS = 1 << 22  # words of a block times their length
AGAIN = 97  # a run whose checksum this divides loses a letter
ROUNDS = 64


def vocabulary(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = 3
) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` letters that occur at
    least ``least`` times after the deletions."""
    runs = docs.select(
        F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"),
    )
    number = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = F.when(number % AGAIN == 0, (number % F.length("run")).cast("int"))
    shortened = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    words = runs.select(F.when(place.isNull(), F.col("run")).otherwise(shortened).alias("word"))
    counted = words.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least)


class PositionIndex:
    """Words of one length, each a row of code points, by (position, letter)."""

    def __init__(self, words: np.ndarray) -> None:
        self.count, self.length = words.shape
        self.size = -(-self.count // 64)
        self.none = np.zeros(self.size, np.uint64)
        everyone = np.zeros(self.size * 64, np.uint8)
        everyone[: self.count] = 1
        self.all = np.packbits(everyone, bitorder="little").view("<u8")
        self.at: list[dict[int, np.ndarray]] = []
        for place in range(self.length):
            letters, which = np.unique(words[:, place], return_inverse=True)
            bits = np.zeros((len(letters), self.size * 64), np.uint8)
            bits[which, np.arange(self.count)] = 1
            maps = np.packbits(bits, axis=1, bitorder="little").view("<u8")
            self.at.append(dict(zip(letters.tolist(), maps, strict=True)))

    def _has(self, place: int, letter: int) -> np.ndarray:
        if 0 <= place < self.length:
            return self.at[place].get(letter, self.none)
        return self.none

    def near(self, word: np.ndarray) -> np.ndarray:
        """Places of the words exactly one error away from this one."""
        shift = self.length - len(word)
        if abs(shift) > 1 or not self.count:
            return np.zeros(0, np.int64)
        exact, one = self.all, self.none
        for i, letter in enumerate(word.tolist()):
            same = self._has(i, letter)
            # Words with an error before this letter are compared shifted.
            later = one & self._has(i + shift, letter)
            if shift == 0:
                one = later | (exact & ~same)
            elif shift == 1:  # the word of the index has a letter more, here
                one = later | (exact & self._has(i + 1, letter))
            else:  # this letter is the one it lacks
                one = later | exact
            exact = exact & same
            if not one.any() and not exact.any():
                return np.zeros(0, np.int64)
        if shift == 1:  # or the letter more is its last
            one = one | exact
        return np.flatnonzero(np.unpackbits(one.view(np.uint8), bitorder="little"))


def _code_points(words: list[str]) -> np.ndarray:
    """Equally long words as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def look_up(table: pa.Table) -> pa.Table:
    """(word, n, n_near, form_n, form) for the words looked up in one block
    that have a near one there; the form is the best near word."""
    side, length = (table.column(c)[0].as_py() for c in ("side", "length"))
    mine = np.array(table.column("own").to_pylist(), bool)
    words = table.column("word").to_pylist()
    counts = table.column("n").to_numpy()
    held = sorted((words[i], int(counts[i])) for i in np.flatnonzero(mine))
    found: tuple[list, ...] = ([], [], [], [], [])
    if held:
        index = PositionIndex(_code_points([w for w, _ in held]))
        assert index.length == length
        for i in np.flatnonzero(~mine):
            near = index.near(_code_points([words[i]])[0])
            if side:  # those that begin alike were found by that
                near = [j for j in near if held[j][0][:EDGE] != words[i][:EDGE]]
            if len(near):
                best = min(near, key=lambda j: (-held[j][1], held[j][0]))
                for column, value in zip(
                    found, (words[i], int(counts[i]), len(near), held[best][1], held[best][0]), strict=True
                ):
                    column.append(value)
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array(c, kind) for c, kind in zip(found, kinds, strict=True)]
    return pa.Table.from_arrays(columns, names=["word", "n", "n_near", "form_n", "form"])


def near_words(words: DataFrame, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """(word, n, n_near, form_n, form) of the words that have near ones, the
    last two of the near word with the largest count. Stage ``words`` first."""
    letters = F.length("word")
    edges = F.array(F.substring("word", 1, EDGE), F.expr(f"right(word, {EDGE})"))
    dealt = words.select("word", "n", letters.alias("own_length"), F.posexplode(edges).alias("side", "edge"))
    indexed = dealt.withColumn("length", F.col("own_length"))
    # As many rows as there are edges and lengths.
    most = F.greatest(F.lit(8), F.least(F.lit(block), F.floor(F.lit(cells) / F.col("length"))))
    keys = ["side", "edge", "length"]
    parts = indexed.groupBy(*keys).agg(F.count(F.lit(1)).alias("held"))
    parts = parts.select(*keys, F.ceil(F.col("held") / most).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    index = indexed.join(parts, keys).select(
        *keys, part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("lot"),
        F.lit(True).alias("own"), "word", "n",
    )
    lengths = F.explode(F.array(*[F.col("own_length") + d for d in (-1, 0, 1)])).alias("length")
    asking = dealt.select("word", "n", "side", "edge", lengths).join(parts, keys)
    # A split block is met in lots as well, each part with each lot.
    asking = asking.select(
        *keys, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), part.alias("lot"),
        F.lit(False).alias("own"), "word", "n",
    )
    found = index.unionByName(asking).groupBy(*keys, "part", "lot").applyInArrow(
        look_up, "word string, n long, n_near long, form_n long, form string"
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last. Counts at least double from
    word to form, so chains are short; each round doubles the steps taken."""
    current = stage(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ROUNDS):
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        moved = current.join(onward, "root", "left")
        current = stage(
            moved.select("word", F.coalesce("farther", "root").alias("root"), F.col("farther").isNotNull().alias("on")),
            "roots",
        )
        if not current.where("on").limit(1).count():
            break
        current = current.drop("on")
    return current.select("word", "root")


def variants(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    least: int = 3,
    ratio: int = 2,
    block: int = BLOCK,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    Words are runs of letters of at least ``shortest`` (five or more) that
    occur at least ``least`` times; only A-Z are lower-cased. ``n_near`` words
    differ from a word by exactly one letter added, left out or replaced. Its
    form is the most frequent of them (the smallest of equally frequent ones),
    if that occurs at least ``ratio`` times as often, otherwise null; following
    forms leads to its root, itself if it has none.

    A null or empty text has no words, a null id counts as an empty one.
    Repeated rows count each time. Very long texts are read whole, and a very
    long run is a word like any other: the longer the words, the fewer of them
    share a block. Other columns are not read. An empty table gives no rows.
    """
    if shortest < 2 * EDGE + 1:
        raise ValueError(f"words need {2 * EDGE + 1} letters or more")
    words = stage(vocabulary(docs, id, text, shortest, least), "vocabulary")
    near = stage(near_words(words, block), "near")
    reached = F.col("form_n") >= ratio * F.col("n")
    formed = near.select(
        "word",
        "n_near",
        F.when(reached, F.col("form")).alias("form"),
        F.when(reached, F.col("form_n")).alias("form_n"),
    )
    roots = _roots(formed.where("form is not null"))
    joined = words.join(formed, "word", "left").join(roots, "word", "left")
    return joined.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
