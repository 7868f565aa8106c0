"""Benchmark passages in texts, by q-gram lemma filtering and banded alignment.

A passage of m characters that a text holds with at most k edits shares at
least m + 1 - q - k q of its q-grams with it, and their diagonals (position in
the text less position in the passage) differ by at most k. So the q-grams that
text and passages share are counted in bands of diagonals, each 2 k wide and
overlapping the next by half: every such place lies within one band whole. Bands
that reach the bound are regions to verify by an alignment within the band.
Nothing is missed, and what is returned does meet the edit budget. Passages too
short for that bound take shorter q-grams, so that each non-empty passage has
its full budget. Those whose budget is no edit are found by one automaton, as
whole words: a passage of a letter or two is not meant by its place in others.

The passages are a stated query set. They are looked up in blocks of bounded
size: what the texts hold of one block is written before the next is read, so
that driver and tasks hold one block at a time.
"""

from __future__ import annotations

import functools
import itertools
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeel.llm.common import columns, fresh
from goldkeel.session import stage

WIDTHS = (8, 4)  # of q-grams; 4 leaves a bound above zero to all passages with a budget
EDITS = 0.1  # edits for each character of a passage, at most
BLOCK_CHARS = 1_000_000  # of passages looked up at a time
SLICE = 1 << 20  # characters of texts hashed at a time
HITS = 1 << 22  # q-grams shared by texts and passages, held at a time unless one text has more
BITS = 22  # of the table that rules q-grams out
FACTOR = np.uint64(0x9E3779B97F4A7C15)
MATCHES = "array<struct<item_id: long, start: long, end: long, edits: int>>"


def normalised(text: str | None) -> str:
    """In lower case, white space as single blanks, none at the ends."""
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def qgram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of each q-gram, by doubling: of 2, 4 and then 8 characters."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    width, factor = 1, FACTOR
    with np.errstate(over="ignore"):
        while width < q:
            codes = codes[:-width] * factor + codes[width:]
            width, factor = 2 * width, factor * factor
        return codes * FACTOR


def _edits(size: int) -> int:
    """How many edits the budget of a passage has."""
    return int(size * EDITS)


class Passages:
    """A block of passages, each looked up by the means that suits its length:
    the widest q-grams that leave a bound, or exactly if it allows no edit, then
    on demand as whole words only."""

    def __init__(self, items: list[tuple[int, str]], whole_words: bool = False) -> None:
        kept = [(i, t) for i, t in ((i, normalised(t)) for i, t in items) if t]
        self.sizes = np.array([len(t) for _, t in kept], np.int64)
        self.edits = np.array([_edits(len(t)) for _, t in kept], np.int64)
        by_width: dict[int, list[tuple[int, str]]] = {}
        for i, t in kept:
            k = _edits(len(t))
            width = next(q for q in WIDTHS if len(t) + 1 - q - k * q >= 1) if k else 0
            by_width.setdefault(width, []).append((i, t))
        self.exact = Exact(by_width.pop(0, []), whole_words)
        self.blocks = [Block(chosen, q) for q, chosen in by_width.items()]

    def search(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """Matches (item id, start, end, edits) of each normalised text."""
        found = [self.exact.search(t) for t in texts]
        for block in self.blocks:
            for matches, more in zip(found, block.search(texts), strict=True):
                matches += more
        return [_best(matches) for matches in found]

    def search_long(self, text: str) -> list[tuple[int, int, int, int]]:
        """Matches of one text in windows that share a passage's room."""
        overlap = int((self.sizes + 4 * np.maximum(self.edits, 1)).max(initial=0)) + max(WIDTHS)
        found = []
        for begin in range(0, len(text), SLICE):
            for item, start, end, edits in self.search([text[begin : begin + SLICE + overlap]])[0]:
                found.append((item, begin + start, begin + end, edits))
        return _best(found)


class Exact:
    """Passages that allow no edit, all found in one pass over a text."""

    def __init__(self, kept: list[tuple[int, str]], whole_words: bool) -> None:
        self.whole_words = whole_words
        ids: dict[str, set[int]] = {}
        for i, t in kept:
            ids.setdefault(t, set()).add(i)
        self.automaton = ahocorasick.Automaton()
        for t, same in ids.items():
            self.automaton.add_word(t, (len(t), sorted(same)))
        if ids:
            self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        if not len(self.automaton):
            return []
        return [
            (i, last + 1 - size, last + 1, 0)
            for last, (size, ids) in self.automaton.iter(text)
            if not (self.whole_words and (_one_word(text, last + 1 - size) or _one_word(text, last + 1)))
            for i in ids
        ]


def _one_word(text: str, place: int) -> bool:
    """Whether a place has letters or digits of one word on both sides. Scripts
    from U+2E80 on are mostly written without blanks; there it never has."""
    if not 0 < place < len(text):
        return False
    a, b = text[place - 1], text[place]
    return a.isalnum() and b.isalnum() and a < "\u2e80" and b < "\u2e80"


class Block:
    """Passages with an index of their q-grams of one width."""

    def __init__(self, kept: list[tuple[int, str]], q: int) -> None:
        self.q = q
        self.ids = [i for i, _ in kept]
        self.texts = [t for _, t in kept]
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.edits = np.array([_edits(len(t)) for t in self.texts], np.int64)
        self.bounds = sizes + 1 - q - self.edits * q
        self.sizes, self.steps = sizes, np.maximum(self.edits, 1)
        hashes = [qgram_hashes(_codes(t), q) for t in self.texts]
        every = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(every, kind="stable")
        item = np.repeat(np.arange(len(kept)), [len(h) for h in hashes])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(h)) for h in hashes]])
        self.item, self.place = item[order], place[order]
        self.hashes, self.firsts, self.counts = np.unique(every[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << BITS, bool)
        self.table[self.hashes >> np.uint64(64 - BITS)] = True

    def search(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """Matches (item id, start, end, edits) of each normalised text."""
        found: list[list] = [[] for _ in texts]
        if not self.ids or not texts:
            return found
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        hashes = qgram_hashes(_codes("\n".join(texts)), self.q)  # no q-gram of a passage holds a line feed
        at = np.flatnonzero(self.table[hashes >> np.uint64(64 - BITS)])
        slot = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        same = self.hashes[slot] == hashes[at]
        at, slot = at[same], slot[same]
        times = self.counts[slot]
        if len(texts) > 1 and times.sum() > HITS:
            half = len(texts) // 2
            return self.search(texts[:half]) + self.search(texts[half:])
        entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - self.firsts[slot], times)
        at = np.repeat(at, times)
        text = np.searchsorted(begins, at, side="right") - 1
        item = self.item[entry]
        # Counted from before the text, so that no diagonal is negative.
        diagonal = at - begins[text] - self.place[entry] + self.sizes[item]
        band = diagonal // self.steps[item]
        key = (text * len(self.ids) + item) << 32
        keys = np.concatenate([key + band, key + np.maximum(band - 1, 0)])
        order = np.argsort(keys, kind="stable")
        keys, firsts, counts = np.unique(keys[order], return_index=True, return_counts=True)
        items = (keys >> 32) % len(self.ids)
        for k in np.flatnonzero(counts >= self.bounds[items]):
            number, i = divmod(int(keys[k]) >> 32, len(self.ids))
            hits = order[firsts[k] : firsts[k] + counts[k]] % len(at)
            if not self._dense(i, diagonal[hits], self.place[entry[hits]]):
                continue
            match = self._verify(texts[number], i, (int(keys[k]) & 0xFFFFFFFF) * int(self.steps[i]) - int(self.sizes[i]))
            if match:
                found[number].append((self.ids[i], *match))
        return found

    def _dense(self, i: int, diagonals: np.ndarray, places: np.ndarray) -> bool:
        """Whether some range of diagonals as wide as the budget holds as many
        different q-grams of the passage as the bound asks for."""
        order = np.argsort(diagonals, kind="stable")
        diagonals, places = diagonals[order], places[order]
        ends = np.searchsorted(diagonals, diagonals + self.edits[i], side="right")
        for begin in np.flatnonzero(ends - np.arange(len(ends)) >= self.bounds[i]):
            if len(np.unique(places[begin : ends[begin]])) >= self.bounds[i]:
                return True
        return False

    def _verify(self, text: str, i: int, diagonal: int) -> tuple[int, int, int] | None:
        """The passage's best place near the band that begins at a diagonal."""
        passage, budget = self.texts[i], int(self.edits[i])
        low = max(0, diagonal - budget)
        high = min(len(text), diagonal + 2 * int(self.steps[i]) + len(passage) + budget)
        exact = text.find(passage, low, high)
        if exact >= 0:
            return exact, exact + len(passage), 0
        match = align(passage, text[low:high], budget)
        return match and (low + match[0], low + match[1], match[2])


def align(passage: str, region: str, budget: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the passage's best place in the region, or None
    if that takes more edits than the budget.

    Rows of the alignment are the passage's characters. Row r only holds the
    columns from r - budget to r + budget + the region's surplus length, as no
    alignment within the budget leaves that band.
    """
    m, n = len(passage), len(region)
    if n < m - budget:
        return None
    a, b = _codes(passage), _codes(region)
    width = 2 * budget + max(0, n - m) + 1
    far = 1 << 30
    columns = np.arange(width) - budget
    # cost and start of alignments that end before column (row + columns)
    inside = (columns >= 0) & (columns <= n)
    cost, start = np.where(inside, 0, far), columns.copy()
    steps = np.arange(width)
    for row in range(m):
        end = row + 1 + columns  # the column each cell of the new row ends before
        letter = b[np.clip(end - 1, 0, max(n - 1, 0))] if n else np.zeros(width, np.uint64)
        valid = (end >= 0) & (end <= n)
        diagonal = np.where(end >= 1, cost + (letter != a[row]), far)
        above_cost, above_start = np.append(cost[1:], far) + 1, np.append(start[1:], 0)
        take = above_cost < diagonal
        new, begun = np.where(take, above_cost, diagonal), np.where(take, above_start, start)
        new = np.where(valid, np.minimum(new, far), far)
        # Then runs of extra text characters, each one edit.
        least = np.minimum.accumulate(new - steps)
        source = np.maximum.accumulate(np.where(new - steps == least, steps, 0))
        cost, start = np.where(valid, least + steps, far), begun[source]
        if cost.min() > budget:  # costs never fall from row to row
            return None
    best = int(np.argmin(cost))
    if cost[best] > budget:
        return None
    return int(start[best]), int(m + columns[best]), int(cost[best])


def _best(matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of overlapping matches of a passage, that with the fewest edits."""
    kept: dict[int, list[tuple[int, int, int]]] = {}
    for item, start, end, edits in sorted(set(matches), key=lambda x: (x[3], x[0], x[1])):
        mine = kept.setdefault(item, [])  # in order, and none overlaps another
        at = bisect_left(mine, (start,))
        if (at == 0 or mine[at - 1][1] <= start) and (at == len(mine) or mine[at][0] >= end):
            mine.insert(at, (start, end, edits))
    return sorted((item, *place) for item, places in kept.items() for place in places)


def _blocks(benchmark: DataFrame, id: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The passages in blocks that hold about so many characters, collected one
    at a time."""
    rows = benchmark.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
    rows = rows.where(F.length("text") > 0)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-chars // block_chars))
    for part in range(parts):
        chosen = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        yield [tuple(r) for r in chosen.distinct().orderBy("id", "text").collect()]


def matches_in(column: Column, items: list[tuple[int, str]]) -> Column:
    """All matches of a block of passages, with places in the normalised text."""

    @F.pandas_udf(MATCHES)
    def searched(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        passages = Passages(items, whole_words=True)
        for batch in batches:
            out: list[list] = []
            waiting: list[str] = []
            size = 0
            for text in map(normalised, batch):
                if len(text) > SLICE:
                    out += [*passages.search(waiting), passages.search_long(text)]
                    waiting, size = [], 0
                    continue
                waiting.append(text)
                size += len(waiting[-1])
                if size >= SLICE:
                    out += passages.search(waiting)
                    waiting, size = [], 0
            out += passages.search(waiting)
            yield pd.Series([[dict(zip(FIELDS, m, strict=True)) for m in ms] for ms in out], dtype=object)

    return searched(column)


FIELDS = ("item_id", "start", "end", "edits")


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    to: str,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Add the array of matches. Null and empty texts hold none, very long ones
    are searched whole; passages that are null, blank or without an id are not
    looked for; of equal passages each id is reported. An empty benchmark
    matches nothing. Other columns may have any name but ``to``."""
    blocks = _blocks(benchmark, item_id, item_text, block_chars)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        return docs.withColumn(to, matches_in(F.col(text), first))
    parts = []
    for items in itertools.chain([first, second], blocks):
        held = docs.select(F.sha2(text, 256).alias("key"), F.col(text).alias("text")).dropna()
        held = held.select("key", matches_in(F.col("text"), items).alias("found")).where(F.size("found") > 0)
        parts.append(stage(held.dropDuplicates(["key"]), "matches"))
    # All matches of one text; few texts have any.
    key, found = fresh("text_key", docs), fresh("found", docs)
    every = functools.reduce(DataFrame.unionByName, parts).groupBy(F.col("key").alias(key))
    every = every.agg(F.flatten(F.collect_list("found")).alias(found))
    none = F.expr(f"cast(array() as {MATCHES})")
    joined = docs.withColumn(key, F.sha2(text, 256)).join(every, key, "left")
    return joined.select(*columns(docs), F.coalesce(found, none).alias(to))


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per match: id, ``item_id``, ``start``, ``end``, ``edits``.

    Clean rows give none, as do null and empty texts; repeated rows repeat
    theirs. Other columns are not read; an empty table gives none.
    """
    found = with_matches(docs.select(F.col(id), F.col(text).alias("_text")), benchmark, "_matches", "_text")
    return found.select(F.col(id), F.inline("_matches"))
