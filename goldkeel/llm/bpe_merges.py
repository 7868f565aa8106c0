"""Byte-pair merges over many short sequences at once, in ragged numpy arrays.

All sequences lie in one array of symbols with the number of their sequence
beside it. One step finds each sequence's pair of lowest rank and applies it
to every place of that sequence at once, so the number of steps is that of the
longest chain of different pairs, not the number of tokens. That equals merging
one place at a time: a symbol made by a merge only enters pairs that rank later.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json
from array import array

import numpy as np
import regex

NONE = np.iinfo(np.int32).max
WIDTH = 20  # bits of a symbol in a pair's key
LONG = 512  # symbols from which on a sequence is merged by itself


class Merges:
    """Pairs of symbols, their ranks and what they merge into.

    ``symbols`` maps each byte to its symbol. ``spellings`` are the bytes of
    the symbols by number.
    """

    def __init__(self, symbols: np.ndarray, pairs: array, spellings: list[bytes]):
        """``pairs`` holds four numbers a pair: both symbols, rank, result. It
        is flat, as every worker process builds one."""
        table = np.frombuffer(pairs, np.int64).reshape(-1, 4)
        keys = table[:, 0] << WIDTH | table[:, 1]
        order = np.argsort(keys)
        self.symbols, self.spellings = symbols, spellings
        self.keys = keys[order]
        self.ranks, self.merged = (table[order, n].astype(np.int32) for n in (2, 3))

    @classmethod
    @functools.cache
    def from_ranks(cls, path: str) -> Merges:
        """From lines of a token in base 64 and its rank; the rank is the id.
        Two symbols merge whenever their bytes together are a token. A process
        reads a file once."""
        ranks = read_ranks(path)
        pairs = array("q")
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                if token[:cut] in ranks and token[cut:] in ranks:
                    pairs.extend((ranks[token[:cut]], ranks[token[cut:]], rank, rank))
        return cls(np.array([ranks[bytes([b])] for b in range(256)], np.int64), pairs, spelled(ranks))

    @classmethod
    @functools.cache
    def from_json(cls, path: str) -> Merges:
        """From a vocabulary and an ordered list of merges in byte-level letters."""
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        vocabulary = model["vocab"]
        pairs = array("q")
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs.extend((vocabulary[a], vocabulary[b], rank, vocabulary[a + b]))
        backward = {letter: byte for byte, letter in enumerate(letters)}
        spellings = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in backward for c in token):
                spellings[number] = bytes(backward[c] for c in token)
        return cls(np.array([vocabulary[c] for c in letters], np.int64), pairs, spellings)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of all pieces in order, number of symbols of each piece)."""
        data = self.symbols[np.frombuffer(b"".join(pieces), np.uint8)]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        if len(sizes) == 0 or sizes.max() <= LONG:
            return self.merge(data, sizes)
        ends = np.cumsum(sizes)
        out = [np.zeros(0, np.int64)] * len(sizes)
        short = np.flatnonzero(sizes <= LONG)
        for i in np.flatnonzero(sizes > LONG):
            out[i] = self.merge_long(data[ends[i] - sizes[i] : ends[i]])
        symbols, counts = self.merge(data[np.repeat(sizes <= LONG, sizes)], sizes[short])
        at = np.cumsum(counts)
        for i, end, count in zip(short.tolist(), at.tolist(), counts.tolist(), strict=True):
            out[i] = symbols[end - count : end]
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def merge_long(self, data: np.ndarray) -> np.ndarray:
        """The symbols of one long sequence. Live pairs are held by their rank;
        a step applies the lowest one wherever it stands and ranks anew only
        the pairs beside these places, so a step costs what it changes."""
        n = len(data)
        symbol, alive = data.copy(), np.ones(n, bool)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank, made = np.full(n, NONE, np.int64), np.zeros(n, np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def rate(places: np.ndarray) -> None:
            rank[places] = NONE
            places = places[after[places] < n]
            keys = symbol[places] << WIDTH | symbol[after[places]]
            found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = self.keys[found] == keys
            places, found = places[known], found[known]
            rank[places], made[places] = self.ranks[found], self.merged[found]
            places = places[np.argsort(rank[places], kind="stable")]
            firsts = np.flatnonzero(np.append(True, np.diff(rank[places]) > 0)) if len(places) else []
            for some in np.split(places, firsts[1:]) if len(places) else []:
                lowest = int(rank[some[0]])
                if lowest not in waiting:
                    waiting[lowest] = []
                    heapq.heappush(ranks, lowest)
                waiting[lowest].append(some)

        if len(self.keys):
            rate(np.arange(n))
        while ranks:
            lowest = heapq.heappop(ranks)
            places = np.unique(np.concatenate(waiting.pop(lowest)))
            places = places[alive[places] & (rank[places] == lowest)]
            if not len(places):
                continue
            hits = _every_second(places, np.append(True, after[places[:-1]] != places[1:]))
            gone = after[hits]
            symbol[hits], alive[gone], rank[gone] = made[hits], False, NONE
            after[hits] = after[gone]
            inside = after[hits] < n
            before[after[hits][inside]] = hits[inside]
            rate(np.unique(np.concatenate([hits, before[hits][before[hits] >= 0]])))
        return symbol[alive]

    def merge(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sizes)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(data) > 1 and len(self.keys):
            inside = owner[:-1] == owner[1:]
            keys = data[:-1] << WIDTH | data[1:]
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            known = inside & (self.keys[place] == keys)
            rank = np.append(np.where(known, self.ranks[place], NONE), NONE)
            firsts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(rank, firsts)
            best = np.repeat(best, np.diff(np.append(firsts, len(data))))
            over = best == NONE
            if over.any():
                done.append((owner[over], data[over]))
            hit = (rank == best) & ~over
            # Of places that overlap, in a run of one symbol, every second counts.
            run = np.flatnonzero(hit)
            if not len(run):
                data = data[:0]
                break
            run = _every_second(run, np.append(True, np.diff(run) > 1))
            data[run] = self.merged[place[run]]
            keep = ~over
            keep[run + 1] = False
            data, owner = data[keep], owner[keep]
        if len(data):
            done.append((owner, data))
        if not done:
            return data, np.zeros(len(sizes), np.int64)
        owners = np.concatenate([o for o, _ in done])
        order = np.argsort(owners, kind="stable")
        symbols = np.concatenate([d for _, d in done])[order]
        return symbols, np.bincount(owners, minlength=len(sizes))


def _every_second(places: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The first, third and so on of each run of adjoining places."""
    number = np.arange(len(places))
    since = number - np.maximum.accumulate(np.where(begins, number, 0))
    return places[since % 2 == 0]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def spelled(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of tokens by number."""
    spellings = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        spellings[rank] = token
    return spellings


@functools.cache
def spellings_of(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, starts, bytes) of the tokens of a file of ranks, all that
    decoding needs of it."""
    tokens = spelled(read_ranks(path))
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return sizes, np.cumsum(sizes) - sizes, np.frombuffer(b"".join(tokens), np.uint8)


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: itself if
    it is printable in Latin-1, else the next free letter from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class PieceCache:
    """Symbols of pre-tokens, each worked out once; forgotten when it grows
    beyond ``most`` pre-tokens, which bounds memory and changes no result."""

    def __init__(self, merges: Merges, most: int = 100_000):
        self.merges, self.most = merges, most
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.sizes = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def places(self, pieces: list[str]) -> np.ndarray:
        """A number for each pre-token, which ``sizes`` and ``starts`` go by."""
        if len(self.place) > self.most:
            self._clear()
        new = [p for p in dict.fromkeys(pieces) if p not in self.place]
        if new:
            symbols, sizes = self.merges.encode([p.encode() for p in new])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.starts = np.append(self.starts, len(self.pool) + np.cumsum(sizes) - sizes)
            self.sizes = np.append(self.sizes, sizes)
            self.pool = np.append(self.pool, symbols.astype(np.int32))
        return np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))

    def symbols(self, places: np.ndarray) -> np.ndarray:
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        index = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - self.starts[places], sizes)
        return self.pool[index]


def splitter(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)
