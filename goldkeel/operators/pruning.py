"""Leave rows out early whose key a smaller table does not have.

A blocked Bloom filter as an ordinary table: a key's hash names one of at most
``WORDS`` words of 64 bits and ``PROBES`` bits in it. The filter holds a row per
word in use, so its size is bounded by that number whatever the data; it is
built by a grouped ``bit_or``, which map tasks combine, and met by broadcast.
It lets some foreign rows pass and holds none back that belongs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 20  # 16 MB of words and their numbers
PROBES = 4
KEYS_PER_WORD = 8  # more than that, and the filter lets most rows pass


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(words))


def _bits(keys: Sequence[str]) -> Column:
    spread = F.xxhash64(F.lit(2), *keys)
    bits = F.lit(0).cast("long")
    for probe in range(PROBES):
        place = F.shiftrightunsigned(spread, 6 * probe).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


def key_filter(keys: DataFrame, words: int = WORDS) -> DataFrame:
    """The filter of all rows of ``keys``, a table of key columns without nulls."""
    names = keys.columns
    return keys.groupBy(_word(names, words).alias("_word")).agg(F.bit_or(_bits(names)).alias("_bits"))


def filtered_by_keys(rows: DataFrame, keys: Sequence[str], held: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows whose key may be in the filter ``held``, which goes to every task."""
    bits = _bits(keys)
    hit = (_word(keys, words) == held["_word"]) & (held["_bits"].bitwiseAND(bits) == bits)
    return rows.join(F.broadcast(held), hit, "left_semi")


def pruned(rows: DataFrame, by: DataFrame, keys: Sequence[str], max_rows: int, words: int = WORDS) -> DataFrame:
    """Rows less those whose key ``by``, a staged table, does not have: by its
    keys themselves up to ``max_rows`` of them, by a filter up to what it can
    tell apart, and none beyond that. The join that follows decides."""
    named = by.select(*keys).dropna()
    most = KEYS_PER_WORD * words
    held = named.limit(max(max_rows, most) + 1).count()
    if held <= max_rows:
        return rows.join(F.broadcast(named), list(keys), "left_semi")
    if held <= most:
        return filtered_by_keys(rows, keys, key_filter(named, words), words)
    return rows
