"""Text rules: comparison keys, addresses, zips and phones as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TextRules:
    """How text compares in filters, joins, groups and keyword tests.

    The default ignores case and trailing blanks. ``EXACT`` compares raw
    values, which lets equality filters reach the Parquet reader.
    """

    case_sensitive: bool = False
    ignore_trailing_blanks: bool = True

    def key(self, col: Column) -> Column:
        """Value under which equal texts group and join together."""
        if self.ignore_trailing_blanks:
            col = F.rtrim(col)
        return col if self.case_sensitive else F.lower(col)

    def literal(self, value: str) -> Column:
        if self.ignore_trailing_blanks:
            value = value.rstrip(" ")
        return F.lit(value if self.case_sensitive else value.lower())

    def equals(self, col: Column, value: str) -> Column:
        """Equality under the rules, with plain bounds that reach the reader.

        Every spelling of an ASCII value lies between its upper case and its
        lower case followed by ``!``, the first sign after a blank. A stored
        value with a letter outside ASCII whose lower case is within, like the
        Kelvin sign, does not equal the ASCII value.
        """
        same = self.key(col) == self.literal(value)
        if not value.isascii() or self == EXACT:
            return same
        bare = value.rstrip(" ") if self.ignore_trailing_blanks else value
        low, high = (bare, bare) if self.case_sensitive else (bare.upper(), bare.lower())
        return (col >= F.lit(low)) & (col < F.lit(high + "!")) & same

    def differs(self, col: Column, value: str) -> Column:
        """NULL stays NULL, so a filter on this drops NULL rows."""
        return self.key(col) != self.literal(value)

    def like(self, col: Column, pattern: str) -> Column:
        return col.like(pattern) if self.case_sensitive else col.ilike(pattern)

    def keys(self, names: Sequence[str]) -> dict[str, Column]:
        return {name: self.key(F.col(name)) for name in names}

    def folded(self, col: Column) -> Column:
        return col if self.case_sensitive else F.lower(col)

    def contains_any(self, folded: Column, words: Sequence[str]) -> Column:
        """Whether a folded text contains one of the words."""
        if not self.case_sensitive:
            words = [w.lower() for w in words]
        found = F.lit(False)
        for word in dict.fromkeys(words):
            found = found | F.contains(folded, F.lit(word))
        return found


DEFAULT_RULES = TextRules()
EXACT = TextRules(case_sensitive=True, ignore_trailing_blanks=False)


def or_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def with_blank_after(col: Column) -> Column:
    """``value + ' '``, or '' for NULL."""
    return F.when(col.isNull(), "").otherwise(F.concat(col, F.lit(" ")))


def address_lines(line1: Column, line2: Column) -> Column:
    """Both street lines; keeps the blank after line 1 even without line 2."""
    return F.concat(with_blank_after(line1), or_blank(line2))


def piped_address(line1: Column, line2: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """Address key whose missing parts count as ''."""
    bar = F.lit(" | ")
    return F.concat(
        address_lines(line1, line2), bar, or_blank(city), bar, or_blank(state), bar, or_blank(zip_code)
    )


def piped_full_address(full: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """Address key that is NULL as soon as one part is."""
    bar = F.lit(" | ")
    return F.concat(full, bar, city, bar, state, bar, zip_code)


def spaced_address(*parts: Column) -> Column:
    return F.concat(*[with_blank_after(p) for p in parts])


def cleanse_phone(phone: Column, strip_country: bool = False) -> Column:
    """Digits only, NULL when none are left."""
    digits = F.regexp_replace(phone, "[^0-9]", "")
    if strip_country:
        digits = F.when(
            (F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)
        ).otherwise(digits)
    return F.nullif(digits, F.lit(""))


def display_phone(phone: Column, missing: str) -> Column:
    """``8562628300`` as ``(856)262-8300``; fewer than 7 characters count as missing."""
    dashed = F.overlay(phone, F.lit("-"), F.lit(7), F.lit(0))
    closed = F.overlay(dashed, F.lit(")"), F.lit(4), F.lit(0))
    return F.when(F.length(phone) >= 7, F.concat(F.lit("("), closed)).otherwise(F.lit(missing))


def fix_zip(zip_code: Column) -> Column:
    """Prefix one '0' to a zip shorter than five characters."""
    return F.when(F.length(F.rtrim(zip_code)) < 5, F.concat(F.lit("0"), zip_code)).otherwise(zip_code)
