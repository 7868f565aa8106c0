"""Personal data in texts, in native expressions throughout.

Regular expressions propose spans, checksums confirm them (Luhn for cards,
mod 97 for bank accounts, number ranges for addresses), and words nearby adjust
a score. Spans count characters (code points), end exclusive. Places come from
splitting a text by the very pattern whose matches are extracted: what lies
between matches, and their lengths, add up to their starts.

The patterns are possessive and begin only where a longer match could not have
begun before, so that they find the same leftmost matches in linear time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeel.llm.common import columns, fresh

SPAN = "struct<kind: string, start: int, end: int, score: double>"
RUN = 256  # places of an array that are summed up by themselves
PIECE = 4096  # characters of a text that is taken apart to be masked
NEARBY = 40  # characters before and after a span in which context words count
ACCEPT = 0.5
CONTEXT = 0.3  # what a context word adds to the score

# Patterns that propose, words that support.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}"
CARD = r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9](?:[ ().-]*+[0-9])++"
IBAN = r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?: ?[A-Z0-9]){11,30}+(?! ?[A-Z0-9])"
SOCIAL = r"[0-9](?<![0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])"
WORDS = {
    "email": ("mail", "contact", "@", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "credit", "visa", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "social": ("ssn", "social security", "tax id", "insured"),
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.split(F.reverse(_digits(match)), "")
    begin = F.struct(F.lit(0).alias("total"), F.lit(0).alias("n"))
    done = F.aggregate(digits, begin, _luhn_step)
    return done["n"].between(13, 19) & (done["total"] % 10 == 0)


def _luhn_step(acc: Column, digit: Column) -> Column:
    value = (F.ascii(digit) - 48) * F.when(acc["n"] % 2 == 1, 2).otherwise(1)
    total = acc["total"] + F.when(value > 9, value - 9).otherwise(value)
    return F.when(digit == "", acc).otherwise(F.struct(total.alias("total"), (acc["n"] + 1).alias("n")))


def _mod97(match: Column) -> Column:
    compact = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(c == "", acc)
        .when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97)
        .otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )
    return F.length(compact).between(15, 34) & (rest == 1)


def _small_parts(match: Column) -> Column:
    # Long parts are compared by their digits after leading zeros.
    short = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(short, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))


def _phone_length(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _always(match: Column) -> Column:
    return match.isNotNull()


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``sign`` is a string every match holds, to pass
    over most texts quickly. ``score`` is that of a confirmed match."""

    name: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    sign: str = ""


# The base kinds are certain once confirmed; the others need a good score.
BASE = (
    Kind("email", EMAIL, _always, 0.7, "@"),
    Kind("ip", IP, _small_parts, 0.6, "."),
    Kind("card", CARD, _luhn, 0.7),
    Kind("phone", PHONE, _phone_length, 0.6, "+"),
)
MORE = (
    Kind("iban", IBAN, _mod97, 0.7),
    Kind("social", SOCIAL, _always, 0.3, "-"),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out only once."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, combine: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """What an array of ints comes to up to each of its places, from 0 on.

    Appending to an array copies it, so runs of ``RUN`` places are combined by
    themselves, then the runs likewise, and each run goes on from the one before.
    """
    none = F.expr("cast(array() as array<int>)")

    def plainly(run: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            return _let(
                combine(acc["last"], x),
                lambda v: F.struct(v.alias("last"), F.concat(acc["found"], F.array(v)).alias("found")),
            )

        return F.aggregate(run, F.struct(F.lit(0).alias("last"), none.alias("found")), step, lambda acc: acc["found"])

    if levels == 0:
        return plainly(values)

    def joined(runs: Column) -> Column:
        lasts = F.transform(runs, lambda r: F.element_at(r, -1))
        before = F.concat(F.array(F.lit(0)), running(lasts, combine, levels - 1))
        return F.flatten(
            F.zip_with(
                runs,
                F.slice(before, 1, F.size(runs)),
                lambda run, last: F.transform(run, lambda x: combine(last, x)),
            )
        )

    def by_runs(whole: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(whole), F.lit(RUN))
        runs = F.transform(starts, lambda n: plainly(F.slice(whole, n, RUN)))
        return F.when(F.size(whole) == 0, none).otherwise(_let(runs, joined))

    return _let(values, by_runs)


def _spans(text: Column, kind: Kind, matches: Column) -> Column:
    """Confirmed spans of a kind, in order of their start. A match's context is
    the end of the gap before it and the beginning of the one behind."""
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    held = F.struct(F.split(text, kind.pattern, -1).alias("gaps"), matches.alias("matches"))

    def found(x: Column) -> Column:
        n = F.size(x["matches"])
        sizes = F.zip_with(
            F.slice(x["gaps"], 1, n), x["matches"], lambda gap, match: F.length(gap) + F.length(match)
        )
        ends = running(sizes, lambda a, b: a + b)
        placed = F.zip_with(x["matches"], ends, lambda match, end: F.struct(match.alias("match"), end.alias("end")))
        context = F.zip_with(
            F.slice(x["gaps"], 1, n),
            F.slice(x["gaps"], 2, n),
            lambda before, behind: F.concat(
                F.right(before, F.lit(NEARBY)), F.lit(" "), F.substring(behind, 1, NEARBY)
            ),
        )
        around = F.zip_with(
            placed,
            context,
            lambda m, near: F.struct(m["match"].alias("match"), m["end"].alias("end"), near.alias("near")),
        )
        return F.transform(F.filter(around, lambda m: kind.confirm(m["match"])), span)

    def span(m: Column) -> Column:
        near = F.lower(m["near"])
        support = F.lit(False)
        for word in WORDS[kind.name]:
            support = support | near.contains(word)
        score = F.lit(kind.score) + F.when(support, F.lit(CONTEXT)).otherwise(F.lit(0.0))
        start = m["end"] - F.length(m["match"])
        return F.struct(
            F.lit(kind.name).alias("kind"), start.alias("start"), m["end"].alias("end"), score.alias("score")
        )

    return F.when(F.size(matches) > 0, _let(held, found)).otherwise(none)


def with_spans(docs: DataFrame, text: str = "text", base_name: str = "base_spans", name: str = "spans") -> DataFrame:
    """Add ``base_spans`` and ``spans``, arrays of (kind, start, end, score).

    Base spans are the confirmed emails, addresses, cards and phones, by kind
    in that order and then by start. ``spans`` adds, likewise, spans of other
    kinds whose score reaches ``ACCEPT``. Null and empty texts have none.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs
    match_names = {kind: fresh(f"{kind.name}_matches", docs) for kind in (*BASE, *MORE)}
    span_names = {kind: fresh(f"{kind.name}_spans", docs) for kind in (*BASE, *MORE)}
    for kind in (*BASE, *MORE):
        all_matches = F.regexp_extract_all(whole, F.lit(kind.pattern), F.lit(0))
        none = F.expr("cast(array() as array<string>)")
        matches = F.when(whole.contains(kind.sign), all_matches).otherwise(none) if kind.sign else all_matches
        found = found.withColumn(match_names[kind], matches)
    for kind in (*BASE, *MORE):
        spans = _spans(whole, kind, F.col(match_names[kind]))
        found = found.withColumn(span_names[kind], spans)
    base = F.concat(*[F.col(span_names[k]) for k in BASE])
    more = F.filter(F.concat(*[F.col(span_names[k]) for k in MORE]), lambda s: s["score"] >= ACCEPT)
    return found.select(*columns(docs), base.alias(base_name), F.concat(base, more).alias(name))


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``,
    ``spans``) of every row; repeated rows and null ids stay. Null and empty
    texts have no spans, very long ones are searched whole. Other columns are
    not read; an empty table gives none."""
    found = with_spans(docs.select(F.col(id), F.col(text)), text)
    counts = [_count("base_spans", kind.name).alias(f"n_{kind.name}") for kind in BASE]
    digest = F.sha2(written(F.col("base_spans")).cast("binary"), 256)
    return found.select(F.col(id), *counts, digest.alias("base_sha256"), written(F.col("spans")).alias("spans"))


def masked(docs: DataFrame, text: str = "text", passes: int = 2) -> DataFrame:
    """``docs`` with each accepted span of the text replaced by its kind in
    brackets; of overlapping spans one mark remains, for all they cover. Other
    columns, null texts and texts without spans stay as they are.

    A mark may end a run of digits that hid another match, hence two passes.
    """
    for _ in range(passes):
        docs = _masked_once(docs, text)
    return docs


def _masked_once(docs: DataFrame, text: str) -> DataFrame:
    base, spans = fresh("base", docs), fresh("all_spans", docs)
    found = with_spans(docs, text, base, spans)
    ordered = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(0))
    # The text in pieces of ``PIECE`` characters, so that none is sought from the beginning.
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    held = F.struct(ordered.alias("spans"), pieces.alias("pieces"))

    def clean(x: Column) -> Column:
        ends = F.transform(x["spans"], lambda s: s["end"])
        covered = running(ends, F.greatest)
        known = F.struct(x["spans"].alias("spans"), x["pieces"].alias("pieces"), covered.alias("covered"))
        return _let(known, marked)

    def marked(x: Column) -> Column:
        before = F.slice(F.concat(F.array(F.lit(0)), x["covered"]), 1, F.size(x["spans"]))
        # A span that begins where others still reach has no mark of its own.
        first = F.filter(
            F.zip_with(
                x["spans"],
                before,
                lambda s, at: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), at.alias("at")),
            ),
            lambda s: s["start"] >= s["at"],
        )
        parts = F.transform(
            first,
            lambda s: F.concat(_between(x["pieces"], s["at"], s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]")),
        )
        rest = _between(x["pieces"], F.element_at(x["covered"], -1), F.lit(PIECE) * F.size(x["pieces"]))
        return F.concat(F.array_join(parts, ""), rest)

    masks = F.when(F.size(spans) > 0, _let(held, clean)).otherwise(F.col(text))
    return found.withColumn(text, masks).select(*columns(docs))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` of a text cut into pieces."""
    first, last = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
    inside = F.substring(F.get(pieces, first), start % PIECE + 1, end - start)
    head = F.substring(F.get(pieces, first), start % PIECE + 1, F.lit(PIECE))
    whole = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    tail = F.coalesce(F.substring(F.get(pieces, last), F.lit(1), end % PIECE), F.lit(""))
    return F.coalesce(F.when(first == last, inside).otherwise(F.concat(F.coalesce(head, F.lit("")), whole, tail)), F.lit(""))
