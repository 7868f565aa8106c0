"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is read as words and tags. Words score positive and tags negative; one
linear scan finds the contiguous region of the largest sum. The weights come
from labelled pages: what an element's name, class, id or role says about the
words within it, and how often a tag occurs inside and outside the content.
Words in elements that only hold page furniture score negative, so the region
goes around them where it can, and leaves them out where it cannot.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeel.llm.labelled_pages import PAGES

# Kinds of HTML elements.
HIDDEN = frozenset("script style noscript template head title iframe svg canvas object textarea math".split())
RAW = frozenset("script style noscript template iframe svg textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup"
    " time tt u var wbr br img".split()
)
# Elements whose name says nothing about the words within.
NEUTRAL = INLINE | frozenset(
    "html body div section p table caption tr td th tbody thead tfoot ul ol li dl dt dd h1 h2 h3 h4 h5 h6 blockquote"
    " pre figure figcaption hr address details summary".split()
)
CONTAINERS = frozenset("article main".split())
HEADED = CONTAINERS | {"h1"}  # what only content holds

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?][^>]*>|(?P<endless></?[a-zA-Z])",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
# Attributes of an element that is not shown.
UNSEEN = re.compile(
    r"""(?:^|\s)(?:hidden(?=[\s=/]|$)(?!\s*=\s*["']?until-found)|aria-hidden\s*=\s*["']?true|"""
    r"""style\s*=\s*(?:"[^"]*|'[^']*)\bdisplay\s*:\s*none)""",
    re.I,
)
PART = re.compile(r"[a-z]+")
CLOSING = {name: re.compile(f"</{name}", re.I) for name in RAW}


@dataclass
class Weights:
    """``within``: what an element's features add to the words in it, negative
    for furniture. ``tag``: the cost of a tag."""

    within: dict[str, float] = field(default_factory=dict)
    tag: dict[str, float] = field(default_factory=dict)
    word: float = 1.0


def features_of(name: str, rest: str) -> list[str]:
    """Name and the words of class, id and role of an opening tag."""
    found = [] if name in NEUTRAL else [name]
    if "=" in rest and name not in ("html", "body"):
        for key, *values in ATTRIBUTE.findall(rest):
            if key.lower() in ("class", "id", "role"):
                found += ["." + part for part in PART.findall("".join(values).lower())]
    return found


@dataclass
class Element:
    """Features of an open element. ``holds``: it has an article, a main part
    or a first heading within, so that its class can't make it furniture."""

    name: str
    features: list[str]
    holds: bool = False


@dataclass
class Piece:
    """A tag, or a run of text, with the elements around it that have features."""

    tag: str = ""
    text: str = ""
    around: tuple[Element, ...] = ()


def pieces(page: str) -> Iterator[Piece]:
    """Tags and visible texts of a page in order.

    A closing tag closes what is open within its element; without an open
    element it closes nothing. Contents of hidden elements are left out. A tag
    or comment that never ends is the end of the page. A piece's elements are
    complete only when the page is read to its end. An element that is hidden by
    an attribute is left out with all it holds.
    """
    stack: list[Element] = []
    depths: Counter = Counter()  # open elements by name
    around: tuple[Element, ...] = ()
    at, hidden, depth = 0, "", 0
    for token in TOKEN.finditer(page):
        if token.start() < at:
            continue
        if not hidden and token.start() > at:
            yield Piece(text=page[at : token.start()], around=around)
        at = token.end()
        if token["endless"]:
            return
        name = (token["name"] or "").lower()
        if not name:
            continue
        if hidden == "head" and name == "body":
            hidden = ""
        if hidden:
            if name == hidden and not token["rest"].endswith("/"):
                depth += -1 if token["close"] else 1
                hidden = hidden if depth else ""
            continue
        if token["close"]:
            changed = False
            while depths[name]:
                last = stack.pop()
                depths[last.name] -= 1
                changed = changed or bool(last.features)
                if last.name == name:
                    break
            if changed:
                around = tuple(e for e in stack if e.features)
            yield Piece(tag="/" + name, around=around)
            continue
        yield Piece(tag=name, around=around)
        if name in RAW:
            end = CLOSING[name].search(page, at)
            at = end.start() if end else len(page)
            continue
        features = features_of(name, token["rest"])
        if name in HEADED:
            for element in around:
                element.holds = True
        if name in HIDDEN or name not in VOID and UNSEEN.search(token["rest"]):
            hidden, depth = name, int(not token["rest"].endswith("/"))
            hidden = hidden if depth else ""
        elif name not in VOID and (features or name not in INLINE and name != "p"):
            stack.append(Element(name, features))
            depths[name] += 1
            if features:
                around = (*around, stack[-1])
    if not hidden and at < len(page):
        yield Piece(text=page[at:], around=around)


def learn(pages: list[list[tuple[str, bool]]]) -> Weights:
    """Weights from labelled pages: log odds of a word, or a tag, to be part
    of the content given a feature, or its name."""
    inside: Counter = Counter()
    outside: Counter = Counter()
    tags: dict[bool, Counter] = {True: Counter(), False: Counter()}
    words = Counter()
    for parts in pages:
        page = "".join(markup for markup, _ in parts)
        edges, total = [], 0
        for markup, label in parts:
            total += len(markup)
            edges.append((total, label))
        at = 0
        for piece in pieces(page):
            if piece.tag:
                at = page.find("<" + piece.tag, at)
                label = next(lab for end, lab in edges if at < end)
                tags[label][piece.tag] += 1
                at += 1
                continue
            at = page.find(piece.text, at)
            label = next(lab for end, lab in edges if at < end)
            count = len(piece.text.split())
            words[label] += count
            seen = {f for element in piece.around for f in element.features}
            (inside if label else outside).update({f: count for f in seen})
            at += len(piece.text)
    within = {
        f: math.log((inside[f] + 1) / (outside[f] + 1)) + math.log(words[False] / words[True])
        for f in inside.keys() | outside.keys()
    }
    rate = {label: sum(tags[label].values()) / words[label] for label in tags}
    tag = {}
    for name in tags[True].keys() | tags[False].keys():
        odds = math.log((tags[True][name] + 1) / (tags[False][name] + 1))
        tag[name] = -min(4.0, max(0.05, math.log1p(rate[False] / rate[True]) - odds))
    return Weights({f: w for f, w in within.items() if abs(w) >= 0.7}, tag)


WEIGHTS = learn(PAGES)
WITHIN = 0.01  # share of its cost that a tag or furniture has within content
OTHER_TAG = -0.5  # a tag the labelled pages don't have


def scores(page: str, weights: Weights) -> list[tuple[Piece, float]]:
    """Each piece with its score: a text's is that of all its words."""
    out = []
    known: dict[int, tuple[float, bool]] = {}
    for piece in list(pieces(page)):
        key = id(piece.around)
        if key not in known:
            known[key] = _word_score(piece.around, weights)
        word, within = known[key]
        if piece.tag:
            cost = weights.tag.get(piece.tag, OTHER_TAG)
            out.append((piece, cost * WITHIN if within else cost))
        else:
            out.append((piece, word * len(piece.text.split())))
    return out


def _word_score(around: tuple[Element, ...], weights: Weights) -> tuple[float, bool]:
    """Score of a word, and whether it is within a content element. Of the
    elements around it, one that says furniture makes it negative, else the
    surest content element raises it.

    Furniture within content weighs little, so that the region goes across it.
    A heading area within an article is part of it, one outside is not.
    """
    lowest, highest, article, within = 0.0, 0.0, False, False
    for element in around:
        total = 0.0
        for feature in element.features:
            weight = weights.within.get(feature, 0.0)
            if weight < 0 and (feature[0] == "." and element.holds or feature == "header" and article):
                continue
            total += weight
        lowest, highest = min(lowest, total * WITHIN if within else total), max(highest, total)
        article = article or element.name in CONTAINERS
        within = within or article or total > 1
    return (lowest, within) if lowest < 0 else (weights.word + highest / 2, within)


def best_region(values: list[float]) -> tuple[int, int]:
    """(begin, end) of the contiguous part with the largest positive sum, the
    first such and the shortest; empty if there is none."""
    best, begin, end = 0.0, 0, 0
    total, since = 0.0, 0
    for i, value in enumerate(values):
        if total <= 0:
            total, since = 0.0, i
        total += value
        if total > best:
            best, begin, end = total, since, i + 1
    return begin, end


def main_text(page: str | None, weights: Weights = WEIGHTS) -> str:
    """Blocks of the best region in page order, one to a line, each with its
    character references decoded and white space as single blanks."""
    scored = scores(page or "", weights)
    begin, end = best_region([v for _, v in scored])
    blocks: list[list[str]] = [[]]
    for piece, value in scored[begin:end]:
        if piece.tag:
            if piece.tag.lstrip("/") == "br":
                blocks[-1].append(" ")
            elif piece.tag.lstrip("/") not in INLINE:
                blocks.append([])
        elif value >= 0:
            blocks[-1].append(html.unescape(piece.text))
    lines = (" ".join("".join(block).split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def content(column: Column) -> Column:
    """Main text of a page's html; empty for null and for pages without any."""

    @F.pandas_udf("string")
    def extracted(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    return extracted(F.coalesce(column, F.lit("")))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; repeated rows and null ids
    and urls stay as they are, other columns are not read. A null or empty page
    has an empty text, very long pages are read whole. Of regions that score
    alike the first counts. An empty table gives none."""
    found = pages.select("page_id", "url", content(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
