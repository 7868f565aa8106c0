"""Allow and block rules for urls, by a sort-merge range join.

A rule names a host and the beginning of a path, and fits the host with all its
subdomains. A host turned round, label by label, puts a domain before its
subdomains; with the path behind it, a rule's urls of one host are an interval
of such keys: all that begin with the rule's own key. A rule with a path also fits
subdomains, whose labels stand between its host and its path, so that one key
per url could not make it an interval. A url therefore has one key for each
domain its host lies in, from the top down to as many labels as rules have.

Keys and interval ends are sorted together and swept once. The sweep carries
the stack of rules whose intervals are open. Intervals of prefixes nest or are
apart, so the stack is known at each rule's ends, and a key needs only the last
of those before it: a window over the sorted rows carries it along. Of what a
url's keys meet, the longest rule wins.

A domain may hold most urls. Its keys are dealt over shares of bounded size and
its rules go to each share. Domains with rules are broadcast only if they are
counted to be few. No row leaves native expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldkeel.operators.groups import broadcast_if_small
from goldkeel.session import stage

SHARE = 256  # keys of a domain swept in one sort, at least
SHARES = 4096  # parts of a domain; beyond that its shares grow
MAX_DOMAINS = 100_000  # of rules, that go to every task; more are joined by shuffles
ALLOW, BLOCK = "allow", "block"
# No byte of UTF-8: behind a path it sorts after all that begin alike.
LAST = b"\xff"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    A-Z in lower case; empty without ``://`` or for null."""
    rest = _after_scheme(url)
    return F.translate(
        F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    place = F.instr(url, "://")
    return F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise(F.lit(""))


def _turned(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def prepared_rules(rules: DataFrame) -> DataFrame:
    """(domain, path, key, rule, verdict) of rules (host, path, verdict).

    Hosts are put in lower case. Rules without host or verdict are left out,
    a null path is empty. Of rules alike in host and path, block prevails.
    """
    host = F.lower("host")
    clean = rules.where((F.col("host") != "") & F.col("verdict").isNotNull()).select(
        _turned(host).alias("domain"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.concat(host, F.coalesce("path", F.lit(""))).alias("rule"),
        (F.col("verdict") == BLOCK).alias("blocks"),
    )
    return clean.groupBy("domain", "path", "rule").agg(
        F.when(F.max("blocks"), F.lit(BLOCK)).otherwise(F.lit(ALLOW)).alias("verdict")
    )


def _stack_events(rules: DataFrame) -> DataFrame:
    """(domain, at, side, top) at both ends of each rule's interval: the rule
    on top of the stack from there on, null for none.

    An interval's beginning puts its rule on the stack. Its end leaves the rule
    that holds it most closely: of the rules of the domain whose path the own
    path begins with, the longest. They are found by equality with the
    beginnings of the path, as many as it has characters.
    """
    held = F.struct(F.length("path").alias("size"), "rule", "verdict")
    begins = rules.select("domain", F.col("path").cast("binary").alias("at"), F.lit(0).alias("side"), held.alias("top"))
    shorter = F.transform(
        F.sequence(F.lit(1), F.length("path")), lambda n: F.substring("path", F.lit(1), n - 1)
    )
    outer = rules.where(F.length("path") > 0).select(
        "domain", F.col("path").alias("own"), F.explode(shorter).alias("outer")
    )
    around = outer.join(
        rules.select("domain", F.col("path").alias("outer"), held.alias("top")), ["domain", "outer"]
    ).groupBy("domain", "own").agg(F.max("top").alias("top"))
    closed = rules.select("domain", F.col("path").alias("own")).join(around, ["domain", "own"], "left")
    ends = closed.select("domain", F.concat(F.col("own").cast("binary"), F.lit(LAST)).alias("at"), F.lit(2).alias("side"), "top")
    return begins.unionByName(ends)


def judge(pages: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url", share: int = SHARE) -> DataFrame:
    """(id, ``host``, ``path``, ``rule``, ``verdict``) of every row of ``pages``.

    Urls that no rule fits are allowed, with a null rule; so are null and
    malformed ones, whose host and path are empty. The longest rule wins; of
    equally long ones that of the longer host, so there are no ties. Repeated
    rows stay, ids may be null or repeat. Only the two columns are read.
    """
    known = stage(_stack_events(prepared_rules(rules)), "rules")
    urls = pages.select(F.col(id).alias("id"), F.col(url).alias("url")).groupBy("id", "url").agg(
        F.count(F.lit(1)).alias("times")
    )
    urls = urls.select("id", "times", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.", -1)
    n = F.size(labels)
    # Only as many labels as a rule's domain has at most.
    deepest = known.agg(F.max(F.size(F.split("domain", r"\.", -1)))).first()[0] or 0
    domains = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(max(1, deepest)))), lambda k: F.array_join(F.reverse(F.slice(labels, n - k + 1, k)), ".")
    )
    keys = urls.where("host <> ''").select("id", "url", "host", "path", F.explode(domains).alias("domain"))
    # Only domains that have rules; the rest meets none.
    named = broadcast_if_small(known.select("domain").distinct(), MAX_DOMAINS)
    keys = keys.join(named, "domain", "left_semi")
    # A share has at least as many keys as rules, so copied rules never outweigh them.
    rows = known.groupBy("domain").agg(F.count(F.lit(1)).alias("rules"))
    sizes = keys.groupBy("domain").agg(F.count(F.lit(1)).alias("keys")).join(rows, "domain")
    parts = F.least(F.lit(SHARES), F.ceil(F.col("keys") / F.greatest(F.lit(share), "rules")))
    shares = sizes.select("domain", parts.cast("int").alias("shares"))
    shares = broadcast_if_small(stage(shares, "shares"), MAX_DOMAINS)
    events = known.join(shares, "domain").select(
        "domain", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "at", "side", "top"
    )
    dealt = keys.join(shares, "domain").select(
        "domain",
        F.pmod(F.xxhash64("id", "url"), F.col("shares")).cast("int").alias("share"),
        F.col("path").cast("binary").alias("at"),
        F.lit(1).alias("side"),
        "id",
        "url",
    )
    # What the stack holds is wrapped, so that an empty stack is not passed over.
    swept = events.withColumn("stack", F.struct("top")).unionByName(dealt, allowMissingColumns=True)
    sweep = Window.partitionBy("domain", "share").orderBy("at", "side")
    sweep = sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = swept.select("side", "id", "url", "domain", F.last("stack", ignorenulls=True).over(sweep).alias("stack"))
    met = met.where("side = 1 and stack.top is not null").select(
        "id",
        "url",
        F.struct(
            F.length("stack.top.rule").alias("size"),
            F.length("domain").alias("host"),
            F.col("stack.top.rule").alias("rule"),
            F.col("stack.top.verdict").alias("verdict"),
        ).alias("best"),
    )
    asked = urls.select("id", "url", "times", "host", "path", F.lit(None).cast(met.schema["best"].dataType).alias("best"))
    both = asked.unionByName(met, allowMissingColumns=True)
    found = both.groupBy("id", "url").agg(
        F.max("times").alias("times"), F.max("host").alias("host"), F.max("path").alias("path"), F.max("best").alias("best")
    )
    return found.select(
        F.col("id").alias(id),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_copy"),
    ).drop("_copy")
