"""Connected components of a link table, by alternating stars.

A round of the large star hangs every larger neighbour of a node on the node's
smallest neighbour; a round of the small star does so with the smaller ones.
Both keep the components and their links stay at most as many, until each node
hangs on the smallest of its component. Every step is a grouped minimum, which
map tasks combine, and an ordinary join, whose hot keys adaptive execution
splits: no task needs all links of a node, and nothing passes the driver but
two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeel.session import discard, staged


def _fingerprint(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), total).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("lo"), F.least("u", "v").alias("m"))
    return links.join(least, "lo").select("hi", F.col("m").alias("lo")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that is not the smallest of its own.

    ``links`` has two long columns ``a`` and ``b``, in any order and with
    repeats; links to oneself and links with a null end count for nothing. A
    component is named by its smallest node. Without links the result is empty.
    """
    clean = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    current, path = staged(clean, "links")
    seen = _fingerprint(current)
    while seen[0]:
        before = path
        current, path = staged(_small_star(_large_star(current)), "links")
        now = _fingerprint(current)
        discard(links.sparkSession, before)
        if now == seen:
            break
        seen = now
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
