"""Sorted reports whose place is a column.

An ordered table is no order once it is stored. These reports carry the place
of each row instead, numbered without gathering rows: rows are dealt out by
ranges of the sort key, each task sorts and numbers its own, and what stands
before a task is added from the few row counts of the tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeel.operators.charts import _ordering
from goldkeel.session import stage

PART_BITS = 33  # of monotonically_increasing_id: task above, place within below


def numbered_report(df: DataFrame, order: Sequence[str | int | Column], place: str = "place") -> DataFrame:
    """A report with each row's 1-based place in an order given as for
    ``sorted_report``. The remaining columns break ties; only rows equal in all
    columns are interchangeable. The rows are computed once, here.
    """
    number, task, before = (f"_{what}_{uuid.uuid4().hex}" for what in ("number", "task", "before"))
    settled = {o.lstrip("-") if isinstance(o, str) else df.columns[abs(o) - 1] for o in order if not isinstance(o, Column)}
    ties = [F.col(f"`{c}`").asc() for c in df.columns if c not in settled]
    keys = [*[_ordering(df, o) for o in order], *ties]
    # Ranges are found from a sample, which would compute the rows once more.
    dealt = stage(df, "unsorted").repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = stage(dealt.withColumn(number, F.monotonically_increasing_id()), "report")
    part = F.shiftright(number, PART_BITS)
    # As many rows as there were tasks.
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).orderBy("part").collect()
    ahead, total = [], 0
    for size in sizes:
        ahead.append((size["part"], total))
        total += size["rows"]
    offsets = df.sparkSession.createDataFrame(ahead, f"{task} long, {before} long")
    within = F.col(number) - F.shiftleft(part, PART_BITS) + 1
    joined = rows.join(F.broadcast(offsets), part == F.col(task))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(before) + within).alias(place))

