"""State changes as DataFrames: additive upsert, change feed, append, delete.

Plain Parquet has no MERGE or DELETE, so every change yields the next content
of a table; ``goldkeel.sources.snapshots`` stores it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldkeel.functions.text import DEFAULT_RULES, TextRules
from goldkeel.operators.chase import COUNT_COLUMNS
from goldkeel.operators.groups import unseen

# Column names of the control list.
CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("MasteredProjetsListKey", T.LongType()),
        T.StructField("masterName", T.StringType()),
        T.StructField("sourceSystem", T.StringType()),
        T.StructField("sourceProject", T.StringType()),
    ]
)
CHASE_KEY = "New_lid_all"
CHASE_COLUMNS = ["Client_name", "Project_Name", CHASE_KEY, "CreatedDate", *COUNT_COLUMNS]


class Upsert(NamedTuple):
    target: DataFrame
    changes: DataFrame


class Unmastered(NamedTuple):
    control: DataFrame
    chase_map: DataFrame
    removed_control: DataFrame
    removed_map: DataFrame


def accumulate_chase_list(target: DataFrame, source: DataFrame) -> Upsert:
    """Add the source's counts to known ids and insert the unknown ids.

    A known id keeps its client, project and creation date. The target is only
    joined, row by row, to the source, so a small source leaves it unshuffled;
    ids to insert are found from key columns alone.
    """
    added = source.select(CHASE_KEY, *[F.col(c).alias("_add_" + c) for c in COUNT_COLUMNS], F.lit(True).alias("_hit"))
    total = {
        c: F.when(F.col("_hit"), F.col(c) + F.col("_add_" + c)).otherwise(F.col(c)) for c in COUNT_COLUMNS
    }
    kept = [c for c in CHASE_COLUMNS if c not in COUNT_COLUMNS]
    updated = target.join(added, CHASE_KEY, "left").select(*kept, *[v.alias(c) for c, v in total.items()])
    inserted = unseen(source, target, CHASE_KEY).select(*CHASE_COLUMNS)

    before = [F.col(c).alias("deleted_" + c) for c in CHASE_COLUMNS]
    after = [total.get(c, F.col(c)).alias("inserted_" + c) for c in CHASE_COLUMNS]
    blank = [F.lit(None).cast(target.schema[c].dataType).alias("deleted_" + c) for c in CHASE_COLUMNS]
    new = [F.col(c).alias("inserted_" + c) for c in CHASE_COLUMNS]
    touched = target.join(added, CHASE_KEY)
    changes = touched.select(F.lit("UPDATE").alias("action"), *before, *after).unionByName(
        inserted.select(F.lit("INSERT").alias("action"), *blank, *new)
    )
    return Upsert(updated.unionByName(inserted), changes)


def append_masters(target: DataFrame, source: DataFrame) -> DataFrame:
    """Golden records whose id the target lacks, in the target's columns."""
    return unseen(source, target, CHASE_KEY).select(*target.columns)


def _control_row(row_key: Column, master: str, system: str, project: str) -> list[Column]:
    return [
        row_key.cast("bigint").alias("MasteredProjetsListKey"),
        F.lit(master).alias("masterName"),
        F.lit(system).alias("sourceSystem"),
        F.lit(project).alias("sourceProject"),
    ]


def register_project(
    control: DataFrame,
    master: str,
    system: str,
    project: str,
    junction: DataFrame | None = None,
    rules: TextRules = DEFAULT_RULES,
    last_key: int = 0,
) -> DataFrame:
    """The new control row: none if registered already, or if a given junction
    has no rows of the project; both are looked up at once. Its key follows the
    largest one in use and ``last_key``, the last one ever issued."""
    last = F.greatest(F.coalesce(F.max("MasteredProjetsListKey"), F.lit(0)), F.lit(last_key)).alias("_last")
    row = control.agg(last).select(*_control_row(F.col("_last") + 1, master, system, project))
    known = not mastered_list(control, project, system, master, rules).isEmpty()
    unlinked = junction is not None and junction_rows(junction, project, rules).isEmpty()
    return row.limit(0) if known or unlinked else row


def mastered_list(
    control: DataFrame,
    project: str,
    system: str | None = None,
    master: str | None = None,
    rules: TextRules = DEFAULT_RULES,
) -> DataFrame:
    """Control rows of a project, optionally of one source system and master."""
    rows = control.where(rules.equals(F.col("sourceProject"), project))
    if system is not None:
        rows = rows.where(rules.equals(F.col("sourceSystem"), system))
    if master is not None:
        rows = rows.where(rules.equals(F.col("masterName"), master))
    return rows


def junction_rows(junction: DataFrame, project: str, rules: TextRules = DEFAULT_RULES) -> DataFrame:
    return junction.where(rules.equals(F.col("Project_Name__c"), project))


def unmaster_project(
    control: DataFrame,
    chase_map: DataFrame,
    project: str,
    system: str,
    rules: TextRules = DEFAULT_RULES,
) -> Unmastered:
    """Split off a project: control rows by project and system whatever the
    master, map rows by project. The removed map rows are the archive."""
    listed = rules.equals(F.col("sourceProject"), project) & rules.equals(F.col("sourceSystem"), system)
    mapped = rules.equals(F.col("Project_Name"), project)

    def is_not(condition: Column) -> Column:
        return ~F.coalesce(condition, F.lit(False))

    return Unmastered(
        control.where(is_not(listed)), chase_map.where(is_not(mapped)), control.where(listed), chase_map.where(mapped)
    )
