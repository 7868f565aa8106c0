"""Master one project end to end, or undo it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldkeel.functions.text import DEFAULT_RULES, TextRules
from goldkeel.operators.charts import (
    MAX_BROADCAST_LINKS,
    pair_counts,
    provider_locations,
    retrieval_summary,
    select_projects,
)
from goldkeel.operators.chase import COUNT_COLUMNS, chase_list
from goldkeel.operators.groups import HOT_ROWS
from goldkeel.operators.locations import location_candidates, location_master, merge_report
from goldkeel.operators.state import (
    CONTROL_SCHEMA,
    accumulate_chase_list,
    append_masters,
    junction_rows,
    mastered_list,
    register_project,
    unmaster_project,
)
from goldkeel.sources.snapshots import StateStore

CONTROL, MAP, BACKUP, MASTERS = "control_list", "chase_map", "chase_map_backup", "location_master"
ACTIONS = ("ADD", "DELETE")

MASTERED = "mastered"
ALREADY_MASTERED = "already mastered"
DELETED = "deleted"
NOT_MASTERED = "not mastered yet"


@dataclass(frozen=True)
class Inputs:
    provider: DataFrame
    junction: DataFrame
    charts: DataFrame
    location: DataFrame


@dataclass(frozen=True)
class Result:
    status: str
    version: int
    reports: dict[str, DataFrame] = field(default_factory=dict)


def map_schema(location: DataFrame) -> T.StructType:
    text = [T.StructField(c, T.StringType()) for c in ("Client_name", "Project_Name", "New_lid_all")]
    created = T.StructField("CreatedDate", location.schema["CreatedDate"].dataType)
    return T.StructType([*text, created, *[T.StructField(c, T.LongType()) for c in COUNT_COLUMNS]])


def _source_system(provider: DataFrame, project: str, rules: TextRules) -> tuple[str, str]:
    """The one client of a project, and the project's name as stored."""
    found = select_projects(provider, project, rules=rules).limit(2).collect()
    if not found:
        raise ValueError(f"unknown project {project!r}")
    if len(found) > 1:
        raise ValueError(f"project {project!r} belongs to more than one client")
    return found[0]["Client_Name__c"], found[0]["Project_Name__c"]


def master_project(
    spark: SparkSession,
    mastering_type: str,
    action: str,
    project: str,
    inputs: Inputs,
    store: StateStore,
    strict_reference: bool = False,
    rules: TextRules = DEFAULT_RULES,
    hot_rows: int = HOT_ROWS,
) -> Result:
    """ADD or DELETE a project.

    ``strict_reference`` lets DELETE remove rows even of a combination that was
    never mastered; without it such a call changes nothing.
    """
    if not (mastering_type or "").rstrip():
        raise ValueError("the mastering type cannot be blank")
    action = (action or "").strip()
    action = action if rules.case_sensitive else action.upper()
    if action not in ACTIONS:
        raise ValueError("the action must be ADD or DELETE")
    if not (project or "").rstrip():
        raise ValueError("the project name cannot be blank")
    system, project = _source_system(inputs.provider, project, rules)
    base = store.version()
    control = store.read(CONTROL, CONTROL_SCHEMA)
    chase_map = store.read(MAP, map_schema(inputs.location))

    if action == "DELETE":
        known = not mastered_list(control, project, system, mastering_type, rules).isEmpty()
        if not known and not strict_reference:
            return Result(NOT_MASTERED, base)
        left = unmaster_project(control, chase_map, project, system, rules)
        append = {BACKUP: store.write_segment(left.removed_map, BACKUP)} if known else {}
        replace = {
            CONTROL: store.write_segment(left.control, CONTROL),
            MAP: store.write_segment(left.chase_map, MAP),
        }
        version = store.commit(base, append, replace)
        reports = {"removed_control": left.removed_control, "removed_map": left.removed_map}
        return Result(DELETED if known else NOT_MASTERED, version, reports)

    if not mastered_list(control, project, rules=rules).isEmpty():
        return Result(ALREADY_MASTERED, base)
    return _add(mastering_type, system, project, inputs, store, base, control, chase_map, rules, hot_rows)


def _add(
    mastering_type: str,
    system: str,
    project: str,
    inputs: Inputs,
    store: StateStore,
    base: int,
    control: DataFrame,
    chase_map: DataFrame,
    rules: TextRules,
    hot_rows: int,
) -> Result:
    projects = select_projects(inputs.provider, project, system, rules=rules)
    # The selection itself has one row; the project's bounds reach the junction scan.
    linked = junction_rows(inputs.junction, project, rules)
    links = store.stage(provider_locations(projects, linked, rules), "links", linked.count())
    counts = pair_counts(
        links, inputs.charts, inputs.provider, rules=rules, max_broadcast_links=MAX_BROADCAST_LINKS
    )
    pairs = store.stage(counts, "pairs", links.count())
    candidates = store.stage(location_candidates(inputs.location, retrieval_summary(pairs)), "candidates")
    chase = store.stage(chase_list(candidates, pairs, system, project, rules=rules, hot_rows=hot_rows), "chase")

    golden = location_master(candidates)
    masters = store.read(MASTERS, golden.schema)
    upsert = accumulate_chase_list(chase_map, chase)
    last_key = store.last_key(CONTROL)
    row = store.stage(
        register_project(control, mastering_type, system, project, inputs.junction, rules, last_key), "control"
    )
    issued = row.agg(F.max("MasteredProjetsListKey")).first()[0] or last_key

    replace = {MAP: store.write_segment(upsert.target, MAP)}
    append = {
        MASTERS: store.write_segment(append_masters(masters, golden), MASTERS),
        CONTROL: store.write_segment(row, CONTROL),
    }
    version = store.commit(base, append, replace, {CONTROL: issued})
    listed = mastered_list(store.read(CONTROL, CONTROL_SCHEMA), project, system, mastering_type, rules)
    reports = {
        "control": listed,
        # From stages and segments that later versions leave as they are.
        "changes": upsert.changes,
        "merge_report": merge_report(candidates, hot_rows),
        "location_master": golden,
        "chase_list": chase,
    }
    return Result(MASTERED, version, reports)

