"""Profiles of the provider table and checks on any table."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeel.functions.text import DEFAULT_RULES, TextRules
from goldkeel.operators.groups import counted
from goldkeel.operators.registry import _active, _of_project

SINCE = datetime.date(2015, 1, 1)
REPEATED = 10


def active_project_profile(provider: DataFrame, rules: TextRules = DEFAULT_RULES) -> DataFrame:
    """Active provider rows with an NPI, counted per (client, project)."""
    names = ["Client_Name__c", "Project_Name__c"]
    return counted(_active(provider, rules), names, rules.keys(names), "count_recs")


def active_providers(
    provider: DataFrame, project: str | None = None, rules: TextRules = DEFAULT_RULES
) -> DataFrame:
    """Contact list of active rows with an NPI."""
    return _active(_of_project(provider, project, None, rules), rules).select(
        "NPI__c", "Full_Name__c", "Phone_Number__c", "Provider_Full_Address_With_Suite__c", "City__c", "State__c"
    )


def repeated_npis(
    provider: DataFrame,
    since: datetime.date = SINCE,
    min_rows: int | None = None,
    min_projects: int | None = None,
    rules: TextRules = DEFAULT_RULES,
) -> DataFrame:
    """NPIs with more than ``min_rows`` rows or ``min_projects`` projects,
    created after ``since``. Rows without NPI form one group."""
    if min_rows is None and min_projects is None:
        min_rows = REPEATED
    recent = provider.where(F.col("CreatedDate") > F.lit(since))
    # Counting by hash per (NPI, project) first leaves little to fold.
    per_project = recent.groupBy("NPI__c", rules.key(F.col("Project_Name__c")).alias("_project")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    found = per_project.groupBy(rules.key(F.col("NPI__c")).alias("_npi")).agg(
        F.min("NPI__c").alias("NPI__c"),
        F.sum("_rows").alias("count_recs"),
        F.countDistinct("_project").alias("count_projects"),
    )
    if min_rows is not None:
        found = found.where(F.col("count_recs") > min_rows)
    if min_projects is not None:
        found = found.where(F.col("count_projects") > min_projects)
    return found.drop("_npi")


def npi_footprint(
    provider: DataFrame, npi: str, by: Sequence[str] = ("Project_Name__c", "Client_Name__c"),
    rules: TextRules = DEFAULT_RULES,
) -> DataFrame:
    """Rows of one NPI counted per client, or per project and client."""
    rows = provider.where(rules.equals(F.col("NPI__c"), npi))
    return counted(rows, by, rules.keys(by), "count_recs")


def uniqueness_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, and keys that occur more than once."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    return groups.agg(
        F.coalesce(F.sum("_size"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count(F.when(F.col("_size") > 1, 1)).alias("repeated_keys"),
    )
