"""Chase list: chart counts summed under each new location id."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldkeel.functions.text import DEFAULT_RULES, TextRules
from goldkeel.operators.charts import PAIR
from goldkeel.operators.counts import (
    GRAINS,
    SESSION_GRAINS,
    chart_count_matrix,
    summed_counts_per_location,
)
from goldkeel.operators.groups import HOT_ROWS, first_per_group, join_on_unique
from goldkeel.session import stage

COUNT_COLUMNS = list(GRAINS)
BY = ("lid", "lid_provider")
SHOWN = ["NPI__c", "TIN_ID__c", "FULL_ADDRESS", "Phone_Number__c"]


class ProviderGroups(NamedTuple):
    """Providers that share their texts under the rules."""

    members: DataFrame  # Provider__c, _code, _place
    texts: DataFrame  # _code, _place and the texts shown


def provider_groups(pairs: DataFrame, rules: TextRules = DEFAULT_RULES) -> ProviderGroups:
    """The group of each provider in ``pairs``, named by two numbers instead of
    four texts: a hash code of the texts, and their place among those, as a
    rule one, that have this code. A group shows the smallest of its spellings.
    """
    keys = {"_key_" + name: rules.key(F.col(name)) for name in SHOWN}
    people = pairs.select("Provider__c", *SHOWN).distinct().withColumns(keys)
    people = people.withColumn("_code", F.xxhash64(*keys))
    order = {name: F.col(name).asc() for name in SHOWN}
    texts = first_per_group(people.drop("Provider__c"), ["_code", *keys], order, total_order=True)
    place = F.row_number().over(Window.partitionBy("_code").orderBy(*keys))
    texts = stage(texts.withColumn("_place", place), "texts")
    shared = texts.where("_place > 1").select("_code")
    # Codes that two different texts share, hardly ever any, are told apart by value.
    if shared.isEmpty():
        members = people.select("Provider__c", "_code", F.lit(1).alias("_place"))
    else:
        same = people["_code"] == texts["_code"]
        for key in keys:
            same = same & people[key].eqNullSafe(texts[key])
        members = people.join(texts, same).select(people["Provider__c"], people["_code"], texts["_place"])
    return ProviderGroups(members, texts.select("_code", "_place", *SHOWN))


def distinct_chase_map(
    location_map: DataFrame, pairs: DataFrame, rules: TextRules = DEFAULT_RULES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Each new id with the distinct providers, by their texts, that it stands
    for. Only numbers are compared until the texts are attached. The phone is
    the first one or else the second, as texts compare."""
    pairs = pairs.withColumn("Phone_Number__c", F.col("key_phone"))
    groups = provider_groups(pairs, rules)
    lids = location_map.select(F.col("NEW_LID_ALL").alias("New_lid_all"), "Location__c")
    grouped = pairs.select(*PAIR).join(groups.members, "Provider__c")
    located = join_on_unique(grouped, lids, ["Location__c"], hot_rows, key_source=pairs)
    found = located.select("New_lid_all", "_code", "_place").distinct()
    return found.join(groups.texts, ["_code", "_place"]).select("New_lid_all", *SHOWN)


def chase_list(
    location_map: DataFrame,
    pairs: DataFrame,
    client: str | None = None,
    project: str | None = None,
    by: str = "lid",
    address_mode: str | None = None,
    rules: TextRules = DEFAULT_RULES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Summed chart counts per new id, or per new id and provider keys.

    Each count of a location is added once per provider there, so sums exceed
    the number of charts as soon as providers share a key. ``location_map``
    needs ``NEW_LID_ALL``, ``Location__c`` and the location's creation date.
    For ``by='lid_provider'`` pass a staged count matrix as ``pairs``; its
    providers are grouped by ``provider_groups``.
    """
    if by not in BY:
        raise ValueError(f"by must be one of {BY}, not {by!r}")
    created = "CreatedDate" if "CreatedDate" in location_map.columns else "sfdcLidCreatedDate"
    lids = location_map.select(F.col("NEW_LID_ALL").alias("New_lid_all"), "Location__c", F.col(created).alias("_created"))
    if by == "lid":
        sums = summed_counts_per_location(pairs, COUNT_COLUMNS, address_mode or "lines", hot_rows)
        rows = lids.join(sums, "Location__c").groupBy("New_lid_all")
        result = rows.agg(F.max("_created").alias("CreatedDate"), *[F.sum(c).alias(c) for c in COUNT_COLUMNS])
        constants = [F.lit(client).alias("Client_name"), F.lit(project).alias("Project_Name")]
        return result.select(
            *([] if client is None else constants), "New_lid_all", "CreatedDate", *COUNT_COLUMNS
        )
    counted = set(SESSION_GRAINS) <= set(pairs.columns)
    matrix = pairs if counted else chart_count_matrix(pairs, SESSION_GRAINS, address_mode or "full", hot_rows)
    groups = provider_groups(pairs, rules)
    per_location = matrix.select(*PAIR, *SESSION_GRAINS).join(groups.members, "Provider__c")
    located = join_on_unique(per_location, lids.drop("_created"), ["Location__c"], hot_rows, key_source=pairs)
    sums = located.groupBy("New_lid_all", "_code", "_place").agg(*[F.sum(c).alias(c) for c in SESSION_GRAINS])
    return sums.join(groups.texts, ["_code", "_place"]).select("New_lid_all", *SHOWN, *SESSION_GRAINS)
