import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from goldkeel.operators import profile as pr
from goldkeel.operators import registry as rg
from goldkeel.sources.bindings import Bindings

SF = "/root/testdata/sf0.001"
HOT = [0, 1, 1_000_000]


@pytest.fixture(scope="module")
def b(spark):
    return Bindings(spark, SF)


@pytest.mark.parametrize("hot_rows", HOT)
def test_view_repeats_rows_of_repeated_deactivations(spark, b, hot_rows):
    listed = b.deactivation.unionByName(b.deactivation).unionByName(b.deactivation.limit(1))
    once = rg.provider_registry_view(b.provider, b.registry, b.deactivation, hot_rows=hot_rows)
    more = rg.provider_registry_view(b.provider, b.registry, listed, hot_rows=hot_rows)
    known = b.registry.select(F.col("NPI").alias("NPI__c"))
    plain = b.provider.join(known, "NPI__c").join(listed.withColumnRenamed("NPI", "NPI__c"), "NPI__c", "left")
    assert more.count() == plain.count() > once.count()
    unique = rg.provider_registry_view(b.provider, b.registry, listed, dedupe_deactivations=True, hot_rows=hot_rows)
    assert rows(unique) == rows(once)


@pytest.mark.parametrize("hot_rows", HOT)
def test_address_report_keeps_active_providers(b, hot_rows):
    got = rg.provider_vs_registry_address(b.provider, b.registry, "building|2018|mrr|0 ", hot_rows=hot_rows)
    active = pr.active_providers(b.provider, "BUILDING|2018|MRR|0")
    known = active.join(b.registry.withColumnRenamed("NPI", "NPI__c"), "NPI__c", "left_semi")
    assert rows(got.select("Full_Name__c")) == rows(known.select("Full_Name__c"))


def test_list_and_count_of_deactivated_agree(b):
    listed = rg.providers_without_entity(b.provider, b.registry)
    confirmed = listed.join(b.deactivation.withColumnRenamed("NPI", "NPI__c"), "NPI__c").count()
    assert rg.deactivated_in_project(b.provider, b.registry, b.deactivation).first()[0] == confirmed > 0
    assert rg.deactivated_in_project(b.provider, b.registry, b.deactivation, "nowhere").first()[0] == 0


def test_npi_codes_match_across_blanks(spark):
    provider = spark.createDataFrame([("1 ", "c", "p", "A")], "NPI__c string, Client_Name__c string, Project_Name__c string, Id string")
    registry = spark.createDataFrame([("1", None)], "NPI string, Entity_Type_Code string")
    assert rg.providers_without_entity(provider, registry).count() == 1


def test_repeated_npis(spark):
    day = datetime.date(2016, 1, 1)
    data = [("1", "p", day)] * 3 + [("1", "q", day), ("2", "p", day), (None, "p", day), (None, "q", day)]
    data += [("2", "q", datetime.date(2015, 1, 1))]
    df = spark.createDataFrame(data, "NPI__c string, Project_Name__c string, CreatedDate date")
    assert rows(pr.repeated_npis(df, min_rows=1)) == [("1", 4, 2), (None, 2, 2)]
    assert rows(pr.repeated_npis(df, min_rows=2, min_projects=1)) == [("1", 4, 2)]
    assert rows(pr.repeated_npis(df)) == []


def test_one_row_per_client_and_npi(spark):
    df = spark.createDataFrame([("c", "1", "b"), ("C ", "1", "a"), ("c", "2", None)], "Client_Name__c string, npi_npi string, v string")
    assert rows(rg.one_per_client_npi(df)) == [("C ", "1", "a"), ("c", "2", None)]


def test_find_npi_orders_and_filters(b):
    found = rg.find_npi(b.provider, "1000000030", "provider_id__c", ["Project_Name__c", "Client_Name__c"])
    names = [r["Project_Name__c"] for r in found.collect()]
    assert names == sorted(names) and len(names) == 2


def test_uniqueness_check(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "x int, y string")
    assert tuple(pr.uniqueness_check(df, ["x"]).first()) == (4, 3, 1)
    assert tuple(pr.uniqueness_check(df.limit(0), ["x"]).first()) == (0, 0, 0)
