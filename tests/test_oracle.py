"""Every registered query against its SQL twin in DuckDB."""

import duckdb
import pytest

from workload.oracles import oracle_sql
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in ("customer", "supplier", "orders", "lineitem"):
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def ordered(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_twin(spark, database, name):
    got = QUERIES[name](spark, SF)
    cursor = database.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert ordered(got.collect(), got.columns) == ordered(cursor.fetchall(), names)
