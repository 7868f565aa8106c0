"""Queries of the corpus operators against their SQL twins in DuckDB."""

import duckdb
import pytest

from goldkeel.llm.oracles import ORACLES
from goldkeel.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_twin(spark, name):
    database = duckdb.connect()
    for table in ("pages", "embeddings", "documents"):
        database.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    cursor = database.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))
