"""Registered queries against their DuckDB text on the smallest tables."""

import math

import duckdb
import pytest

from chainsight.llm import queries
from tests.conftest import SF001


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF001}/{table}.parquet')")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF001)
    assert sorted(got.columns) == sorted(columns)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(map(plain, r)) for r in got.select(columns).collect()), key=key) == \
        sorted((tuple(map(plain, r)) for r in want.fetchall()), key=key)


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
