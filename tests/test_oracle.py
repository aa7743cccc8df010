"""Every registered query against its DuckDB twin on sf0.001 (the driver runs
the same comparison on sf0.01): same columns, same multiset of rows."""

import math

import duckdb
import pytest

import __spark_entry__
from chainsight.plans import catalog as E

from .conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SLOW = {"fitted_predictions", "fitted_importance", "model_metrics"}  # GBT fits: covered by test_ml


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if type(v).__name__ == "Decimal":
        return str(v)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_sql_or_is_listed():
    qs, sqls = E.queries(), E.oracle_sql()
    no_sql = set(qs) - set(sqls)
    assert no_sql == SLOW
    assert set(sqls) <= set(qs)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    cur = duck.execute(E.oracle_sql()[name])
    orows, ocols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(scols) == sorted(ocols)
    assert canon(srows, scols) == canon(orows, ocols)


def test_entry_smoke(spark):
    df = __spark_entry__.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and df.columns[0] == "market"
