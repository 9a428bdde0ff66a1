"""The driver's correctness gate in small: every query of the catalog against its
DuckDB oracle (row count, column names, values) at sf0.001."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from fairstream.plans import catalog
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
ORACLES = catalog.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "as_tuple"):       # Decimal
        return round(float(v), 9)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_documented():
    rows_only = set(catalog.queries()) - set(ORACLES)
    assert set(catalog.queries()) <= set(E.queries())
    assert rows_only == {"stream_distinct_estimate"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    assert E.entry(spark).count() == 4
