"""Every query with an SQL twin, on the smallest driver tables, against DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tidewatch.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "lineitem", "events", "documents", "labels"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(res.fetchall(), dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [r.outcome for r in sorted(rows, key=lambda r: r.rank)] == ["BOTH", "IDS_ONLY", "MODEL_ONLY", "NEITHER", "TOTAL"]
    assert sum(r.n for r in rows if r.outcome != "TOTAL") == next(r.n for r in rows if r.outcome == "TOTAL")
