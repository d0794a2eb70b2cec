"""Every registered query with a SQL twin equals its DuckDB oracle (sf0.001)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW: set[str] = set()


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(E.oracle_sql()[name]).fetchdf()
    c1, r1 = _rows(got)
    c2, r2 = _rows(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_every_query_has_a_callable(spark):
    q = E.queries()
    assert len(q) >= 100
    assert set(E.oracle_sql()) <= set(q)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"batch_number", "decision", "reason_code"} <= set(df.columns)
