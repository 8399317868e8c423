"""Every registered query against its DuckDB oracle on the smallest tables.

At sf0.001 the drift halves have fewer than 1000 rows, so the small-sample
tests (KS, chi-square) are checked here, the large-sample ones at sf0.01 by
the driver.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records")]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_a_callable_and_oracles_are_subset():
    q = E.queries()
    assert set(E.oracle_sql()) <= set(q)
    assert len(q) >= 40


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    gc, gr = _canon(got)
    wc, wr = _canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "rows_written" in df.columns
