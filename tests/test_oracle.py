"""Every query with a DuckDB twin matches it (rows, columns, values) at sf0.001."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels".split()
SQL = entry.oracle_sql()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, pd.Timestamp):
        return str(v.to_pydatetime())
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def _rows(df):
    cols = sorted(df.columns)
    return sorted("|".join(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_registered_has_callable():
    qs = entry.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 75


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    sp = entry.queries()[name](spark, SF_SMALL).toPandas()
    dk = con.execute(SQL[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert _rows(sp) == _rows(dk)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) == {"company", "n_users", "churn_pct"}
