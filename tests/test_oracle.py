"""Every query against the same query in SQL, on DuckDB."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = ["events", "lineitem", "documents", "pages"]
QUERIES = entry.queries()
SQL = entry.oracle_sql()


def as_key(v) -> str:
    if v is None or v != v:
        return ""
    return f"{v:020.6f}" if isinstance(v, (int, float, np.number)) else str(v)


def settled(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name and rows in a fixed order."""
    df = df[sorted(df.columns)]
    keys = pd.concat([df[c].map(as_key) for c in df], axis=1).apply(tuple, axis=1)
    return df.loc[keys.sort_values(kind="stable").index].reset_index(drop=True)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got, want = df.toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    got, want = settled(got), settled(want)
    for c in got:
        assert got[c].isna().tolist() == want[c].isna().tolist(), c
        a, b = got[c][got[c].notna()], want[c][want[c].notna()]
        assert a.tolist() == b.tolist(), c


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
