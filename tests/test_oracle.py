"""Every registered query with SQL gives what DuckDB gives on the same files."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tidemark.queries import QUERIES

SQL = {k: v for k, v in entry_point.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, sf_dir, oracle, name):
    df = entry_point.queries()[name](spark, sf_dir)
    result = oracle.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    want = result.fetchall()
    assert len(got) == len(want)
    assert ordered(got) == ordered(want)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert sum(r["n_rows"] for r in rows) == 1500
