"""Every registered query against its DuckDB oracle at sf0.001 (the driver's check, smaller)."""

import hashlib
import os

import duckdb
import pytest
from tests.paths import SF0001

import __spark_entry__ as ENTRY

TABLES = ["orders", "lineitem", "customer", "supplier", "part", "nation", "region", "documents", "benchmark"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _digest(df):
    df = df[sorted(df.columns)].astype(object)
    df = df.where(df.notna(), None)
    # whole numbers of a column with nulls arrive as floats from one engine
    df = df.map(lambda v: int(v) if isinstance(v, float) and v.is_integer() else v)
    return hashlib.sha256("\n".join(sorted(repr(tuple(r)) for r in df.itertuples(index=False))).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ENTRY.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = ENTRY.queries()[name](spark, SF0001).toPandas()
    want = con.execute(ENTRY.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _digest(got) == _digest(want)


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"time_week", "nr_nodes", "nr_edges", "density"}


def test_every_graph_query_has_oracle():
    from txgraph.plans.catalog import ORACLE, QUERIES
    assert set(QUERIES) - set(ORACLE) == {"core_refined"}  # a local search, tested by its own properties
    assert set(QUERIES) <= set(ENTRY.queries()) and set(ORACLE) <= set(ENTRY.oracle_sql())


def test_registered_series_drops_weeks_of_the_data(spark):
    from txgraph.plans.catalog import QUERIES
    every, some = (QUERIES[q](spark, SF0001).count() for q in ("series_basic", "series_basic_excluded"))
    assert 0 < some < every


def test_significant_digits(spark):
    from txgraph.plans.catalog import rounded
    values = [1.18633e-5, 2.372657e-5, 123456789.123456789, -0.0, 1e-20, 0.1 + 0.2, 1 / 3, -2 / 3, 8192.0 ** -1, None]
    got = [r.v for r in rounded(spark.createDataFrame([(v,) for v in values], "v double")).collect()]
    want = [None if v is None else 0.0 if abs(v) < 1e-14 else float(f"{v:.8e}") for v in values]
    want[2], want[8] = 123456789.0, 1.22070313e-4
    assert got == want
