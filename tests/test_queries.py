"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

from millrace.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    return sorted(str(tuple(int(v) if isinstance(v, float) and v == int(v) else v for v in r)) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0  # their results are tested in test_further


def test_entry_imports():
    import __spark_entry__

    assert set(registry.queries()) <= set(__spark_entry__.queries())
