"""Queries that SQL can express, against DuckDB."""

import os

import duckdb
import pytest

from millrace.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object).where(frame.notna(), None)
    return sorted(str(tuple(int(v) if isinstance(v, float) and v == int(v) else v for v in r)) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got, want = queries.queries()[name](spark, SF).toPandas(), duck.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
