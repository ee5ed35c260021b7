"""Every registered query against its SQL in DuckDB."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return repr(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) == set(entry.QUERIES) | set(entry.LLM_ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, want.fetchall())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["event_date", "event_hour"] and df.count() > 0
