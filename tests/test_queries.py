"""Every registered query against its SQL in DuckDB, on the smallest driver tables."""

from __future__ import annotations

import datetime as dt
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from tidemark.binding import registry
from tidemark.binding.inputs import DRIVER_TABLES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="driver tables not present")

ALL = entry_points.queries()
QUERIES = {name: ALL[name] for name in registry.queries()}
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in DRIVER_TABLES:
        con.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    return value.replace(tzinfo=None) if isinstance(value, dt.datetime) else value


def table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in records)


# The only query that runs Python on executors: a reader that must follow a file's row order.
PYTHON = {"a2_read_csv_after_preamble"}


def check_plan(name, plan):
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name not in PYTHON:
        assert not re.search("EvalPython|MapInPandas|MapInArrow|FlatMapGroups", plan)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    check_plan(name, df._jdf.queryExecution().executedPlan().toString())
    got = table(df.columns, df.collect())
    cursor = duck.execute(ORACLES[name])
    assert got == table([d[0] for d in cursor.description], cursor.fetchall())


def test_every_query_has_sql_and_reads_driver_tables():
    assert set(QUERIES) == set(ORACLES)
    pattern = re.compile(r"\b(?:from|join)\s+(?:" + "|".join(DRIVER_TABLES) + r")\b")
    assert [n for n, sql in ORACLES.items() if not pattern.search(sql)] == []


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["connection_year", "connection_month"]


def test_loads_with_rejects_match_sql_over_many_files(spark, duck):
    """The tables come in many splits, so the export is written as many files."""
    name, sizes = "c3_load_with_rejects", ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(s) for s in sizes]
    try:
        for size in sizes:
            spark.conf.set(size, "4k")
        df = QUERIES[name](spark, DATA)
        got = table(df.columns, df.collect())
    finally:
        for size, value in zip(sizes, before, strict=True):
            spark.conf.set(size, value)
    cursor = duck.execute(ORACLES[name])
    assert got == table([d[0] for d in cursor.description], cursor.fetchall())
