"""Every registered query against its SQL, at the smallest scale, and the shape of their plans."""

from __future__ import annotations

import datetime as dt
import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from helpers import plan_of  # noqa: E402
from lakestream.checks import audit, etl, fixture, lake, streams  # noqa: E402,F401

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")

QUERIES, ORACLES = dict(fixture.QUERIES), dict(fixture.ORACLES)
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in ("events", "lineitem"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 10)
    return str(value) if isinstance(value, dt.datetime) else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    """Same rows and types as the SQL; no Python per row, and nothing paired with everything."""
    df = QUERIES[name](spark, DATA)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = sql.execute(ORACLES[name])
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    order = [[c[0] for c in result.description].index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
    assert got and got == expected


@pytest.mark.parametrize("name", ["late_rows_stream", "batch_stats_many_batches", "latest_by_device_stream"])
def test_the_parts_of_a_log_are_written_by_many_tasks(spark, monkeypatch, name):
    """A log of eight parts is fed in four batches, and no batch goes through a single task."""
    folders, path_of = [], streams.scratch_path

    def remembered(session, label):
        path = path_of(session, label)
        folders.extend([path] if label in ("cut", "quarters") else [])
        return path

    monkeypatch.setattr(streams, "scratch_path", remembered)
    monkeypatch.setattr(streams, "log", lambda *args: fixture.log(*args).repartition(8))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        QUERIES[name](spark, DATA)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(folders) == 1 and streams.list_files(spark, folders[0]).count() > 8
