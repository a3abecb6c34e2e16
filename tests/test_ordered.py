"""Bucketed ordering against a plain window over whole groups."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helpers import plan_of
from lakestream.functions import ordered


@pytest.fixture(scope="module")
def rows(spark):
    """Group 0 holds most rows; order values have gaps, so some buckets are empty."""
    rng = random.Random(3)
    picked = sorted(rng.sample(range(5000), 900))
    data = [(0 if rng.random() < 0.8 else rng.randrange(1, 4), at, rng.randrange(1000)) for at in picked]
    return spark.createDataFrame(data, "g int, at bigint, v int").repartition(5)


@pytest.mark.parametrize("width", [1, 7, 100, 10_000])
def test_numbers(rows, width):
    plain = rows.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy("at")) - 1)
    got = ordered.number_rows(rows, ["g"], "at", "n", width)
    key = lambda df: {(r.g, r.at): r.n for r in df.collect()}
    assert key(got) == key(plain)


@pytest.mark.parametrize("width", [1, 7, 100, 10_000])
def test_running_max(rows, width):
    before = W.partitionBy("g").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    plain = rows.withColumn("m", F.max("v").over(before))
    got = ordered.running_max_before(rows, ["g"], "at", "v", "m", width)
    key = lambda df: {(r.g, r.at): r.m for r in df.collect()}
    assert key(got) == key(plain)
    assert got.count() == rows.count()


@pytest.mark.parametrize("width", [1, 7, 10_000])
def test_running_total(rows, width):
    upto = W.partitionBy("g").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    plain = rows.withColumns({"t": F.sum("v").over(upto), "all": F.sum("v").over(W.partitionBy("g"))})
    got = ordered.running_total(rows, ["g"], "at", "v", "t", "all", width)
    key = lambda df: {(r.g, r.at): (r.t, r["all"]) for r in df.collect()}
    assert key(got) == key(plain)


def test_no_window_runs_over_a_whole_group(rows):
    """Only the summary of one row per bucket is ordered along the group."""
    plan = plan_of(ordered.number_rows(rows, ["g"], "at", "n", 100))
    assert "row_number() windowspecdefinition(g#" in plan and "_bucket#" in plan
    assert "row_number() windowspecdefinition(g#0, at" not in plan
