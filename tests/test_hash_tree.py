"""Comparison by a tree of fingerprints."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from lakestream.operators import hash_tree
from lakestream.operators.log_audit import multiset_diff

KEYS = ("k", "d")


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("k"), F.col("id") % 4)).alias("k"),
        (F.col("id") % 7).cast("int").alias("d"),
        F.col("id").alias("v"),
        F.when(F.col("id") % 3 > 0, F.col("id") / 8).alias("w"),
        F.array(F.col("id"), F.lit(None)).alias("a"),
    )
    return rows


DAMAGE = {
    "lost": lambda t: t.filter("v % 1000 <> 17"),
    "twice": lambda t: t.union(t.filter("v = 5")),
    "changed": lambda t: t.withColumn("w", F.when(F.col("v") == 100, 1.0).otherwise(F.col("w"))),
    "null for a value": lambda t: t.withColumn("w", F.when(F.col("v") != 100, F.col("w"))),
    "another directory": lambda t: t.withColumn("k", F.when(F.col("v") == 100, "new").otherwise(F.col("k"))),
    "null directory": lambda t: t.filter("k IS NOT NULL OR v > 8"),
    "all": lambda t: t.withColumn("w", F.lit(0.5)),
    "nothing": lambda t: t.repartition(3),
    "empty": lambda t: t.limit(0),
}


@pytest.mark.parametrize("name", DAMAGE)
@pytest.mark.parametrize("listed", [200, 0])
def test_the_same_as_comparing_all_rows(table, monkeypatch, name, listed):
    monkeypatch.setattr(hash_tree, "LISTED", listed)
    copy = DAMAGE[name](table)
    expected = sorted(map(str, multiset_diff(table, copy).collect()))
    found = hash_tree.hash_tree_diff(table, copy.select("a", "v", "d", "k", "w"), KEYS, buckets=8)
    assert found.columns == [*table.columns, "surplus"]
    assert sorted(map(str, found.collect())) == expected
    assert bool(expected) == (name != "nothing")


def test_equal_tables_shuffle_no_rows(spark, table, tmp_path, monkeypatch):
    """Only one aggregate runs, with a map-side part, and there is nothing to do after it."""
    path = str(tmp_path / "t")
    table.write.partitionBy(*KEYS).parquet(path)
    zone = spark.read.parquet(path)
    plans = []
    branches = hash_tree.differing_branches
    monkeypatch.setattr(hash_tree, "differing_branches", lambda *x: plans.append(plan_of(branches(*x))) or branches(*x))
    found = hash_tree.hash_tree_diff(zone, zone, KEYS)
    assert len(plans) == 1 and plans[0].count("Exchange") == 1 and plans[0].count("HashAggregate") == 2
    assert found.isEmpty() and "Exchange" not in plan_of(found)


def test_one_damaged_directory_is_all_that_is_read_again(spark, table, tmp_path):
    path = str(tmp_path / "t")
    table.write.partitionBy(*KEYS).parquet(path)
    zone = spark.read.parquet(path)
    found = hash_tree.hash_tree_diff(zone, zone.filter("v <> 1002"), KEYS)
    plan = plan_of(found)
    assert "PartitionFilters: [isnotnull(k" in plan or "PartitionFilters: [" in plan and "k2" in plan
    assert [(r.v, r.surplus) for r in found.collect()] == [(1002, 1)]
