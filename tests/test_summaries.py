"""Sketches, bitmaps, schema drift, clustering, and what a stream leaves behind."""

from __future__ import annotations

import datetime as dt
import json
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import utc
from lakestream.functions import zorder
from lakestream.operators import drift, sketches
from lakestream.plans import maintenance
from lakestream.streaming import late, supervise

# --- bitmaps ---------------------------------------------------------------------------------------


def slow_ranges(numbers):
    out, ordered = [], sorted(set(numbers))
    for a, b in zip(ordered, ordered[1:]):
        if b > a + 1:
            out.append((a + 1, b - 1, b - a - 1))
    return out


def test_missing_ranges_of_bitmaps(spark):
    """Holes inside bytes, over bytes, over buckets, whole buckets, none, in two groups, from days merged."""
    rng = random.Random(2)
    n = sketches.BITMAP_NUMBERS
    groups = {
        "a": [x for x in range(1, 3 * n) if not (100 < x < 140 or n - 5 < x < n + 70 or x == 7) and rng.random() < 0.999],
        "b": [5, 6, 7, 8, 9, 4 * n + 3, 4 * n + 4, n, n + 1],
        "c": list(range(1, 50)),
        "d": [1],
    }
    rows = [(g, x, x % 3) for g, numbers in groups.items() for x in numbers]
    table = spark.createDataFrame(rows + rows[:50] + [("a", 0, 0), ("a", None, 0)], "g string, seq long, day int")
    daily = sketches.presence_bitmaps(table, ["day", "g"])
    found = sketches.missing_ranges(sketches.merged_bitmaps(daily, ["g"]), ["g"]).collect()
    for g, numbers in groups.items():
        assert sorted((r.first, r.last, r.missing) for r in found if r.g == g) == slow_ranges(numbers)
    whole = sketches.merged_bitmaps(daily)
    every = sorted((r.first, r.last, r.missing) for r in sketches.missing_ranges(whole).collect())
    assert every == slow_ranges([x for numbers in groups.values() for x in numbers])


# --- sketches --------------------------------------------------------------------------------------


def test_merged_sketches_are_near_the_exact_quantiles(spark):
    rng = random.Random(3)
    start = utc("2024-01-01T00:00:00")
    rows = []
    for i in range(20_000):
        at = start + dt.timedelta(seconds=i * 4)
        rows.append((at, at + dt.timedelta(milliseconds=int(rng.paretovariate(1.2) * 1000))))
    table = spark.createDataFrame(rows + [(None, start)], "event_time timestamp, kafka_timestamp timestamp")
    hours = sketches.delay_sketches(table)
    day = sketches.merged_sketches(hours, [F.to_date("arrival_hour").alias("day")])
    got = sketches.sketch_quantiles(day, (0.1, 0.5, 0.9, 0.99)).collect()
    assert sum(r.readings for r in got) == 20_000
    first = [int((b - a).total_seconds() * 1000) for a, b in rows if b.date() == start.date()]
    row = next(r for r in got if r.day == start.date())
    for name, share in (("p10_ms", 0.1), ("p50_ms", 0.5), ("p90_ms", 0.9), ("p99_ms", 0.99)):
        rank = sum(d <= row[name] for d in first) / len(first)
        assert abs(rank - share) < 0.02


# --- drift -----------------------------------------------------------------------------------------


def test_drift_of_payloads(spark):
    bodies = [
        (1, '{"sensor":"a","value":1.5,"unit":"C","timestamp":1,"device_id":"d"}'),
        (1, '{"sensor":"a","value":2,"unit":null,"timestamp":1.5,"device_id":"d","firm\'ware.x":{"y":1}}'),
        (1, "not json"),
        (1, "[1]"),
        (2, '{"sensor":"a","value":"7","unit":"C","timestamp":1,"device_id":true,"tags":[1]}'),
        (2, '{"sensor":"a","value":1e300,"unit":"C","device_id":"d"} x'),
        (3, "7"),
        (None, '{}'),
    ]
    table = spark.createDataFrame(bodies, "day int, raw_json string")
    got = {(r.day, r.field, r.drift, r.found, r.payloads) for r in drift.schema_drift(table, ["day"]).collect()}
    assert got == {
        (1, "firm'ware.x", "added", "object", 1),
        (1, "timestamp", "retyped", "number", 1),
        (2, "value", "retyped", "text", 1),
        (2, "device_id", "retyped", "boolean", 1),
        (2, "tags", "added", "list", 1),
    }
    none = drift.schema_drift(table.limit(0), ["day"])
    assert none.isEmpty() and none.columns == ["day", "field", "drift", "found", "payloads"]


# --- clustering ------------------------------------------------------------------------------------


def row_groups(folder, keep):
    """Row groups whose statistics do not rule a condition out, and all."""
    hit = total = 0
    for part in folder.rglob("*.parquet"):
        meta = pq.ParquetFile(part).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            spans = {n: meta.row_group(g).column(i).statistics for i, n in enumerate(names)}
            total += 1
            hit += all(spans[n].min <= high and spans[n].max >= low for n, (low, high) in keep.items())
    return hit, total


def test_clustering_serves_filters_on_both_columns(spark, tmp_path):
    """One device in one hour: at most half the row groups that rows sorted by device or by time have open."""
    rng = random.Random(4)
    devices = [f"d{i:03}" for i in range(64)]
    rows = [("k", rng.choice(devices), i, rng.random()) for i in range(60_000)]
    spark.createDataFrame(rows, "k string, device string, at long, v double").write.partitionBy("k").parquet(str(tmp_path / "s"))
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "16384")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size.row.check.min", "100")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.page.size.row.check.min", "100")
    try:
        for name, settings in {
            "time": {"sort_by": ["at"]},
            "device": {"sort_by": ["device", "at"]},
            "both": {"cluster_by": ["device", "at"]},
        }.items():
            maintenance.compact(spark, str(tmp_path / "s"), str(tmp_path / name), ["k"], **settings)
            assert maintenance.verify_compaction(spark, str(tmp_path / "s"), str(tmp_path / name)) == 60_000
    finally:
        for key in ("parquet.block.size", "parquet.block.size.row.check.min", "parquet.page.size.row.check.min"):
            spark.sparkContext._jsc.hadoopConfiguration().unset(key)
    opened = {}
    for name in ("time", "device", "both"):
        by_time = by_device = total = 0
        for i in range(0, 60_000, 6000):
            hit, total = row_groups(tmp_path / name, {"at": (i, i + 2400)})
            by_time += hit
        for device in devices[::7]:
            by_device += row_groups(tmp_path / name, {"device": (device, device)})[0]
        opened[name] = (by_time, by_device, total)
    assert opened["both"][2] >= 20
    assert opened["both"][0] <= opened["device"][0] / 2  # hours, against rows sorted by device
    assert opened["both"][1] <= opened["time"][1] / 2  # devices, against rows sorted by time


def test_ranks_and_interleaving(spark):
    table = spark.createDataFrame([(None, 5), (1, 0), (3, 9), (4, 2), (9, 2)], "a int, b int")
    ranked, names = zorder.with_ranks(table, {"a": [2, 3, 8], "b": []})
    assert [tuple(r[n] for n in names) for r in ranked.orderBy(F.asc_nulls_first("a")).collect()] == [(0, 0), (0, 0), (2, 0), (2, 0), (3, 0)]
    for x, y in ((0, 0), (63, 0), (0, 63), (37, 21), (63, 63)):
        bits = "".join(f"{x:06b}"[i] + f"{y:06b}"[i] for i in range(6))
        got = spark.range(1).select(zorder.interleaved([F.lit(x), F.lit(y)]).alias("z")).first().z
        assert got == int(bits, 2)
    bounds = zorder.quantile_bounds(spark.range(6400).withColumn("n", F.lit(None).cast("int")), ["id", "n"], F.col("id"))
    assert bounds["n"] == [] and bounds["id"] == [100 * k for k in range(1, 64)]


# --- what a stream leaves --------------------------------------------------------------------------


def test_late_rows_of_batches(spark, tmp_path):
    """Decided by the batches before; a repeated batch decides alike; rows without a time are on time."""
    path = str(tmp_path)

    def work(number, *minutes):
        rows = [(number, utc("2024-01-01T10:00:00") + dt.timedelta(minutes=m) if m is not None else None) for m in minutes]
        table = spark.createDataFrame(rows, "b int, event_time timestamp")
        before = late.seen_before(spark, path, number)
        on_time, behind = late.split_late(table, before, "5 minutes", "2 minutes")
        latest = table.agg(F.max("event_time").alias("latest")).select(F.greatest("latest", F.lit(before)).alias("latest"))
        latest.write.mode("overwrite").parquet(f"{path}/watermarks/upto={number}")
        minute = lambda rows: sorted(-1 if r.event_time is None else r.event_time.minute for r in rows.collect())
        return minute(on_time), minute(behind)

    assert work(0, 1, 12, None) == ([-1, 1, 12], [])
    for _ in range(2):
        assert work(1, 3, 4, 5, 8, 9, 20) == ([20], [3, 4, 5, 8, 9])
    assert work(2) == ([], [])
    assert work(3, 12, 17, 18) == ([17, 18], [12])


def checkpoint(folder, *batches, committed):
    (folder / "offsets").mkdir(parents=True)
    (folder / "commits").mkdir()
    for number, sources in enumerate(batches):
        lines = ["v1", json.dumps({"batchWatermarkMs": 0}), *map(json.dumps, sources)]
        (folder / "offsets" / str(number)).write_text("\n".join(lines))
        if number < committed:
            (folder / "commits" / str(number)).write_text('v1\n{"nextBatchWatermarkMs":0}')


@pytest.mark.parametrize("committed", [0, 1, 2, 11])
def test_offsets_of_a_checkpoint(spark, tmp_path, committed):
    """The last committed batch counts, numbers order as numbers, sources that are files have no offsets."""
    batches = [[{"t": {"0": 10 * i, "1": i}}, {"logOffset": i}, {"u": {"0": 5}}] for i in range(1, 12)]
    checkpoint(tmp_path / "c", *batches, committed=committed)
    got = {(r.topic, r.partition, r.committed) for r in supervise.committed_offsets(spark, str(tmp_path / "c")).collect()}
    assert got == ({("t", 0, 10 * committed), ("t", 1, committed), ("u", 0, 5)} if committed else set())
    assert supervise.committed_offsets(spark, str(tmp_path / "none")).isEmpty()

