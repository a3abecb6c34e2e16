"""The latest view as a log of changes, and deduplication by ranges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import body, records
from lakestream.functions.payload import parse_readings
from lakestream.sources.batches import layout
from lakestream.streaming import latest, seen
from lakestream.streaming.writers import write_batch_once


def changed(spark, path, number, *rows):
    """A batch of (device, value, minute)."""
    bodies = [body("s", v, f"2024-01-01T10:{m:02}:00" if m is not None else None, device_id=d) for d, v, m in rows]
    readings = parse_readings(records(spark, bodies, first=100 * number))
    write_batch_once(latest.changes_of(readings), f"{path}/changes", number)


def view(spark, path):
    return {r.key: r.value for r in latest.read_changes(spark, path).collect()}


def test_the_view_over_batches_and_levels(spark, tmp_path):
    path = str(tmp_path)
    assert view(spark, path) == {} and latest.merge_changes(spark, path) is None
    changed(spark, path, 0, ("a", 1.0, 5), ("b", 2.0, 5), ("a", 3.0, 4), (None, 9.0, 9), ("c", 4.0, None))
    assert view(spark, path) == {"a": 1.0, "b": 2.0, "c": 4.0}
    assert latest.merge_changes(spark, path) is None  # the newest batch may be repeated
    changed(spark, path, 1, ("a", 5.0, 3), ("b", 6.0, 5))  # late, and equal in time but later in the log
    changed(spark, path, 2)
    assert view(spark, path) == {"a": 1.0, "b": 6.0, "c": 4.0}
    assert latest.merge_changes(spark, path) == (0, 1)
    assert view(spark, path) == {"a": 1.0, "b": 6.0, "c": 4.0}
    changed(spark, path, 2, ("c", 7.0, 1))
    changed(spark, path, 3, ("d", 8.0, 1))
    assert latest.merge_changes(spark, path, merge_after=1) == (0, 2)
    assert len(latest.expire_changes(spark, path)) == 4
    now = layout(spark, f"{path}/changes", f"{path}/levels")
    assert (now.ranges, now.live, now.old) == (((0, 2),), (3,), ())
    assert view(spark, path) == {"a": 1.0, "b": 6.0, "c": 7.0, "d": 8.0}
    assert spark.read.parquet(f"{path}/levels/batches=0-2").count() == 3


def test_an_unfinished_level_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    for number in range(3):
        changed(spark, path, number, ("a", float(number), number))

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(latest, "mark_complete", killed)
    with pytest.raises(KeyboardInterrupt):
        latest.merge_changes(spark, path)
    monkeypatch.undo()
    assert latest.expire_changes(spark, path) == [] and view(spark, path) == {"a": 2.0}
    assert latest.merge_changes(spark, path) == (0, 1)


def at(spark, *positions):
    return spark.createDataFrame([("t", p, o) for p, o in positions], "topic string, partition int, offset long")


def test_ranges_are_merged(spark):
    rng = random.Random(5)
    held = {(p, o) for p in range(3) for o in rng.sample(range(400), 300)}
    expected, last = [], None
    for p, o in sorted(held):
        if last == (p, o - 1):
            expected[-1][2] = o
        else:
            expected.append([p, o, o])
        last = (p, o)
    for width in (1, 7, 64, 1000):
        found = seen.ranges_of(at(spark, *held, *list(held)[:50]), width).orderBy("partition", "first").collect()
        assert [[r.partition, r.first, r.last] for r in found] == expected
    one = spark.createDataFrame([("t", 0, 5, 9), ("t", 0, 0, 20), ("t", 0, 21, 22), ("t", 0, 24, 24)], seen.RANGES)
    assert [(r.first, r.last) for r in seen.merged_ranges(one).orderBy("first").collect()] == [(0, 22), (24, 24)]


def test_batches_are_compared_with_what_came_before(spark, tmp_path):
    """Repeats inside a batch and of earlier ones, holes that fill, a batch that is repeated, an empty one."""
    path, rng, everything = str(tmp_path), random.Random(6), set()
    for number in range(5):
        rows = [(p, o) for p in range(2) for o in rng.choices(range(number * 30, number * 40 + 60), k=40)] if number != 3 else []
        for _ in range(1 + (number == 2)):
            seen.write_unseen(at(spark, *rows).withColumn("v", F.lit(number)), path, number, width=16)
        everything |= set(rows)
        got = [(r.partition, r.offset) for r in seen.read_deduplicated(spark, path).collect()]
        assert sorted(got) == sorted(everything)
    ranges = seen.read_seen(spark, path).collect()
    assert sum(r.last - r.first + 1 for r in ranges) == len(everything)
    holes = sum((p, o + 1) not in everything for p, o in everything)
    assert len(ranges) == holes
    assert len(seen._states(spark, path)) == 1 + seen.KEPT_STATES
