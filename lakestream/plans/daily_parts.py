"""Gold kept up to date batch by batch: mergeable daily figures instead of a recomputation.

Of every batch of the curated zone the count, sum, extremes and anomalies per sensor and day are stored once, under
the batch's number; gold is the merge of what there is, a row per sensor, day and batch. Extremes cannot be
subtracted, so where earlier batches are corrected, the days concerned are computed anew from the curated zone, read
by directory, and stored as a correction that stands for all batches up to one. A repeated batch or correction
replaces itself, and parts are read as soon as they are complete.

`<parts>/ingest_batch=<n>/` holds the figures of a batch, `<parts>/correction=<v>/` those of corrected days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.functions.columns import percentage, round_half_up
from lakestream.functions.folders import COMPLETE, child_folders, exists
from lakestream.operators.lake_queries import DAY_KEYS
from lakestream.plans.lake import Lake, read_lake
from lakestream.schemas import CURATED_ZONE, GOLD_ZONE, schema
from lakestream.sources.batches import BATCH, layout

CORRECTION = "correction"
DAYS = schema(sensor_type="string", year="integer", month="integer", day="integer")
PARTS = schema(
    sensor_type="string",
    year="integer",
    month="integer",
    day="integer",
    records="long",
    values="long",
    total="double",
    least="double",
    most="double",
    anomalies="long",
    upto="long",
)

SensorDay = tuple[str, dt.date]


def day_parts(curated: DataFrame, upto: int) -> DataFrame:
    """The figures of some readings per sensor and day, of batches up to one."""
    return curated.groupBy(*DAY_KEYS).agg(
        F.count(F.lit(1)).alias("records"),
        F.count("value").alias("values"),
        F.sum("value").alias("total"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.lit(upto).cast("long").alias("upto"),
    )


def merged_days(parts: DataFrame, digits: int = 3) -> DataFrame:
    """Gold from parts; a day whose readings have all been withdrawn is not in it."""
    values = F.sum("values")
    merged = parts.groupBy(*DAY_KEYS).agg(
        F.sum("records").alias("_records"),
        values.alias("record_count"),
        round_half_up(F.try_divide(F.sum("total"), values), digits).alias("avg_value"),
        round_half_up(F.min("least"), digits).alias("min_value"),
        round_half_up(F.max("most"), digits).alias("max_value"),
        F.sum("anomalies").alias("anomaly_count"),
        percentage(F.sum("anomalies"), values).alias("anomaly_pct"),
    )
    return merged.filter(F.col("_records") > 0).select(*GOLD_ZONE.fieldNames())


def _numbers(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of the complete folders `<name>=<n>`."""
    found = [n for n in child_folders(spark, root) if n.startswith(f"{name}=")]
    return sorted(int(n.removeprefix(f"{name}=")) for n in found if exists(spark, f"{root}/{n}/{COMPLETE}"))


def _write(parts: DataFrame, path: str) -> None:
    parts.coalesce(1).write.mode("overwrite").parquet(path)  # a row per sensor and day


def add_batches(spark: SparkSession, lake: Lake, parts: str) -> list[int]:
    """Store the figures of batches that have none yet, and of the newest, which its stream may have repeated, again;
    returns their numbers. Only those batches are read. To be run before batches are removed
    (`plans.maintenance.expire_batches`); where that has not been so, `correct_all`."""
    now = layout(spark, lake.curated, lake.compacted)
    there = (*now.old, *now.live) if now else ()
    known = set(_numbers(spark, parts, BATCH))
    covered = _covered(spark, parts)
    gone = [b for b in range(covered + 1, (now.covered if now else -1) + 1) if b not in known and b not in there]
    if gone:
        raise ValueError(f"batches {gone} have been removed before their figures were stored; use correct_all")
    new = [b for b in there if b > covered and (b not in known or b == there[-1])]
    for b in new:
        _write(day_parts(spark.read.schema(CURATED_ZONE).parquet(f"{lake.curated}/{BATCH}={b}"), b), f"{parts}/{BATCH}={b}")
    return new


def _covered(spark: SparkSession, parts: str) -> int:
    """The last batch that a correction of all days stands for."""
    whole = [n for n in child_folders(spark, parts) if n.startswith("whole=") and exists(spark, f"{parts}/{n}/{COMPLETE}")]
    return max((int(n.removeprefix("whole=")) for n in whole), default=-1)


def on_days(days: Iterable[SensorDay]) -> Column:
    """Readings of these sensors and days, as a condition on partition columns."""
    hits = [
        (F.col("sensor_type") == s) & (F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day)
        for s, d in sorted(set(days))
    ]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def correct_days(spark: SparkSession, lake: Lake, parts: str, days: Iterable[SensorDay]) -> int | None:
    """Compute the figures of some sensors and days anew, after their readings have been corrected or withdrawn;
    returns the number of the correction. Only the directories of those days are read; days without readings now
    get figures of none, which keep those of earlier batches out."""
    days = sorted(set(days))
    known = _numbers(spark, parts, BATCH)
    upto = max([*known, _covered(spark, parts)], default=-1)
    if not days or upto < 0:
        return None
    number = max(_numbers(spark, parts, CORRECTION), default=-1) + 1
    listed = spark.createDataFrame([(s, d.year, d.month, d.day) for s, d in days], DAYS)
    found = day_parts(_up_to(spark, lake, upto).filter(on_days(days)), upto)
    whole = listed.join(found.drop("upto"), list(DAY_KEYS), "left").na.fill(0, ["records", "values", "anomalies"])
    _write(whole.withColumn("upto", F.lit(upto).cast("long")), f"{parts}/{CORRECTION}={number}")
    return number


def _up_to(spark: SparkSession, lake: Lake, upto: int) -> DataFrame:
    """Readings of the batches up to one: later ones have figures of their own to come."""
    now = layout(spark, lake.curated, lake.compacted)
    if now is None or not any(b > upto for b in now.live):
        return read_lake(spark, lake)
    kept = [f"{lake.curated}/{BATCH}={b}" for b in now.live if b <= upto]
    frames = [spark.read.schema(CURATED_ZONE).parquet(f"{lake.compacted}/batches={a}-{b}") for a, b in now.ranges]
    if kept:
        frames.append(spark.read.schema(CURATED_ZONE).option("basePath", lake.curated).parquet(*kept).drop(BATCH))
    return reduce(DataFrame.unionByName, frames)


def correct_all(spark: SparkSession, lake: Lake, parts: str) -> int:
    """Compute all figures anew, in place of everything stored; returns the last batch they stand for."""
    now = layout(spark, lake.curated, lake.compacted)
    upto = max([now.covered, *now.live], default=-1) if now else -1
    _write(day_parts(read_lake(spark, lake), upto), f"{parts}/whole={upto}")
    return upto


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARTS).parquet(path)


def read_parts(spark: SparkSession, parts: str) -> DataFrame:
    """The parts that count: of each sensor and day the last correction, and later batches."""
    covered = _covered(spark, parts)
    stored = [_read(spark, f"{parts}/{BATCH}={b}") for b in _numbers(spark, parts, BATCH) if b > covered]
    if covered >= 0:
        stored.append(_read(spark, f"{parts}/whole={covered}"))
    batches = reduce(DataFrame.unionByName, stored) if stored else spark.createDataFrame([], PARTS)
    numbers = _numbers(spark, parts, CORRECTION)
    if not numbers:
        return batches
    fixed = [_read(spark, f"{parts}/{CORRECTION}={v}").withColumn("_number", F.lit(v)) for v in numbers]
    figures = [c for c in PARTS.fieldNames() if c not in DAY_KEYS]
    last = reduce(DataFrame.unionByName, fixed).filter(F.col("upto") > covered).groupBy(*DAY_KEYS).agg(
        F.max_by(F.struct(*figures), "_number").alias("_fixed")
    )
    later = batches.join(last, list(DAY_KEYS), "left").filter(F.col("_fixed").isNull() | (F.col("upto") > F.col("_fixed.upto")))
    return later.drop("_fixed").unionByName(last.select(*DAY_KEYS, "_fixed.*"))


def read_gold_parts(spark: SparkSession, parts: str) -> DataFrame:
    """Gold as of the batches and corrections stored so far."""
    return merged_days(read_parts(spark, parts))
