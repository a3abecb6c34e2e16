"""The newest reading of each key, kept as a log of changes.

A micro-batch writes the newest reading of the keys it holds, and nothing of the others: a few rows for a few
devices, however many devices there are, and no state to keep for them. The view is the newest by time over all
that has been written. Closed batches are merged now and then into a range that holds a row per key, and ranges into
larger ones, so a reader looks at a few levels; batches and ranges are folders as in `sources.batches`, and a repeated
batch replaces itself.

`<path>/changes/ingest_batch=<n>/` holds what a batch changed, `<path>/levels/batches=<a>-<b>/` merged batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestream.functions.folders import mark_complete
from lakestream.plans.maintenance import expire_batches
from lakestream.schemas import schema
from lakestream.sources.batches import BATCH, layout, range_folder
from lakestream.streaming.writers import STATS_TRIGGER, foreach_batch, write_batch_once

CHANGES = schema(
    key="string",
    sensor="string",
    value="double",
    unit="string",
    device_id="string",
    event_time="timestamp",
    age="long",
    partition="integer",
    offset="long",
)


def newest_per_key(changes: DataFrame) -> DataFrame:
    """The newest row of each key by time, partition and offset. Every task keeps one row per key before the
    shuffle."""
    newest_first = W.partitionBy("key").orderBy(F.desc("age"), F.desc("partition"), F.desc("offset"))
    return changes.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def changes_of(readings: DataFrame, key: str = "device_id") -> DataFrame:
    """The newest reading of each key among some; readings without a key are left out, a missing time is the
    oldest."""
    rows = readings.filter(F.col(key).isNotNull()).withColumns(
        {"key": F.col(key).cast("string"), "age": F.coalesce(F.unix_millis("event_time"), F.lit(0).cast("long"))}
    )
    return newest_per_key(rows.select(*CHANGES.fieldNames()))


def maintain_changes(
    readings: DataFrame, path: str, checkpoint: str, key: str = "device_id", trigger: str | None = STATS_TRIGGER
) -> StreamingQuery:
    """Write what each micro-batch changes."""
    return foreach_batch(
        readings, lambda rows, i: write_batch_once(changes_of(rows, key), f"{path}/changes", i), checkpoint, trigger
    )


def _levels(spark: SparkSession, path: str) -> tuple[list[DataFrame], tuple[int, ...]]:
    now = layout(spark, f"{path}/changes", f"{path}/levels")
    reader = spark.read.schema(CHANGES)
    if now is None:
        return [], ()
    frames = [reader.parquet(range_folder(f"{path}/levels", *r)) for r in now.ranges]
    frames += [reader.parquet(f"{path}/changes/{BATCH}={b}") for b in now.live]
    return frames, now.live


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The view: key, reading and position; no rows if nothing has been written."""
    frames, _ = _levels(spark, path)
    if not frames:
        return spark.createDataFrame([], CHANGES).drop("age")
    return newest_per_key(reduce(DataFrame.unionByName, frames)).drop("age")


def merge_changes(spark: SparkSession, path: str, merge_after: int = 8) -> tuple[int, int] | None:
    """Merge the closed batches into a range with a row per key, and the ranges too once there are `merge_after`;
    returns the first and last batch of the new range, None if there is nothing to merge. The newest batch may be
    repeated by its stream and stays. A range counts once it is complete; what it replaces is removed by
    `expire_changes`."""
    changes, levels = f"{path}/changes", f"{path}/levels"
    now = layout(spark, changes, levels)
    closed = now.live[:-1] if now else ()
    if not closed:
        return None
    merged = now.ranges if len(now.ranges) >= merge_after else ()
    first = merged[0][0] if merged else now.covered + 1
    reader = spark.read.schema(CHANGES)
    frames = [reader.parquet(range_folder(levels, *r)) for r in merged]
    frames += [reader.parquet(f"{changes}/{BATCH}={b}") for b in closed]
    target = range_folder(levels, first, closed[-1])
    newest = newest_per_key(reduce(DataFrame.unionByName, frames))
    newest.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(target)
    mark_complete(spark, target)
    return first, closed[-1]


def expire_changes(spark: SparkSession, path: str) -> list[str]:
    """Remove the batches and ranges that merged ranges have replaced, when no reader that began before is left."""
    return expire_batches(spark, f"{path}/changes", f"{path}/levels")
