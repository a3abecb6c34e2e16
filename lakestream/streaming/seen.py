"""Deduplicating a stream by ranges of offsets instead of remembered records.

Of every partition the offsets seen so far are kept as merged ranges: a log without holes is one row, one with holes a
row more for each. A micro-batch is compared with the ranges it overlaps, what is new is written, and the ranges
grow by it. Nothing has to be forgotten after a time, as with a state row per record, and a file delivered again
after a year has no second effect.

`<path>/rows/ingest_batch=<n>/` holds what a batch added, `<path>/seen/upto=<n>/` the ranges after it. A batch that is
repeated starts from the ranges before it, so it writes the same again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestream.functions.folders import COMPLETE, child_folders, delete_folder, exists
from lakestream.functions.ordered import BUCKET_WIDTH, with_bucket
from lakestream.schemas import schema
from lakestream.streaming.writers import STATS_TRIGGER, foreach_batch, write_batch_once

PARTITION = ("topic", "partition")
RANGES = schema(topic="string", partition="integer", first="long", last="long")
#: Earlier states kept beside the newest; a repeated batch needs the one before it.
KEPT_STATES = 2


def ranges_of(positions: DataFrame, width: int = BUCKET_WIDTH) -> DataFrame:
    """Offsets as ranges of consecutive ones: topic, partition, `first` and `last`. Offsets are put together inside
    buckets of `width`, so no task sees a whole partition, and buckets by their ends."""
    offsets = with_bucket(positions.select(*PARTITION, "offset").distinct(), "offset", width)
    along = W.partitionBy(*PARTITION, "_bucket").orderBy("offset")
    island = F.col("offset") - F.row_number().over(along)
    inside = offsets.withColumn("_island", island).groupBy(*PARTITION, "_bucket", "_island")
    return merged_ranges(inside.agg(F.min("offset").alias("first"), F.max("offset").alias("last")).drop("_bucket", "_island"))


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Overlapping and adjacent ranges as one; a row per hole of a partition and one more."""
    along = W.partitionBy(*PARTITION).orderBy("first", "last")
    before = F.max("last").over(along.rowsBetween(W.unboundedPreceding, -1))
    starts = ranges.withColumn("_new", F.when(F.col("first") <= before + 1, 0).otherwise(1))
    numbered = starts.withColumn("_range", F.sum("_new").over(along))
    merged = numbered.groupBy(*PARTITION, "_range").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.select(*RANGES.fieldNames())


def unseen(records: DataFrame, ranges: DataFrame, width: int = BUCKET_WIDTH) -> DataFrame:
    """One of the copies of each record whose position is in no range.

    Ranges are cut at buckets of `width`, of which only those between the first and the last offset of the records
    are made, so that a record meets the ranges of its own bucket.
    """
    once = records.dropDuplicates([*PARTITION, "offset"])
    span = records.groupBy(*PARTITION).agg(F.min("offset").alias("_low"), F.max("offset").alias("_high"))
    near = ranges.join(span, list(PARTITION)).filter("last >= _low AND first <= _high")
    low, high = F.greatest("first", "_low"), F.least("last", "_high")
    bins = F.explode(F.sequence(F.floor(low / F.lit(width)), F.floor(high / F.lit(width))))
    cut = near.select(*[F.col(c).alias(f"_{c}") for c in PARTITION], "first", "last", bins.alias("_bin"))
    here = (
        F.col("topic").eqNullSafe(F.col("_topic"))
        & (F.col("partition") == F.col("_partition"))
        & (F.col("_bucket") == F.col("_bin"))
        & F.col("offset").between(F.col("first"), F.col("last"))
    )
    return with_bucket(once, "offset", width).join(cut, here, "left_anti").drop("_bucket")


def _states(spark: SparkSession, path: str) -> list[int]:
    found = [n for n in child_folders(spark, f"{path}/seen") if n.startswith("upto=")]
    return sorted(int(n.removeprefix("upto=")) for n in found if exists(spark, f"{path}/seen/{n}/{COMPLETE}"))


def read_seen(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The ranges seen so far, or before a batch."""
    states = [n for n in _states(spark, path) if before is None or n < before]
    if not states:
        return spark.createDataFrame([], RANGES)
    return spark.read.schema(RANGES).parquet(f"{path}/seen/upto={states[-1]}")


def write_unseen(records: DataFrame, path: str, batch_id: int, width: int = BUCKET_WIDTH) -> None:
    """Write what a micro-batch adds, and the ranges after it."""
    spark = records.sparkSession
    seen = read_seen(spark, path, before=batch_id)
    write_batch_once(unseen(records, seen, width), f"{path}/rows", batch_id)
    added = spark.read.parquet(f"{path}/rows/ingest_batch={batch_id}") if not records.isEmpty() else records
    grown = merged_ranges(seen.unionByName(ranges_of(added, width)))
    grown.coalesce(1).write.mode("overwrite").parquet(f"{path}/seen/upto={batch_id}")
    for old in _states(spark, path)[: -1 - KEPT_STATES]:
        delete_folder(spark, f"{path}/seen/upto={old}")


def deduplicate_by_ranges(
    records: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = STATS_TRIGGER,
    width: int = BUCKET_WIDTH,
    also: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """A stream of log records without those delivered before. `also` is called with what each batch added."""

    def work(rows: DataFrame, batch_id: int) -> None:
        write_unseen(rows, path, batch_id, width)
        if also:
            also(rows.sparkSession.read.parquet(f"{path}/rows/ingest_batch={batch_id}"), batch_id)

    return foreach_batch(records, work, checkpoint, trigger)


def read_deduplicated(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop("ingest_batch")
