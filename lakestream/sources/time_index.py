"""A sparse index from time to offset: the largest record time of each bucket of offsets of a partition.

The first record at or after a time lies in the first bucket whose largest time reaches it, whatever the order of
the times. So a look-up reads the index, a row per bucket, and of the log one bucket per partition. The index is
kept as Parquet and extended by what the log has gained; its rows for one bucket are merged when it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.functions.ordered import BUCKET_WIDTH
from lakestream.schemas import schema
from lakestream.sources.bounds import beyond, within
from lakestream.sources.zones import read_or_empty

PARTITION = ("topic", "partition")
TIME_INDEX = schema(topic="string", partition="integer", bucket="long", first="long", last="long", latest="timestamp", width="long")


def time_index(log: DataFrame, width: int = BUCKET_WIDTH) -> DataFrame:
    """One row per partition and bucket of `width` offsets: its first and last offset and its largest time. Records
    without a time count as offsets only."""
    bucket = F.expr(f"offset div {int(width)}").alias("bucket")
    return log.groupBy(*PARTITION, bucket).agg(
        F.min("offset").alias("first"),
        F.max("offset").alias("last"),
        F.max("timestamp").alias("latest"),
        F.lit(width).cast("long").alias("width"),
    )


def read_time_index(spark: SparkSession, path: str) -> DataFrame:
    """The index at `path`, the rows of its extensions merged; no rows if there is none."""
    rows = read_or_empty(spark, path, TIME_INDEX)
    return rows.groupBy(*PARTITION, "bucket").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("latest").alias("latest"), F.max("width").alias("width")
    )


def extend_time_index(log: DataFrame, path: str, width: int = BUCKET_WIDTH) -> int:
    """Index what the log has gained since the last time; returns the number of rows written.

    Only offsets after the indexed ends are read. Doing it twice adds nothing: merging takes the largest. All
    extensions of an index have the same width; another one is refused.
    """
    spark = log.sparkSession
    index = read_or_empty(spark, path, TIME_INDEX)
    done = index.groupBy(*PARTITION).agg(F.max("last").alias("last"), F.max("width").alias("width")).collect()
    if any(r["width"] != width for r in done):
        raise ValueError(f"{path} has buckets of another width than {width}")
    rows = time_index(beyond(log, [(r["topic"], r["partition"], r["last"] + 1) for r in done]), width)
    before = index.count()
    rows.coalesce(1).write.mode("append").parquet(path)  # a row per bucket
    return read_or_empty(spark, path, TIME_INDEX).count() - before


def first_by_index(log: DataFrame, index: DataFrame, epoch_ms: int) -> DataFrame:
    """`sources.log.first_at` by the index: per partition `first` (null if no indexed record is that late) and `end`.

    `index` covers the log up to some offset; what came later is looked at in full.
    """
    time = F.timestamp_millis(F.lit(epoch_ms))
    known = index.groupBy(*PARTITION).agg(
        F.min(F.when(F.col("latest") >= time, F.struct("first", "last"))).alias("hit"), F.max("last").alias("last")
    )
    bounds = [(r["topic"], r["partition"], r["hit"], r["last"]) for r in known.collect()]  # a row per partition
    late = F.col("timestamp") >= time
    spans = within(log, [(topic, partition, hit["first"], hit["last"] + 1) for topic, partition, hit, _ in bounds if hit])
    rest = beyond(log, [(topic, partition, last + 1) for topic, partition, _, last in bounds])
    parts = spans.unionByName(rest).groupBy(*PARTITION).agg(
        F.min(F.when(late, F.col("offset"))).alias("first"), (F.max("offset") + 1).alias("end")
    )
    ends = known.select(*PARTITION, (F.col("last") + 1).alias("_indexed"))
    both = parts.join(ends, list(PARTITION), "full_outer")
    return both.select(*PARTITION, "first", F.greatest("end", "_indexed").alias("end"))
