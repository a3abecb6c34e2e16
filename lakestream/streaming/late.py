"""Rows that a watermark would drop, kept in a table of their own.

Spark drops a row whose window its watermark has closed and counts it; here the same watermark, the largest event time
of all earlier micro-batches less the tolerated lateness, is stored by batch number and decides which table a row
goes to. A batch that is repeated reads the watermark before it, so it decides alike.

`<path>/on_time` and `<path>/late` hold batches as `sources.batches` names them, `<path>/watermarks/upto=<n>/` the
largest time after a batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestream.functions.folders import COMPLETE, child_folders, exists
from lakestream.streaming.writers import STATS_TRIGGER, foreach_batch, write_batch_once

SEEN = "latest timestamp"


def seen_before(spark: SparkSession, path: str, batch_id: int) -> dt.datetime | None:
    """The largest event time of the batches before one."""
    names = [n for n in child_folders(spark, f"{path}/watermarks") if exists(spark, f"{path}/watermarks/{n}/{COMPLETE}")]
    numbers = [int(n.removeprefix("upto=")) for n in names if n.startswith("upto=")]
    earlier = [n for n in numbers if n < batch_id]
    if not earlier:
        return None
    return spark.read.schema(SEEN).parquet(f"{path}/watermarks/upto={max(earlier)}").first()["latest"]


def split_late(
    rows: DataFrame, seen: dt.datetime | None, window: str, lateness: str, event_time: str = "event_time"
) -> tuple[DataFrame, DataFrame]:
    """Rows on time and late ones, which get the `watermark` that closed their window. Rows without a time are on
    time: no window waits for them."""
    if seen is None:
        return rows, rows.filter(F.lit(False)).withColumn("watermark", F.lit(None).cast("timestamp"))
    watermark = F.lit(seen) - F.expr(f"INTERVAL {lateness}")
    late = F.coalesce(F.window(F.col(event_time), window)["end"] <= watermark, F.lit(False))
    # the window expression leaves out rows without a time, so they are told apart first
    timed = rows.filter(F.col(event_time).isNotNull())
    untimed = rows.filter(F.col(event_time).isNull())
    marked = timed.withColumn("_late", late)
    on_time = marked.filter(~F.col("_late")).drop("_late").unionByName(untimed)
    return on_time, marked.filter("_late").drop("_late").withColumn("watermark", watermark)


def keep_late(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "5 minutes",
    lateness: str = "2 minutes",
    event_time: str = "event_time",
    trigger: str | None = STATS_TRIGGER,
) -> StreamingQuery:
    """Write rows on time and late rows to two tables."""

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = seen_before(spark, path, batch_id)
        on_time, late = split_late(batch, before, window, lateness, event_time)
        write_batch_once(on_time, f"{path}/on_time", batch_id)
        write_batch_once(late, f"{path}/late", batch_id)
        latest = batch.agg(F.max(event_time).alias("latest")).select(F.greatest("latest", F.lit(before)).alias("latest"))
        latest.write.mode("overwrite").parquet(f"{path}/watermarks/upto={batch_id}")

    return foreach_batch(rows, work, checkpoint, trigger)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Late rows with the batch they came in and the watermark that closed their window."""
    return spark.read.parquet(f"{path}/late")


def read_on_time(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/on_time").drop("ingest_batch")
