"""Streaming sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestream.functions.columns import with_date_parts
from lakestream.operators.log_audit import CHUNK, batch_parts, finished_batch_stats, merged_batch_parts
from lakestream.operators.quality import split_valid
from lakestream.sinks.batch import gathered
from lakestream.schemas import DEFAULT_RULES, RAW_PARTITIONS, SensorRules

# How often the statistics stream and the lake streams run.
STATS_TRIGGER = "10 seconds"
LAKE_TRIGGER = "30 seconds"


def triggered(every: str | None) -> Mapping[str, object]:
    """`every` an interval, or once over everything there is now for None."""
    return {"processingTime": every} if every else {"availableNow": True}


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = STATS_TRIGGER,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
    name: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Append finished rows to files, each exactly once. A restart on the same checkpoint resumes after
    the last committed batch with its state and watermark. To replay, use a fresh checkpoint and a fresh
    folder: a folder ignores batches whose number it has already committed, whatever they hold."""
    writer = (
        df.writeStream.outputMode("append")
        .format(format)
        .options(**options)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**triggered(trigger))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def write_flagged(
    flagged: DataFrame, path: str, checkpoint: str, trigger: str | None = STATS_TRIGGER
) -> StreamingQuery:
    """The unaggregated readings next to the statistics, for audit and replay; its own checkpoint."""
    return write_stream(flagged, path, checkpoint, trigger)


def raw_zone_rows(log: DataFrame) -> DataFrame:
    """Keys and payloads unchanged, dated by arrival. A payload that is not UTF-8 is kept as bytes, next to
    its text with undecodable bytes replaced."""
    text = F.col("value").cast("string")
    rows = log.select(
        F.make_valid_utf8(text).alias("raw_json"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("ingestion_ts"),
        F.col("key").alias("message_key"),
        F.when(~F.is_valid_utf8(text), F.col("value")).alias("raw_bytes"),
    )
    return with_date_parts(rows, "ingestion_ts", "hour")


def write_raw_zone(
    log: DataFrame, path: str, checkpoint: str, trigger: str | None = LAKE_TRIGGER
) -> StreamingQuery:
    return write_stream(
        raw_zone_rows(log), path, checkpoint, trigger, format="json", partition_by=RAW_PARTITIONS
    )


def foreach_batch(
    df: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = STATS_TRIGGER,
    output_mode: str = "append",
) -> StreamingQuery:
    """Run a batch job per micro-batch. A batch whose commit was lost runs again under the same id, so
    `work` must write to a place named by that id."""
    return (
        df.writeStream.outputMode(output_mode)
        .foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(**triggered(trigger))
        .start()
    )


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/ingest_batch={batch_id}"


def write_batch_once(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write one micro-batch so that a repeat replaces it. The folders hold plain Parquet without a sink
    log, so the table can be compacted or rewritten by batch jobs. With `partition_by` the rows of a
    directory are brought together first, which a plain file sink cannot do."""
    rows = gathered(df, partition_by) if partition_by else df
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(batch_folder(path, batch_id))


def foreach_batch_once(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = STATS_TRIGGER,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append micro-batches idempotently."""
    return foreach_batch(
        df, lambda rows, i: write_batch_once(rows, path, i, partition_by), checkpoint, trigger
    )


def fan_out(
    df: DataFrame,
    branches: Mapping[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
    trigger: str | None = LAKE_TRIGGER,
) -> StreamingQuery:
    """Several outputs of one stream under one checkpoint: path -> transformation of the micro-batch.

    Each branch reads the micro-batch from the source again, which holds it until the batch is committed;
    nothing is kept on the executors, however large the first batch, the whole backlog, may be.
    """

    def work(rows: DataFrame, batch_id: int) -> None:
        for path, branch in branches.items():
            write_batch_once(branch(rows), path, batch_id)

    return foreach_batch(df, work, checkpoint, trigger)


def write_split(
    readings: DataFrame,
    valid_path: str,
    rejected_path: str,
    checkpoint: str,
    rules: SensorRules = DEFAULT_RULES,
    trigger: str | None = LAKE_TRIGGER,
) -> StreamingQuery:
    """Good readings to one table, the others with their reasons to a dead-letter table."""
    return fan_out(
        readings,
        {
            valid_path: lambda rows: split_valid(rows, rules)[0],
            rejected_path: lambda rows: split_valid(rows, rules)[1],
        },
        checkpoint,
        trigger,
    )


def stream_batch_stats(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    n: int = CHUNK,
    trigger: str | None = STATS_TRIGGER,
) -> StreamingQuery:
    """Chunk statistics as parts: what each micro-batch holds of a chunk. `read_batch_stats` puts a chunk that a
    batch border cuts together again."""
    return foreach_batch(
        readings, lambda rows, i: write_batch_once(batch_parts(rows, n), path, i), checkpoint, trigger
    )


def read_batch_stats(parts: DataFrame) -> DataFrame:
    """The statistics of whole chunks from what `stream_batch_stats` has written so far."""
    return finished_batch_stats(merged_batch_parts(parts))


def maintain_latest(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = STATS_TRIGGER,
    slots: int = 10,
) -> StreamingQuery:
    """Keep the newest reading per sensor. State is one row per sensor; each batch writes all of them to
    the next of a few slots, so the table stays small and a reader of the last slots is not disturbed.
    A repeated batch uses its slot again."""
    order = F.struct(
        F.coalesce(F.unix_millis("event_time"), F.lit(0)).alias("age"), "partition", "offset"
    )
    newest = (
        readings.filter(F.col("sensor").isNotNull())
        .groupBy("sensor")
        .agg(
            F.max_by(F.struct("value", "unit", "device_id", "event_time"), order).alias("reading"),
            F.max(order).alias("position"),
        )
    )

    def work(rows: DataFrame, batch_id: int) -> None:
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{path}/slot={batch_id % slots}")

    return foreach_batch(newest, work, checkpoint, trigger, "complete")


def read_latest(slots: DataFrame) -> DataFrame:
    """The current view from the slots `maintain_latest` has written: positions only grow, so the newest
    per sensor is right even while a slot is being replaced."""
    return (
        slots.groupBy("sensor")
        .agg(F.max_by("reading", "position").alias("reading"), F.max("position").alias("position"))
        .select("sensor", "reading.*", "position.partition", "position.offset")
    )
