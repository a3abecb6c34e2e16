"""Writing zones and publishing to the log, as batch jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakestream.functions.folders import folder_of
from lakestream.operators.log_audit import fingerprint, fingerprint_columns
from lakestream.schemas import CURATED_PARTITIONS, GOLD_PARTITIONS, RAW_PARTITIONS


class WriteMismatch(RuntimeError):
    """What was read back is not what was written."""


def gathered(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Bring the rows of one directory together so that it gets few files. AQE splits directories above
    the advisory partition size over several tasks, so a hot one is not written by a single task."""
    return df.hint("rebalance", *partitions)


def write_batch(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole result."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_raw(df: DataFrame, path: str) -> None:
    gathered(df, RAW_PARTITIONS).write.mode("overwrite").partitionBy(*RAW_PARTITIONS).json(path)


def write_curated(df: DataFrame, path: str) -> None:
    """Silver: sensor first, then event date, so that the usual filters prune directories."""
    (
        gathered(df, CURATED_PARTITIONS)
        .write.mode("overwrite")
        .partitionBy(*CURATED_PARTITIONS)
        .option("compression", "snappy")
        .parquet(path)
    )


def write_gold(df: DataFrame, path: str, sensor: str | None = None) -> None:
    """Replace gold as a whole, or one sensor's directory as a whole: what the rows no longer have, such as
    a month, is gone afterwards, and other sensors stay as they are."""
    partitions = list(GOLD_PARTITIONS)
    if sensor is not None:
        first = partitions.pop(0)
        df = df.filter(F.col(first) == sensor).drop(first)
        path = f"{path}/{folder_of(first, sensor)}"
    (
        gathered(df, partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_verified(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write, read back, and compare. Returns the number of rows.

    The input's fingerprint is observed while it is written, so the input is computed once and a source
    that grows meanwhile does not matter.
    """
    seen = Observation("written")
    write_batch(df.observe(seen, *fingerprint_columns(df)), path, partition_by)
    columns = [F.col(f"`{c}`") for c in df.columns]
    written = df.sparkSession.read.schema(df.schema).parquet(path).select(*columns)
    found = fingerprint(written).first().asDict()
    if found != seen.get:
        raise WriteMismatch(f"{path}: rows differ from the input")
    return found["records"]


# Delivery settings of the publisher.
PUBLISH_DEFAULTS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.linger.ms": "10",
    "kafka.batch.size": "32768",
    "kafka.compression.type": "gzip",
}


def publish_options(bootstrap_servers: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, **PUBLISH_DEFAULTS, **(extra or {})}


def publish(
    records: DataFrame, bootstrap_servers: str, extra: Mapping[str, str] | None = None
) -> None:
    """Send log records (`functions.payload.to_log_records`) to Kafka. A retried task may send a record
    twice: delivery is at least once."""
    options = publish_options(bootstrap_servers, extra)
    records.write.format("kafka").options(**options).save()


def append_to_file_log(records: DataFrame, path: str) -> None:
    """Append complete records, offsets included, to a log kept as Parquet files.

    Files hold ranges of offsets, so that reading from a position skips the ones before it. Ranges are cut
    by volume: a partition with a third of the records gets a third of the files.
    """
    position = ("topic", "partition", "offset")
    (
        records.withColumn("timestampType", F.lit(0))
        .repartitionByRange(*position)
        .sortWithinPartitions(*position)
        .write.mode("append")
        .parquet(path)
    )
