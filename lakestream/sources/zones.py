"""The zones of the lake as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestream.schemas import CURATED_ZONE, GOLD_ZONE, RAW_ZONE

ZONE_SCHEMAS = {"raw": RAW_ZONE, "curated": CURATED_ZONE, "gold": GOLD_ZONE}


def read_zone(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """A Hive-partitioned Parquet zone.

    With a schema nothing is inferred: no footer is opened before the query runs, and a column that old
    files lack reads as null. Without one, `merge_schema` unions the columns of all files.
    """
    reader = spark.read
    if schema is not None:
        return reader.schema(schema).parquet(path)
    return reader.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_stream_output(spark: SparkSession, path: str) -> DataFrame:
    """What a streaming query has committed: Spark follows the sink's own log, so files of an unfinished
    batch stay invisible."""
    return spark.read.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType, format: str = "parquet") -> DataFrame:
    """The data at `path`, or no rows if nothing has been written there yet."""
    try:
        return spark.read.schema(schema).format(format).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def zone_exists(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(path).isEmpty()
    except AnalysisException as missing:
        # a folder without data files has no schema to infer
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def register_views(spark: SparkSession, curated: str | DataFrame, gold: str | None = None) -> list[str]:
    """Make `sensor_curated`, and `sensor_daily` once gold has been built, queryable by name."""
    rows = read_or_empty(spark, curated, CURATED_ZONE) if isinstance(curated, str) else curated
    rows.createOrReplaceTempView("sensor_curated")
    views = ["sensor_curated"]
    if gold and zone_exists(spark, gold):
        read_zone(spark, gold, GOLD_ZONE).createOrReplaceTempView("sensor_daily")
        views.append("sensor_daily")
    return views


def replay_raw(spark: SparkSession, raw: str, topic: str = "") -> DataFrame:
    """The raw zone as log records again, keys and payloads byte for byte, for reprocessing with changed
    rules or a wider schema. Files from before keys were kept give null keys."""
    return read_or_empty(spark, raw, RAW_ZONE, "json").select(
        F.col("message_key").alias("key"),
        F.coalesce("raw_bytes", F.col("raw_json").cast("binary")).alias("value"),
        F.lit(topic).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ingestion_ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
