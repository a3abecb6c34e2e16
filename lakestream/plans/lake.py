"""Raw, curated and gold zones: streaming ingest, and the batch jobs that rebuild them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakestream.functions.columns import with_date_parts
from lakestream.functions.payload import parse_readings
from lakestream.operators.lake_queries import daily_stats, sensor_types
from lakestream.operators.quality import drop_malformed, flag_anomalies, in_range
from lakestream.schemas import (
    CURATED_PARTITIONS,
    CURATED_ZONE,
    DEFAULT_RULES,
    GOLD_ZONE,
    READING_V2,
    SensorRules,
)
from lakestream.sinks.batch import write_curated, write_gold
from lakestream.sources.log import EARLIEST, LogConfig, StartPosition, read_log_stream
from lakestream.sources.batches import read_curated
from lakestream.sources.zones import read_zone, replay_raw
from lakestream.streaming.supervise import run_queries
from lakestream.streaming.writers import LAKE_TRIGGER, foreach_batch_once, write_raw_zone


@dataclass(frozen=True)
class Lake:
    """Where the zones are. The sensor domain and the use case are part of the path, not columns. The folder
    names below the root are fixed values."""

    root: str
    topic: str = "sensor-events"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/source=kafka/topic={self.topic}"

    @property
    def curated(self) -> str:
        return f"{self.root}/curated/domain=iot"

    @property
    def gold(self) -> str:
        return f"{self.root}/consumption/use_case=sensor_averages"

    @property
    def compacted(self) -> str:
        return f"{self.root}/curated-compacted/domain=iot"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}-checkpoints"


def curated_readings(
    log: DataFrame, rules: SensorRules = DEFAULT_RULES, schema: StructType = READING_V2
) -> DataFrame:
    """Log records to rows of the curated zone, dated by event time. Payload fields that a wider schema
    adds become columns of the zone."""
    clean = drop_malformed(parse_readings(log, schema))
    sound = in_range(clean, rules.corrupt_below, rules.corrupt_above)
    dated = with_date_parts(flag_anomalies(sound, rules), "event_time", "day")
    renamed = dated.withColumnRenamed("sensor", "sensor_type")
    if "source" not in renamed.columns:
        renamed = renamed.withColumn("source", F.lit(None).cast("string"))
    columns = [c for c in CURATED_ZONE.fieldNames() if c not in CURATED_PARTITIONS]
    added = [c for c in schema.fieldNames() if c not in (*columns, "sensor", "timestamp")]
    return renamed.select(*columns, *added, *CURATED_PARTITIONS)


def run_lake(
    spark: SparkSession,
    cfg: LogConfig,
    lake: Lake,
    rules: SensorRules = DEFAULT_RULES,
    keep_raw: bool = True,
    trigger: str | None = LAKE_TRIGGER,
    start: StartPosition = EARLIEST,
) -> list[StreamingQuery]:
    """Feed the raw and the curated zone from one log: two queries, each with its own checkpoint, so
    that either can be replayed alone. Blocks until they end.

    Curated rows are gathered by directory and written by batch number, so a repeated batch has no second
    effect and closed batches can be compacted (`plans.maintenance.compact_batches`) while the stream runs.
    Read them with `read_lake`. A replay from a fresh checkpoint needs a fresh curated folder.
    """
    log = read_log_stream(spark, cfg, start)
    starters = [
        lambda: foreach_batch_once(
            curated_readings(log, rules),
            lake.curated,
            f"{lake.checkpoints}/curated",
            trigger,
            CURATED_PARTITIONS,
        )
    ]
    if keep_raw:
        starters.insert(
            0, lambda: write_raw_zone(log, lake.raw, f"{lake.checkpoints}/raw", trigger)
        )
    return run_queries(spark, starters)


def read_lake(spark: SparkSession, lake: Lake, schema: StructType = CURATED_ZONE) -> DataFrame:
    """The curated zone, of a stream's batches and their compacted ranges or of a batch job."""
    return read_curated(spark, lake.curated, lake.compacted, schema)


def lake_sensors(spark: SparkSession, lake: Lake, known: Sequence[str] = ()) -> DataFrame:
    """Sensors with data, from file listings alone."""
    present = [sensor_types(spark, root) for root in (lake.curated, lake.compacted)]
    found = present[0].union(present[1]).distinct()
    if known and found.isEmpty():
        return sensor_types(spark, lake.curated, known)
    return found.orderBy("sensor_type")


def build_gold(spark: SparkSession, lake: Lake, sensor: str | None = None) -> DataFrame:
    """Recompute gold from the curated zone, for all sensors or one; the others stay as they are."""
    curated = read_lake(spark, lake)
    write_gold(daily_stats(curated, sensor), lake.gold, sensor)
    return read_zone(spark, lake.gold, GOLD_ZONE)


def rebuild_curated(
    spark: SparkSession,
    lake: Lake,
    target: str,
    rules: SensorRules = DEFAULT_RULES,
    schema: StructType = READING_V2,
) -> DataFrame:
    """Reprocess everything the raw zone kept into a fresh curated zone, for changed rules or for fields
    that were not read at first.

    The target is a new folder: a streaming sink's own folder lists only files of its log, and writing
    over the folder being read would destroy it.
    """
    rows = curated_readings(replay_raw(spark, lake.raw, lake.topic), rules, schema)
    write_curated(rows, target)
    return read_zone(spark, target, rows.schema)
