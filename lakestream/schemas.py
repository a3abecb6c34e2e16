"""Fixed schemas of the log, its payloads and the lake, and the per-sensor rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def schema(**columns: str) -> T.StructType:
    """Nullable columns by name and type. Unlike a DDL string this needs no running session."""
    built = T.StructType()
    for name, kind in columns.items():
        built.add(name, kind)
    return built


# The columns of Spark's Kafka source.
LOG_RECORD = schema(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
    timestampType="integer",
)

# JSON payloads. from_json returns every field nullable, so "required" is a filter, not a schema flag.
READING_V1 = schema(
    sensor="string",
    value="double",
    unit="string",
    timestamp="long",
    device_id="string",
)
READING_V2 = schema(
    sensor="string",
    value="double",
    unit="string",
    timestamp="long",
    device_id="string",
    source="string",
)
USER_EVENT = schema(
    event="string",
    user_id="string",
    ts="string",
    session_id="string",
    item="string",
    amount="double",
)
SEQUENCE_MESSAGE = schema(
    phase="string",
    seq="long",
    ts="string",
)

# Binary columns are base64 in the zone's JSON files. Files written before the last two existed read as null.
RAW_ZONE = schema(
    raw_json="string",
    kafka_partition="integer",
    kafka_offset="long",
    ingestion_ts="timestamp",
    message_key="binary",
    raw_bytes="binary",
    year="integer",
    month="integer",
    day="integer",
    hour="integer",
)
RAW_PARTITIONS = ("year", "month", "day", "hour")

CURATED_ZONE = schema(
    value="double",
    unit="string",
    device_id="string",
    source="string",
    event_time="timestamp",
    partition="integer",
    offset="long",
    is_anomaly="boolean",
    sensor_type="string",
    year="integer",
    month="integer",
    day="integer",
)
CURATED_PARTITIONS = ("sensor_type", "year", "month", "day")

GOLD_ZONE = schema(
    day="integer",
    record_count="long",
    avg_value="double",
    min_value="double",
    max_value="double",
    anomaly_count="long",
    anomaly_pct="double",
    sensor_type="string",
    year="integer",
    month="integer",
)
GOLD_PARTITIONS = ("sensor_type", "year", "month")

COMMITTED = schema(
    topic="string",
    partition="integer",
    committed="long",
)


@dataclass(frozen=True)
class SensorRule:
    """What is known about one sensor. A reading strictly above `anomaly_above` is an anomaly;
    None means never. The physical range is inclusive."""

    sensor: str
    unit: str = ""
    anomaly_above: float | None = None
    physical_low: float | None = None
    physical_high: float | None = None


@dataclass(frozen=True)
class SensorRules:
    """All sensors of a domain, plus the inclusive range outside which a value counts as corrupt."""

    rules: tuple[SensorRule, ...]
    corrupt_below: float = -100.0
    corrupt_above: float = 2000.0

    FRAME = schema(
        sensor="string",
        unit="string",
        anomaly_above="double",
        physical_low="double",
        physical_high="double",
    )

    @property
    def sensors(self) -> list[str]:
        return sorted(r.sensor for r in self.rules)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (r.sensor, r.unit, r.anomaly_above, r.physical_low, r.physical_high) for r in self.rules
        ]
        return spark.createDataFrame(rows, self.FRAME)


# The sensors, units, thresholds and physical ranges of the default domain.
DEFAULT_RULES = SensorRules(
    (
        SensorRule("temperature", "C", 35.0, -50.0, 80.0),
        SensorRule("humidity", "%", 90.0, 0.0, 100.0),
        SensorRule("pressure", "hPa", None, 800.0, 1200.0),
    )
)
