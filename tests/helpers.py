"""What the tests share: times, payloads, log records, plans."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from lakestream.schemas import LOG_RECORD


def utc(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def epoch_ms(text: str) -> int:
    return int(utc(text).timestamp() * 1000)


def body(sensor: str, value, at: str | None = "2024-01-01T10:00:00", **more) -> str:
    reading = {"sensor": sensor, "value": value, "unit": "C", "device_id": "d-1", **more}
    if at is not None:
        reading["timestamp"] = epoch_ms(at)
    return json.dumps(reading)


def records(
    spark: SparkSession,
    bodies: Iterable[str | bytes | tuple],
    partition: int = 0,
    first: int = 0,
    arrived: str = "2024-01-01T10:00:00",
) -> DataFrame:
    """Log records from payloads, or from (key, payload) pairs, at consecutive offsets of a partition."""
    rows = []
    for i, item in enumerate(bodies):
        key, value = item if isinstance(item, tuple) else ("k", item)
        value = value.encode() if isinstance(value, str) else value
        key = key.encode() if isinstance(key, str) else key
        rows.append((key, value, "t", partition, first + i, utc(arrived), 0))
    return spark.createDataFrame(rows, LOG_RECORD)


def plan_of(df: DataFrame) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
