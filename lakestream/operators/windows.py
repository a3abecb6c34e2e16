"""Tumbling event-time windows, on batch and streaming input alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.functions.columns import percentage, round_half_up

# Window length and tolerated lateness.
WINDOW = "5 minutes"
LATENESS = "2 minutes"


def window_stats(
    flagged: DataFrame, length: str = WINDOW, watermark: str | None = None, sensor: str = "sensor"
) -> DataFrame:
    """Per window and sensor: average, extremes, events and anomalies.

    On a stream give `watermark`: append mode then emits a window once, when no row can still join it.
    Groups are few and combine map-side, so a hot sensor costs no more than the others.
    """
    rows = flagged.withWatermark("event_time", watermark) if watermark else flagged
    return rows.groupBy(F.window("event_time", length), F.col(sensor)).agg(
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_if("is_anomaly").alias("anomaly_count"),
    )


def window_bounds(windowed: DataFrame) -> DataFrame:
    """The window struct as two columns."""
    rest = [c for c in windowed.columns if c != "window"]
    return windowed.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def window_report(windowed: DataFrame, digits: int = 2) -> DataFrame:
    """Windows for reading: bounds first, rounded values, in order of start and sensor."""
    return (
        window_bounds(windowed)
        .select(
            "window_start",
            "window_end",
            "sensor",
            *[
                round_half_up(F.col(f"{name}_value"), digits).alias(name)
                for name in ("avg", "min", "max")
            ],
            "event_count",
            "anomaly_count",
        )
        .orderBy("window_start", "sensor")
    )


def rollup_windows(windowed: DataFrame, digits: int = 3) -> DataFrame:
    """Days from windows, without going back to the readings: averages are weighted by their counts."""
    events = F.sum("event_count")
    anomalies = F.sum("anomaly_count")
    return (
        windowed.groupBy(
            "sensor",
            F.year("window.start").alias("year"),
            F.month("window.start").alias("month"),
            F.dayofmonth("window.start").alias("day"),
        )
        .agg(
            events.alias("record_count"),
            round_half_up(
                F.try_divide(F.sum(F.col("avg_value") * F.col("event_count")), events), digits
            ).alias("avg_value"),
            round_half_up(F.min("min_value"), digits).alias("min_value"),
            round_half_up(F.max("max_value"), digits).alias("max_value"),
            anomalies.alias("anomaly_count"),
            percentage(anomalies, events).alias("anomaly_pct"),
        )
    )
