"""Questions asked of the curated zone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.functions.columns import date_string, percentage, round_half_up
from lakestream.operators.lake_audit import partition_values
from lakestream.operators.quality import only_sensor
from lakestream.schemas import DEFAULT_RULES, SensorRules

DAY_KEYS = ("sensor_type", "year", "month", "day")
# The span of days a caller may ask for, and the span when none is given.
MIN_DAYS, MAX_DAYS, DEFAULT_DAYS = 1, 90, 7


def _stats(digits: int) -> list[Column]:
    anomalies = F.count_if("is_anomaly")
    return [
        F.count("value").alias("record_count"),
        round_half_up(F.avg("value"), digits).alias("avg_value"),
        round_half_up(F.min("value"), digits).alias("min_value"),
        round_half_up(F.max("value"), digits).alias("max_value"),
        anomalies.alias("anomaly_count"),
        percentage(anomalies, F.count("value")).alias("anomaly_pct"),
    ]


def breakdown(flagged: DataFrame, sensor: str = "sensor") -> DataFrame:
    """Readings and anomalies per sensor."""
    return flagged.groupBy(sensor).agg(
        F.count(F.lit(1)).alias("total"), F.count_if("is_anomaly").alias("anomalies")
    )


def daily_stats(curated: DataFrame, sensor: str | None = None, digits: int = 3) -> DataFrame:
    """Gold: one row per sensor and calendar day."""
    return only_sensor(curated, sensor).groupBy(*DAY_KEYS).agg(*_stats(digits))


def sensor_comparison(curated: DataFrame) -> DataFrame:
    """Sensors side by side over the whole zone."""
    return curated.groupBy("sensor_type").agg(
        F.count("value").alias("total_records"),
        round_half_up(F.avg("value"), 2).alias("overall_avg"),
        round_half_up(F.min("value"), 2).alias("overall_min"),
        round_half_up(F.max("value"), 2).alias("overall_max"),
        F.count_if("is_anomaly").alias("total_anomalies"),
    )


def _settled(expression: str, digits: int = 2) -> str:
    """`round_half_up` as text."""
    return f"round(round({expression}, 9), {digits})"


@dataclass(frozen=True)
class Report:
    """One question: what a row is, its figures by name, and the order of the rows. The DataFrame form and
    the SQL text are both made from it, so there is one definition of every figure."""

    keys: Mapping[str, str]
    figures: Mapping[str, str]
    order: tuple[str, ...]
    one_sensor: bool = False

    def of(self, rows: DataFrame) -> DataFrame:
        named = [F.expr(expression).alias(name) for name, expression in self.keys.items()]
        figures = [F.expr(expression).alias(name) for name, expression in self.figures.items()]
        order = [F.desc(o.removeprefix("-")) if o.startswith("-") else F.asc(o) for o in self.order]
        return rows.groupBy(*named).agg(*figures).orderBy(*order)

    def sql(self, view: str) -> str:
        chosen = [f"{expression} AS {name}" for name, expression in {**self.keys, **self.figures}.items()]
        order = [f"{o[1:]} DESC" if o.startswith("-") else o for o in self.order]
        return " ".join(
            [
                f"SELECT {', '.join(chosen)} FROM {view}",
                "WHERE sensor_type = :sensor" if self.one_sensor else "",
                f"GROUP BY {', '.join(self.keys.values())} ORDER BY {', '.join(order)}",
            ]
        )


_COUNT, _ANOMALIES = "count(*)", "count_if(is_anomaly)"
_MEAN, _LEAST, _MOST = (_settled(f"{f}(value)") for f in ("avg", "min", "max"))

# The names of reports and of their columns are fixed values.
REPORTS = {
    "day_report": Report(
        {key: key for key in DAY_KEYS},
        {
            "avg_value": _MEAN,
            "min_value": _LEAST,
            "max_value": _MOST,
            "total_records": _COUNT,
            "anomalies": _ANOMALIES,
        },
        DAY_KEYS,
        one_sensor=True,
    ),
    "anomaly_shares": Report(
        {"sensor_type": "sensor_type"},
        {
            "total": _COUNT,
            "anomalies": _ANOMALIES,
            "anomaly_pct": _settled(f"try_divide({_ANOMALIES} * 100.0D, {_COUNT})"),
        },
        ("-anomaly_pct", "sensor_type"),
    ),
    "hourly_trend": Report(
        {"hour_of_day": "hour(event_time)"},
        {"avg_value": _MEAN, "readings": _COUNT},
        ("hour_of_day",),
        one_sensor=True,
    ),
    "sensor_spread": Report(
        {"sensor_type": "sensor_type"},
        {"mean": _MEAN, "std_dev": _settled("stddev_samp(value)"), "p0": _LEAST, "p100": _MOST, "n": _COUNT},
        ("sensor_type",),
    ),
}


def day_report(curated: DataFrame, sensor: str, by_day_of_month: bool = False) -> DataFrame:
    """Daily figures of one sensor, read from its directories only.

    `by_day_of_month` groups by the day number alone, which merges the 5th of every month into one row;
    without it a row is a calendar day.
    """
    report = REPORTS["day_report"]
    if by_day_of_month:
        keys = ("sensor_type", "day")
        report = replace(report, keys={key: key for key in keys}, order=keys)
    return report.of(only_sensor(curated, sensor))


def anomaly_shares(curated: DataFrame) -> DataFrame:
    """Share of anomalies per sensor, the highest first."""
    return REPORTS["anomaly_shares"].of(curated)


def hourly_trend(curated: DataFrame, sensor: str) -> DataFrame:
    """Average by hour of day, in UTC."""
    return REPORTS["hourly_trend"].of(only_sensor(curated, sensor))


def sensor_spread(curated: DataFrame) -> DataFrame:
    """Mean, sample deviation and extremes; the deviation of a single reading is null."""
    return REPORTS["sensor_spread"].of(curated)


def row_counts(curated: DataFrame, sensor: str) -> DataFrame:
    """Rows of the zone and of one sensor, in one metadata-cheap scan: only a partition column is read."""
    return curated.agg(
        F.count(F.lit(1)).alias("all_rows"),
        F.count_if(F.col("sensor_type") == sensor).alias("sensor_rows"),
    )


def checked_days(days: int | str | None) -> int:
    """The requested number of days as an int between 1 and 90."""
    if days is None:
        return DEFAULT_DAYS
    if isinstance(days, bool) or not isinstance(days, (int, str)):
        raise ValueError(f"days must be an integer, not {days!r}")
    number = int(days)
    if not MIN_DAYS <= number <= MAX_DAYS:
        raise ValueError(f"days must be between {MIN_DAYS} and {MAX_DAYS}, not {number}")
    return number


def checked_sensor(sensor: str, rules: SensorRules = DEFAULT_RULES) -> str:
    if sensor not in rules.sensors:
        raise ValueError(f"unknown sensor {sensor!r}, expected one of {rules.sensors}")
    return sensor


def last_days(curated: DataFrame, days: int, as_of: dt.date) -> DataFrame:
    """Rows dated `days` days before `as_of` or later; the first day counts in full, so 7 days can span
    8 dates. The condition is on partition columns only and prunes directories."""
    first = as_of - dt.timedelta(days=days)
    return curated.filter(F.make_date("year", "month", "day") >= F.lit(first))


def sensor_stats(
    curated: DataFrame, sensor: str, days: int | str | None = None, as_of: dt.date | None = None
) -> DataFrame:
    """Daily figures of one sensor over the last days, newest first, as the API serves them: an empty
    figure is 0, the date is text."""
    day = as_of or dt.datetime.now(dt.timezone.utc).date()
    recent = last_days(only_sensor(curated, sensor), checked_days(days), day)
    zero = F.lit(0.0)
    return (
        recent.groupBy("year", "month", "day")
        .agg(*_stats(3))
        .orderBy(F.desc("year"), F.desc("month"), F.desc("day"))
        .select(
            date_string(F.col("year"), F.col("month"), F.col("day")).alias("date"),
            F.lit(sensor).alias("sensor_type"),
            "record_count",
            *[F.coalesce(F.col(c), zero).alias(c) for c in ("avg_value", "min_value", "max_value")],
            "anomaly_count",
            F.coalesce(F.col("anomaly_pct"), zero).alias("anomaly_pct"),
        )
    )


def sensor_types(spark: SparkSession, curated: str, known: Sequence[str] = ()) -> DataFrame:
    """Sensors the zone has directories with data for, sorted; the known ones while there are none. Taken
    from the file listing: no file is opened."""
    present = partition_values(spark, curated, "sensor_type")
    if known and present.isEmpty():
        rows = [(name,) for name in sorted(known)]
        return spark.createDataFrame(rows, "sensor_type string")
    return present.orderBy("sensor_type")


def preview(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows of an ordering; each task keeps n, nothing is sorted in full."""
    return df.orderBy(*order).limit(n)


# The same questions as SQL over the views of `sources.zones.register_views`. Arguments are bound, never
# pasted into the text.
SQL = {name: report.sql("sensor_curated") for name, report in REPORTS.items()} | {
    "full_count": "SELECT count(*) AS n FROM sensor_curated",
    "pruned_count": "SELECT count(*) AS n FROM sensor_curated WHERE sensor_type = :sensor",
}


def run_sql(spark: SparkSession, name: str, **args: object) -> DataFrame:
    return spark.sql(SQL[name], args=args)
