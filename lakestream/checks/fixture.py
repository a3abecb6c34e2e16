"""A sensor log and its lake, derived from the `events` table.

event_type plays the sensor, user_id modulo 3 the log partition, and the record's time is up to ten
minutes after the event. Tables that several queries read (the log, the zones) are written once per
application to the shared scratch folder, as a topic or a lake would be.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.functions.ordered import number_rows
from lakestream.plans.lake import Lake, build_gold, curated_readings
from lakestream.plans.maintenance import compact
from lakestream.schemas import CURATED_ZONE, SensorRule, SensorRules
from lakestream.session import prepare, scratch_path
from lakestream.sinks.batch import append_to_file_log, write_curated, write_raw
from lakestream.sources.log import LogConfig, read_log_batch
from lakestream.sources.zones import read_zone
from lakestream.streaming.writers import raw_zone_rows

Query = Callable[[SparkSession, str], DataFrame]

TOPIC = "sensor-events"
RULES = SensorRules(
    (
        SensorRule("click", "u", None, 0.0, 500.0),
        SensorRule("error", "C", 120.0, 0.0, 200.0),
        SensorRule("purchase", "C", 100.0, 0.0, 400.0),
        SensorRule("signup", "u", None, 0.0, 500.0),
        SensorRule("view", "u", None, 0.0, 500.0),
    )
)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(query(prepare(spark), sf_dir.rstrip("/")))

        run.__name__, run.__doc__ = query.__name__, query.__doc__
        QUERIES[query.__name__] = run
        if oracle:
            ORACLES[query.__name__] = oracle
        return query

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    zoned = {c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"}
    return df.withColumns(zoned) if zoned else df


_written: dict[tuple[str, str, str], str] = {}
_writing = threading.RLock()


def once(spark: SparkSession, label: str, sf_dir: str, build: Callable[[str], object]) -> str:
    """The path of a derived table, writing it on first use in this application."""
    slot = (spark.sparkContext.applicationId, label, sf_dir)
    with _writing:
        if slot not in _written:
            path = scratch_path(spark, label)
            build(path)
            _written[slot] = path
    return _written[slot]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- the log ---------------------------------------------------------------------------------------


def _positioned(spark: SparkSession, sf_dir: str, delay: Column | None = None) -> DataFrame:
    """Events with partition, offset and times; records arrive up to ten minutes, or `delay`, after the event."""
    events = table(spark, sf_dir, "events").withColumns(
        {
            "partition": (F.col("user_id") % 3).cast("int"),
            "topic": F.lit(TOPIC),
            "event_time": F.col("ts").cast("timestamp"),
        }
    )
    numbered = number_rows(events, ["partition"], "event_id")
    if delay is None:
        delay = F.make_dt_interval(secs=(F.col("event_id") * 37 % 600).cast("decimal(18,6)"))
    return numbered.withColumn("timestamp", F.col("event_time") + delay)


def _body() -> dict:
    return {
        "sensor": F.col("event_type"),
        "value": F.col("value"),
        "unit": F.when(F.col("event_type").isin("purchase", "error"), "C").otherwise("u"),
        "timestamp": F.unix_millis("event_time"),
        "device_id": F.format_string("dev-%d", "user_id"),
    }


def _as_records(positioned: DataFrame, value) -> DataFrame:
    return positioned.select(
        F.col("event_type").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def positioned_records(spark: SparkSession, sf_dir: str, delay: Column | None = None) -> DataFrame:
    body = F.to_json(F.struct(*[c.alias(n) for n, c in _body().items()]))
    return _as_records(_positioned(spark, sf_dir, delay), body)


def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event of each position of the log."""
    return _positioned(spark, sf_dir).select("partition", "offset", "event_id")


def log_path(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        append_to_file_log(positioned_records(spark, sf_dir), path)

    return once(spark, "log", sf_dir, build)


def log_config(spark: SparkSession, sf_dir: str, **settings) -> LogConfig:
    return LogConfig(TOPIC, format="parquet", path=log_path(spark, sf_dir), **settings)


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_log_batch(spark, log_config(spark, sf_dir))


# The payload variants a record gets by event_id modulo 50; every other one is well-formed.
# {s} sensor, {v} value, {t} epoch ms.
BROKEN = {
    0: "sensor={s}&value={v}",
    1: '{{"sensor":"{s}"}}',
    2: '{{"value":{v}}}',
    3: '{{"sensor":"{s}","value":null,"timestamp":{t}}}',
    4: '{{"sensor":"radar","value":{v},"timestamp":{t}}}',
    5: '{{"sensor":"{s}","value":"hot","timestamp":{t}}}',
    6: '{{"sensor":"{s}","value":"{v}","timestamp":{t}}}',
    7: '{{"sensor":"{s}","value":999.9,"timestamp":{t}}}',
    8: '{{"sensor":"{s}","value":"NaN","timestamp":{t}}}',
    9: '{{"sensor":"{s}","value":{v}}}',
    10: '{{"sensor":"{s}","value":{v},"timestamp":{t},"firmware":"1.2"}}',
    11: "[{v}]",
    12: '{{"sensor":"{s}","value":true,"timestamp":{t}}}',
    13: '{{"sensor":"{s}","value":-500.5,"timestamp":{t}}}',
    14: '{{"sensor":"{s}","value":{v}}} x',
    15: '{{"a":1}}{{"b":2}}',
    16: '{{"sensor":"{s}","value":"\\t{v}\u00a0","timestamp":{t}}}',
    17: '{{"sensor":"{s}","value":NaN,"timestamp":{t}}}',
    18: '{{"sensor":"{s}","value":Infinity,"timestamp":{t}}}',
}
# the variants that do not reach the curated zone
REJECTED = "(0, 1, 2, 3, 5, 6, 8, 9, 11, 12, 13, 14, 15, 16, 17, 18)"
GOOD = '{{"sensor":"{s}","value":{v},"timestamp":{t}}}'


def _variant(template: str):
    text = template.replace("{{", "{").replace("}}", "}")
    for mark in ("{s}", "{v}", "{t}"):
        text = text.replace(mark, "%s")
    columns = {"{s}": F.col("event_type"), "{v}": F.col("value"), "{t}": F.unix_millis("event_time")}
    marks = [m for _, m in sorted((template.find(m), m) for m in columns if m in template)]
    return F.format_string(text, *[columns[m].cast("string") for m in marks]) if marks else F.lit(text)


def broken_config(spark: SparkSession, sf_dir: str) -> LogConfig:
    """The same log with some payloads damaged, written once."""

    def build(path: str) -> None:
        case = F.col("event_id") % 50
        chosen = None
        for number, template in BROKEN.items():
            hit, text = case == number, _variant(template)
            chosen = F.when(hit, text) if chosen is None else chosen.when(hit, text)
        body = chosen.otherwise(_variant(GOOD))
        append_to_file_log(_as_records(_positioned(spark, sf_dir), body), path)

    path = once(spark, "broken-log", sf_dir, build)
    return LogConfig(TOPIC, format="parquet", path=path)


def broken_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_log_batch(spark, broken_config(spark, sf_dir))


# --- the lake --------------------------------------------------------------------------------------


def lake(spark: SparkSession, sf_dir: str, *zones: str) -> Lake:
    """A lake in which the named zones, "raw", "curated" or "gold", have been built by batch jobs."""
    made = Lake(once(spark, "lake", sf_dir, lambda path: None), TOPIC)
    build = {
        "raw": lambda _: write_raw(raw_zone_rows(log(spark, sf_dir)), made.raw),
        "curated": lambda _: write_curated(
            curated_readings(log(spark, sf_dir), RULES), made.curated
        ),
        "gold": lambda _: build_gold(spark, lake(spark, sf_dir, "curated")),
    }
    for zone in zones:
        once(spark, f"lake-{zone}", sf_dir, build[zone])
    return made


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_zone(spark, lake(spark, sf_dir, "curated").curated, CURATED_ZONE)


def compacted(spark: SparkSession, sf_dir: str) -> str:
    """The curated zone with one file per directory."""
    source = lake(spark, sf_dir, "curated").curated
    return once(spark, "compacted", sf_dir, lambda path: compact(spark, source, path))


# --- the same in SQL -------------------------------------------------------------------------------

SQL_LOG = """
log AS (
  SELECT event_id, event_type AS sensor, value, user_id, ts, epoch_us(ts) // 1000 AS ms,
         date_trunc('milliseconds', ts) AS event_time,
         CASE WHEN event_type IN ('purchase','error') THEN 'C' ELSE 'u' END AS unit,
         'dev-' || user_id AS device_id,
         CAST(user_id % 3 AS INTEGER) AS "partition",
         row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS "offset",
         ts + to_seconds((event_id * 37) % 600) AS kafka_timestamp,
         CASE event_type WHEN 'purchase' THEN value > 100 WHEN 'error' THEN value > 120
              ELSE false END AS is_anomaly,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day
  FROM events
)"""


def sql_round(expression: str, digits: int) -> str:
    """Decimal rounding, ties away from zero, as a double."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def sql_pct(part: str, whole: str) -> str:
    return sql_round(f"100.0::DOUBLE * ({part}) / ({whole})", 2)


def sql_body() -> str:
    """The damaged payload of an event as SQL text."""

    def literal(template: str) -> str:
        text = "'" + template.replace("{{", "{").replace("}}", "}") + "'"
        for mark, column in (("{s}", "sensor"), ("{v}", "value"), ("{t}", "ms")):
            text = text.replace(mark, f"' || CAST({column} AS VARCHAR) || '")
        return text

    cases = " ".join(f"WHEN {n} THEN {literal(t)}" for n, t in BROKEN.items())
    return f"CASE event_id % 50 {cases} ELSE {literal(GOOD)} END"
