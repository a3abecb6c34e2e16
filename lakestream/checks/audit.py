"""Serving from the log, and auditing it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.checks.fixture import (
    REJECTED,
    RULES,
    SQL_LOG,
    TOPIC,
    broken_log,
    check,
    curated,
    log,
    log_config,
    once,
    positioned_records,
    sql_round,
    table,
)
from lakestream.functions.payload import parse_readings
from lakestream.operators import log_audit as audit
from lakestream.operators import sketches
from lakestream.operators.hash_tree import hash_tree_diff
from lakestream.operators.quality import only_sensor
from lakestream.operators.windows import window_bounds
from lakestream.plans.etl import statistics
from lakestream.plans.lake import curated_readings
from lakestream.schemas import SensorRules
from lakestream.session import scratch_path
from lakestream.sinks.batch import append_to_file_log, write_batch
from lakestream.sources.log import (
    LogConfig,
    StartPosition,
    end_offsets,
    read_log_batch,
    seek_back_for,
)
from lakestream.sources.log import tail_log as tail
from lakestream.sources.time_index import extend_time_index, first_by_index, read_time_index

WITH_LOG = f"WITH {SQL_LOG}"
SQL_ENDS = """ends AS (SELECT "partition", max("offset") + 1 AS "end" FROM log GROUP BY 1)"""


def _readings(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    return parse_readings(log(spark, sf), extra=extra)


@check(
    f"""{WITH_LOG}, {SQL_ENDS}
    SELECT log."partition", "offset", sensor AS key FROM log JOIN ends USING ("partition")
    WHERE "offset" >= "end" - 30"""
)
def tail_records(spark: SparkSession, sf: str) -> DataFrame:
    """The last 30 offsets of every partition."""
    rows = tail(log(spark, sf), seek_back_for(10))
    return rows.select("partition", "offset", F.col("key").cast("string").alias("key"))


_LATEST = """sensor AS sensor_type, value, unit, device_id, ms AS "timestamp", "partition", "offset",
  strftime(ts, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN ms % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') || '000' END
    || '+00:00' AS event_time"""
_NEWEST = """row_number() OVER (PARTITION BY sensor ORDER BY ms DESC, "partition" DESC, "offset" DESC)"""


@check(f"{WITH_LOG} SELECT {_LATEST} FROM log QUALIFY {_NEWEST} = 1")
def latest_reading(spark: SparkSession, sf: str) -> DataFrame:
    return audit.latest_readings(_readings(spark, sf))


@check(f"{WITH_LOG} SELECT {_LATEST}, CAST({_NEWEST} AS INTEGER) AS rank FROM log QUALIFY rank <= 5")
def latest_five(spark: SparkSession, sf: str) -> DataFrame:
    return audit.latest_readings(_readings(spark, sf), 5)


@check(
    f"""{WITH_LOG}, {SQL_ENDS}, tail AS (
      SELECT log.* FROM log JOIN ends USING ("partition") WHERE "offset" >= "end" - 30)
    SELECT {_LATEST}, CAST({_NEWEST} AS INTEGER) AS rank FROM tail
    WHERE sensor = 'purchase' QUALIFY rank <= 5"""
)
def latest_from_tail(spark: SparkSession, sf: str) -> DataFrame:
    """The quick form, asked to look only at the end of each partition, which may be partial."""
    return audit.latest_of_log(log(spark, sf), 5, "purchase", seek_back_for(5), extend=False)


@check(
    f"""{WITH_LOG}, {SQL_ENDS}, kept AS (
      SELECT log.* FROM log JOIN ends USING ("partition") WHERE sensor <> 'error' OR "offset" < "end" - 200)
    SELECT {_LATEST}, CAST({_NEWEST} AS INTEGER) AS rank FROM kept
    WHERE sensor = 'error' QUALIFY rank <= 5"""
)
def latest_quiet_sensor(spark: SparkSession, sf: str) -> DataFrame:
    """A sensor that sent nothing for the last 200 offsets of any partition: the tail reaches back to it."""
    records = log(spark, sf)
    ends = {r["partition"]: r["end"] for r in end_offsets(records).collect()}
    quiet = F.lit(False)
    for partition, end in ends.items():
        quiet = quiet | ((F.col("partition") == partition) & (F.col("offset") >= end - 200))
    records = records.filter(~(quiet & (F.col("key") == F.lit("error").cast("binary"))))
    return audit.latest_of_log(records, 5, "error")


@check(
    f"""{WITH_LOG}, {SQL_ENDS}, kept AS (
      SELECT log.* REPLACE (CASE WHEN log."partition" = 0 THEN ts + INTERVAL '400 days' ELSE ts END AS ts,
                            CASE WHEN log."partition" = 0 THEN ms + 34560000000 ELSE ms END AS ms)
      FROM log JOIN ends USING ("partition")
      WHERE log."partition" <> 0 OR sensor <> 'purchase' OR "offset" < "end" // 2)
    SELECT {_LATEST}, CAST({_NEWEST} AS INTEGER) AS rank FROM kept
    WHERE sensor = 'purchase' QUALIFY rank <= 5"""
)
def latest_across_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The newest readings lie deep in a partition where the sensor has gone quiet; the others have older ones at
    their very end."""
    records = log(spark, sf)
    end = next(r["end"] for r in end_offsets(records).collect() if r["partition"] == 0)
    bought = F.col("key") == F.lit("purchase").cast("binary")
    records = records.filter((F.col("partition") != 0) | ~bought | (F.col("offset") < end // 2))
    text = F.col("value").cast("string")
    sent = F.get_json_object(text, "$.timestamp")
    later = F.replace(text, sent, (sent.cast("bigint") + 400 * 86_400_000).cast("string")).cast("binary")
    moved = records.withColumn("value", F.when(F.col("partition") == 0, later).otherwise(F.col("value")))
    return audit.latest_of_log(moved, 5, "purchase")


@check(
    f"""{WITH_LOG}
    SELECT "partition", "offset" // 50 AS chunk, sensor, count(*) AS count,
           {sql_round('min(value)', 2)} AS min, {sql_round('max(value)', 2)} AS max,
           {sql_round('avg(value)', 2)} AS avg FROM log GROUP BY 1, 2, 3"""
)
def batch_stats(spark: SparkSession, sf: str) -> DataFrame:
    return audit.batch_stats(_readings(spark, sf))


def _lag(spark: SparkSession, sf: str) -> DataFrame:
    """A consumer that has committed the purchases of partition 0, nothing in 1, and all of 2."""
    records = log(spark, sf)
    bought = F.col("key") == F.lit("purchase").cast("binary")
    committed = records.groupBy("topic", "partition").agg(
        F.when(F.col("partition") == 0, F.max(F.when(bought, F.col("offset") - 20)))
        .when(F.col("partition") == 2, F.max("offset") + 1)
        .otherwise(F.lit(-1001))
        .alias("committed")
    )
    return audit.lag_table(end_offsets(records), committed)


SQL_LAG = f"""{SQL_ENDS}, raw_lag AS (
  SELECT ends."partition", "end",
         CASE "partition" WHEN 0 THEN (SELECT max("offset") - 20 FROM log
                                       WHERE "partition" = 0 AND sensor = 'purchase')
              WHEN 2 THEN "end" ELSE -1001 END AS c FROM ends
), lag AS (
  SELECT '{TOPIC}' AS topic, "partition", greatest(c, 0) AS committed, "end",
         greatest(0, "end" - greatest(c, 0)) AS lag FROM raw_lag
)"""


@check(
    f"""{WITH_LOG}, {SQL_LAG}
    SELECT *, CASE WHEN lag > 50 THEN 'high' WHEN lag = 0 THEN 'ok' ELSE 'behind' END AS flag FROM lag"""
)
def lag_table(spark: SparkSession, sf: str) -> DataFrame:
    return audit.lag_flags(_lag(spark, sf))


@check(
    f"""{WITH_LOG}, {SQL_LAG}
    SELECT topic, CAST(sum(lag) AS BIGINT) AS total_lag,
           CASE WHEN sum(lag) = 0 THEN 'HEALTHY' ELSE 'BEHIND' END AS status FROM lag GROUP BY 1"""
)
def lag_status(spark: SparkSession, sf: str) -> DataFrame:
    return audit.lag_status(_lag(spark, sf))


def _routing(key: str) -> str:
    return f"""{WITH_LOG}
    SELECT '{TOPIC}' AS topic, {key} AS key, count(*) AS records,
           count(DISTINCT "partition") AS partitions,
           array_to_string(list_sort(list(DISTINCT "partition")), ',') AS partition_list,
           count(DISTINCT "partition") = 1 AS single FROM log GROUP BY 2"""


def _listed(routing: DataFrame) -> DataFrame:
    as_text = F.array_join(F.transform("partition_list", lambda p: p.cast("string")), ",")
    return routing.withColumn("partition_list", as_text)


@check(_routing("device_id"))
def device_routing(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that stay on one partition."""
    return _listed(audit.key_partitions(_readings(spark, sf, "topic"), "device_id"))


@check(_routing("sensor"))
def sensor_routing(spark: SparkSession, sf: str) -> DataFrame:
    """Keys spread over all partitions."""
    return _listed(audit.key_partitions(_readings(spark, sf, "topic"), "sensor"))


def _without(records: DataFrame, key: str) -> DataFrame:
    return records.filter(F.col("key") != F.lit(key).cast("binary"))


def _only(records: DataFrame, key: str) -> DataFrame:
    return records.filter(F.col("key") == F.lit(key).cast("binary"))


@check(
    f"""{WITH_LOG}, step AS (
      SELECT "partition", "offset" AS next_offset,
             lag("offset") OVER (PARTITION BY "partition" ORDER BY "offset") AS after_offset
      FROM log WHERE sensor <> 'error')
    SELECT '{TOPIC}' AS topic, *, next_offset - after_offset - 1 AS missing FROM step
    WHERE next_offset - after_offset > 1"""
)
def offset_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Holes left where one key's records are gone."""
    return audit.offset_gaps(_without(log(spark, sf), "error"))


@check(
    f"""{WITH_LOG}, twice AS (
      SELECT "partition", "offset" FROM log WHERE sensor <> 'error'
      UNION ALL SELECT "partition", "offset" FROM log WHERE sensor = 'purchase')
    SELECT '{TOPIC}' AS topic, "partition", min("offset") AS first_offset, max("offset") AS last_offset,
           count(*) AS records, max("offset") - min("offset") + 1 - count(DISTINCT "offset") AS missing,
           count(*) - count(DISTINCT "offset") AS repeats
    FROM twice GROUP BY 2"""
)
def partition_completeness(spark: SparkSession, sf: str) -> DataFrame:
    records = log(spark, sf)
    return audit.partition_completeness(
        _without(records, "error").unionByName(_only(records, "purchase"))
    )


def _sequence(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """event_id as the sequence: errors were lost, purchases arrived twice, signups are numbered beyond
    what was expected."""
    events = table(spark, sf, "events").select("event_id", "event_type")
    expected = events.agg(F.max("event_id") + 1).first()[0]
    seq = F.when(F.col("event_type") == "signup", F.col("event_id") + expected).otherwise(F.col("event_id"))
    copies = F.when(F.col("event_type") == "purchase", 2).otherwise(1)
    arrived = events.filter("event_type <> 'error'").select(
        seq.alias("seq"), F.explode(F.array_repeat(F.lit(1), copies))
    )
    return arrived.select("seq"), expected


@check(
    """SELECT (SELECT max(event_id) + 1 FROM events) AS expected,
              count(*) FILTER (event_type <> 'error') + count(*) FILTER (event_type = 'purchase') AS received,
              count(*) FILTER (event_type IN ('error', 'signup')) AS missing,
              count(*) FILTER (event_type = 'purchase') AS repeated,
              count(*) FILTER (event_type = 'signup') AS unexpected,
              count(*) FILTER (event_type <> 'error') + count(*) FILTER (event_type = 'purchase')
                >= (SELECT max(event_id) + 1 FROM events) AS enough,
              count(*) FILTER (event_type IN ('error', 'signup')) = 0 AS complete
       FROM events"""
)
def sequence_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.sequence_audit(*_sequence(spark, sf))


@check(
    """WITH n AS (SELECT max(event_id) + 1 AS expected FROM events)
       SELECT event_id AS seq, 0::BIGINT AS copies, 'missing' AS status FROM events
       WHERE event_type IN ('error', 'signup')
       UNION ALL SELECT event_id, 2, 'repeated' FROM events WHERE event_type = 'purchase'
       UNION ALL SELECT event_id + expected, 1, 'unexpected' FROM events, n WHERE event_type = 'signup'"""
)
def sequence_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Every missing, repeated or unexpected number."""
    return audit.sequence_counts(*_sequence(spark, sf)).filter("status <> 'ok'")


@check(
    f"""{WITH_LOG} SELECT sensor AS message_key, sensor, value, unit, device_id, event_time, "partition",
                          "offset", kafka_timestamp, '{TOPIC}' AS topic FROM log"""
)
def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    """Re-delivered records have no second effect."""
    records = log(spark, sf)
    return parse_readings(audit.dedupe_log(records.unionByName(_only(records, "purchase"))), extra=["topic"])


@check(
    """SELECT * FROM (VALUES ('identical', true, true), ('nulls swapped', false, false),
         ('empty text for null', false, false), ('columns swapped', false, false),
         ('columns reordered', true, true), ('one row twice', false, false),
         ('null in a struct', false, false), ('a column more', false, false))
       t(case_name, by_fingerprint, exactly)"""
)
def same_rows_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Whole tables that differ only in where their nulls are, judged both ways."""
    events = table(spark, sf, "events").select("event_id", "event_type")
    null, text = F.lit(None).cast("string"), F.col("event_type")
    base = events.select("event_id", null.alias("a"), text.alias("b"))
    pairs = {
        "identical": (base, base),
        "nulls swapped": (base, events.select("event_id", text.alias("a"), null.alias("b"))),
        "empty text for null": (base, base.withColumn("a", F.lit(""))),
        "columns swapped": (
            events.select("event_id", F.lit("x").alias("a"), text.alias("b")),
            events.select("event_id", text.alias("a"), F.lit("x").alias("b")),
        ),
        "columns reordered": (base, base.select("b", "event_id", "a")),
        "one row twice": (base, base.union(base.filter("event_id = 0"))),
        "null in a struct": (
            base.select("event_id", F.struct("a", "b").alias("s")),
            base.select("event_id", F.struct(F.col("b").alias("a"), F.col("a").alias("b")).alias("s")),
        ),
        "a column more": (base, base.withColumn("c", F.lit(1))),
    }
    rows = [(name, audit.same_rows(a, b), audit.same_rows(a, b, exact=True)) for name, (a, b) in pairs.items()]
    return spark.createDataFrame(rows, "case_name string, by_fingerprint boolean, exactly boolean")


@check(
    f"""{WITH_LOG}, seen AS (
      SELECT "partition", "offset", sensor, kafka_timestamp, 1::BIGINT AS copies,
             max(kafka_timestamp) OVER (PARTITION BY "partition" ORDER BY "offset"
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '2 minutes' AS watermark,
             time_bucket(INTERVAL '5 minutes', kafka_timestamp) + INTERVAL '5 minutes' AS window_end
      FROM log)
    SELECT * FROM seen WHERE window_end <= watermark"""
)
def late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Arrival times run out of order by up to ten minutes; taken as event times, some come too late."""
    return audit.late_events(_readings(spark, sf), event_time="kafka_timestamp")


@check(
    f"""{WITH_LOG}, d AS (SELECT *, epoch_us(kafka_timestamp) // 1000 - ms AS delay FROM log)
    SELECT date_trunc('hour', kafka_timestamp) AS arrival_hour, count(*) AS readings,
           min(delay) AS min_delay_ms, {sql_round('avg(delay)', 3)} AS avg_delay_ms,
           max(delay) AS max_delay_ms, count(*) FILTER (delay > 120000) AS late,
           count(*) FILTER (ts::DATE < kafka_timestamp::DATE) AS earlier_day
    FROM d GROUP BY 1"""
)
def ingestion_delay(spark: SparkSession, sf: str) -> DataFrame:
    return audit.ingestion_delay(_readings(spark, sf))


def _quantile(q: float) -> str:
    return f"list_sort(list(step))[CAST(ceil(count(*) * {q}::DOUBLE) AS BIGINT)]"


@check(
    f"""{WITH_LOG}, d AS (SELECT kafka_timestamp, (epoch_us(kafka_timestamp) // 1000 - ms) // 1000 * 1000 AS step
                          FROM log)
    SELECT date_trunc('hour', kafka_timestamp) AS arrival_hour, {_quantile(0.5)} AS p50_ms,
           {_quantile(0.95)} AS p95_ms, {_quantile(0.99)} AS p99_ms FROM d GROUP BY 1"""
)
def delay_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return audit.delay_quantiles(_readings(spark, sf))


@check(
    f"""{WITH_LOG}, w AS (
      SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
             time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end, sensor,
             count(*) FILTER (is_anomaly) AS anomalies
      FROM log GROUP BY ALL)
    SELECT window_start, window_end, sensor,
           CASE sensor WHEN 'error' THEN 'only_left' ELSE 'differs' END AS status,
           CASE sensor WHEN 'error' THEN 'max_value,event_count,anomaly_count' ELSE 'anomaly_count' END
             AS differences
    FROM w WHERE sensor = 'error' OR (sensor = 'purchase' AND anomalies > 0)"""
)
def result_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of the windows: one key is gone and purchases are never anomalous on the right."""
    keys = ["window_start", "window_end", "sensor"]
    columns = [*keys, "max_value", "event_count", "anomaly_count"]
    left = window_bounds(statistics(log(spark, sf), RULES)).select(*columns)
    lenient = SensorRules(tuple(r for r in RULES.rules if r.sensor != "purchase"))
    right = window_bounds(statistics(_without(log(spark, sf), "error"), lenient)).select(*columns)
    found = audit.compare_results(left, right, keys)
    return found.withColumn("differences", F.array_join("differences", ","))


@check(
    f"""{WITH_LOG}
    SELECT sensor, unit, device_id, count(*) * CASE sensor WHEN 'error' THEN 1 ELSE -1 END AS surplus
    FROM log WHERE sensor IN ('error', 'purchase') GROUP BY 1, 2, 3"""
)
def multiset_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Errors are missing on the right, purchases are there twice."""
    records = log(spark, sf)
    changed = _without(records, "error").unionByName(_only(records, "purchase"))
    columns = ("sensor", "unit", "device_id")
    return audit.multiset_diff(
        parse_readings(records).select(*columns), parse_readings(changed).select(*columns)
    )


@check(
    f"""{WITH_LOG}, kept AS (
      SELECT *, CASE WHEN sensor = 'error' AND day = 7 THEN 'lost' WHEN sensor = 'view' AND day = 3 AND "offset" % 2 = 0 THEN 'twice'
                     WHEN sensor = 'click' AND day = 20 THEN 'changed' END AS damage FROM log)
    SELECT sensor AS sensor_type, day, "partition", "offset", value, CAST(surplus AS BIGINT) AS surplus FROM (
      SELECT *, value AS v, CASE damage WHEN 'twice' THEN -1 ELSE 1 END AS surplus FROM kept WHERE damage IS NOT NULL
      UNION ALL SELECT * REPLACE (value + 1 AS value), value, -1 FROM kept WHERE damage = 'changed')"""
)
def hash_tree_differences(spark: SparkSession, sf: str) -> DataFrame:
    """The curated zone against a copy that has lost a day, holds half of another twice, and has a third changed."""
    columns = ("sensor_type", "year", "month", "day", "partition", "offset", "value")
    zone = curated(spark, sf).select(*columns)
    of, day = F.col("sensor_type"), F.col("day")
    changed = F.when((of == "click") & (day == 20), F.col("value") + 1).otherwise(F.col("value"))
    twice = zone.filter((of == "view") & (day == 3) & (F.col("offset") % 2 == 0))
    copy = zone.filter((of != "error") | (day != 7)).withColumn("value", changed).unionByName(twice)
    return hash_tree_diff(zone, copy, buckets=16).drop("year", "month")


_DELAYS = """delays AS (
      SELECT date_trunc('hour', kafka_timestamp) AS hour, date_trunc('day', kafka_timestamp) AS day,
             epoch_ms(kafka_timestamp) - ms AS delay FROM log)"""


@check(
    f"""{WITH_LOG}, {_DELAYS}
    SELECT 'hour' AS span, hour AS start, count(*) AS readings, true AS close FROM delays GROUP BY 2
    UNION ALL SELECT 'day', day, count(*), true FROM delays GROUP BY 2"""
)
def delay_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of hours from stored sketches, and of days from the hours' sketches merged: each within the rank
    error of the exact one."""
    path = scratch_path(spark, "sketches")
    readings = parse_readings(log(spark, sf))
    write_batch(sketches.delay_sketches(readings), path)
    stored = spark.read.parquet(path).withColumnRenamed("arrival_hour", "start")
    days = sketches.merged_sketches(stored, [F.date_trunc("day", "start").alias("start")])
    parts = []
    for span, held in (("hour", stored), ("day", days)):
        found = sketches.sketch_quantiles(held, (0.5, 0.95))
        delays = readings.select(F.date_trunc(span, "kafka_timestamp").alias("start"), sketches.delay_ms().alias("delay"))
        ranks = []
        for name, share in (("p50_ms", 0.5), ("p95_ms", 0.95)):
            below, upto = F.count_if(F.col("delay") < F.col(name)), F.count_if(F.col("delay") <= F.col(name))
            slack = 0.02 * F.count(F.lit(1)) + 1
            ranks.append((below <= share * F.count(F.lit(1)) + slack) & (upto >= share * F.count(F.lit(1)) - slack))
        judged = delays.join(found, "start").groupBy("start", "readings").agg((ranks[0] & ranks[1]).alias("close"))
        parts.append(judged.select(F.lit(span).alias("span"), "start", "readings", "close"))
    return parts[0].unionByName(parts[1])


@check(
    f"""{WITH_LOG}, kept AS (
      SELECT "partition", "offset" + 1 AS seq FROM log
      WHERE "offset" % 7 <> 3 AND "offset" // 100 % 3 <> 1 AND day IN (9, 10)),
    gaps AS (SELECT "partition", lag(seq) OVER (PARTITION BY "partition" ORDER BY seq) AS after, seq FROM kept)
    SELECT "partition", after + 1 AS first, seq - 1 AS last, seq - after - 1 AS missing FROM gaps WHERE seq > after + 1"""
)
def sequence_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers missing from two days of messages, from bitmaps stored day by day."""
    path = scratch_path(spark, "bitmaps")
    readings = parse_readings(log(spark, sf)).withColumn("seq", F.col("offset") + 1)
    kept = readings.filter((F.col("offset") % 7 != 3) & (F.expr("offset div 100") % 3 != 1))
    day = F.dayofmonth("event_time").alias("day")
    for number in (9, 10):
        one = kept.filter(F.dayofmonth("event_time") == number)
        sketches.presence_bitmaps(one, [day, "partition"]).write.mode("append").parquet(path)
    merged = sketches.merged_bitmaps(spark.read.parquet(path), ["partition"])
    return sketches.missing_ranges(merged, ["partition"])


def _reconciled(spark: SparkSession, sf: str) -> DataFrame:
    """The damaged log against a curated zone that lost the views and holds the signups twice."""
    readings = parse_readings(broken_log(spark, sf))
    zone = curated_readings(broken_log(spark, sf), RULES).filter("sensor_type <> 'view'")
    zone = zone.unionByName(zone.filter("sensor_type = 'signup'"))
    return audit.reconcile(readings, zone, RULES)


SQL_RECONCILED = f"""
fate AS (
  SELECT "partition", "offset",
         CASE WHEN event_id % 50 IN {REJECTED} THEN 'rejected'
              WHEN event_id % 50 = 4 THEN 'curated' WHEN sensor = 'view' THEN 'lost'
              WHEN sensor = 'signup' THEN 'duplicated' ELSE 'curated' END AS status
  FROM log)"""


@check(f"{WITH_LOG}, {SQL_RECONCILED} SELECT status, count(*) AS offsets FROM fate GROUP BY 1")
def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    return audit.reconcile_summary(_reconciled(spark, sf))


@check(
    f"""{WITH_LOG}, {SQL_RECONCILED}
    SELECT "partition", "offset", status FROM fate WHERE status IN ('lost', 'duplicated')"""
)
def reconciliation_problems(spark: SparkSession, sf: str) -> DataFrame:
    rows = _reconciled(spark, sf).filter("status in ('lost', 'duplicated', 'unexpected')")
    return rows.select("partition", "offset", "status")


@check(
    f"""{WITH_LOG}
    SELECT "partition", "offset" FROM log
    WHERE NOT ("partition" = 0 AND "offset" < 100) AND NOT ("partition" = 1 AND "offset" >= 200)"""
)
def between_positions(spark: SparkSession, sf: str) -> DataFrame:
    """A bounded read from given offsets up to given offsets."""
    start = StartPosition.at_offsets({TOPIC: {0: 100}})
    end = StartPosition.at_offsets({TOPIC: {1: 200}})
    rows = read_log_batch(spark, log_config(spark, sf), start, end)
    return rows.select("partition", "offset")


_FIRST = """firsts AS (SELECT "partition" AS p, min("offset") AS "first" FROM log
      WHERE {time} >= TIMESTAMP '{at}' GROUP BY 1)"""
#: Record times far out of order: up to three days after the event.
SQL_SHUFFLED = "ts + to_seconds((event_id * 7919) % 259200)"


def _shuffled_config(spark: SparkSession, sf: str) -> LogConfig:
    """The log with such times."""

    def build(path: str) -> None:
        late = F.make_dt_interval(secs=(F.col("event_id") * 7919 % 259_200).cast("decimal(18,6)"))
        records = positioned_records(spark, sf, late)
        append_to_file_log(records, path)

    return LogConfig(TOPIC, format="parquet", path=once(spark, "shuffled-log", sf, build))


@check(
    f"""{WITH_LOG}, {_FIRST.format(time='kafka_timestamp', at='2024-01-15')}
    SELECT "partition", "offset" FROM log JOIN firsts ON p = "partition" WHERE "offset" >= "first\""""
)
def since_time(spark: SparkSession, sf: str) -> DataFrame:
    """A bounded read from a point in time: from the first offset of each partition that is as late."""
    start = StartPosition.at_time(1_705_276_800_000)
    return read_log_batch(spark, log_config(spark, sf), start).select("partition", "offset")


@check(
    f"""{WITH_LOG}, {_FIRST.format(time=SQL_SHUFFLED, at='2024-01-15')}
    SELECT "partition", "offset" FROM log JOIN firsts ON p = "partition" WHERE "offset" >= "first\""""
)
def since_time_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """Records after the start belong to the read, also those with earlier times."""
    start = StartPosition.at_time(1_705_276_800_000)
    return read_log_batch(spark, _shuffled_config(spark, sf), start).select("partition", "offset")


@check(
    f"""{WITH_LOG}, {_FIRST.format(time=SQL_SHUFFLED, at='2024-01-15')}
    SELECT "partition", "offset" FROM log LEFT JOIN firsts ON p = "partition"
    WHERE "first" IS NULL OR "offset" < "first\""""
)
def until_time_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """A read up to a time ends at the first record that is as late."""
    end = StartPosition.at_time(1_705_276_800_000)
    return read_log_batch(spark, _shuffled_config(spark, sf), end=end).select("partition", "offset")


@check(
    f"""{WITH_LOG}, {_FIRST.format(time=SQL_SHUFFLED, at='2024-01-15')},
    last AS (SELECT "partition", max("offset") + 1 AS "end" FROM log GROUP BY 1)
    SELECT CAST("partition" AS INTEGER) AS "partition", "first", "end" FROM last LEFT JOIN firsts ON p = "partition\""""
)
def offsets_by_time_index(spark: SparkSession, sf: str) -> DataFrame:
    """The same start looked up in a sparse index, which has been extended once and lags behind the log."""
    path = scratch_path(spark, "time-index")
    records = read_log_batch(spark, _shuffled_config(spark, sf))
    ends = {r["partition"]: r["end"] for r in end_offsets(records).collect()}
    for share in (3, 2):
        known = F.lit(False)
        for partition, end in ends.items():
            known = known | ((F.col("partition") == partition) & (F.col("offset") < end // share))
        extend_time_index(records.filter(known), path, width=64)
    return first_by_index(records, read_time_index(spark, path), 1_705_276_800_000).drop("topic")


@check(
    f"""{WITH_LOG} SELECT "partition", "offset", sensor AS sensor_type FROM log
    WHERE sensor = 'purchase'"""
)
def one_sensor(spark: SparkSession, sf: str) -> DataFrame:
    """One sensor's directories."""
    return only_sensor(curated(spark, sf), "purchase").select("partition", "offset", "sensor_type")
