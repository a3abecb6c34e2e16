"""Parsing, quality, windows."""

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
    log,
    sql_body,
    sql_round,
    table,
)
from lakestream.functions.columns import (
    celsius_to_fahrenheit,
    date_string,
    epoch_ms_to_iso,
    human_bytes,
    round_half_up,
    with_date_parts,
)
from lakestream.functions.payload import (
    decode,
    json_or_raw,
    parse_readings,
    parse_user_events,
    to_log_records,
    with_defaults,
)
from lakestream.operators import quality as q
from lakestream.operators.lake_queries import breakdown as sensor_breakdown
from lakestream.operators.lake_queries import preview
from lakestream.operators.windows import rollup_windows, window_bounds, window_report
from lakestream.plans.etl import flagged_readings as flagged
from lakestream.plans.etl import statistics

WITH_LOG = f"WITH {SQL_LOG}"
# the window a row falls into and its figures, at 4 places
SQL_WINDOWS = f"""
windows AS (
  SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
         time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
         sensor, avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value,
         count(*) AS event_count, count(*) FILTER (is_anomaly) AS anomaly_count
  FROM log GROUP BY ALL
)"""


@check(
    f"""{WITH_LOG}, {SQL_WINDOWS}
    SELECT window_start, window_end, sensor, {sql_round('avg_value', 4)} AS avg_value, min_value,
           max_value, event_count, anomaly_count FROM windows"""
)
def window_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Log to parsed, clean, flagged five-minute statistics."""
    windows = window_bounds(statistics(log(spark, sf), RULES))
    return windows.withColumn("avg_value", round_half_up(F.col("avg_value"), 4))


@check(
    f"""{WITH_LOG}, {SQL_WINDOWS}
    SELECT window_start, window_end, sensor, {sql_round('avg_value', 2)} AS avg,
           {sql_round('min_value', 2)} AS min, {sql_round('max_value', 2)} AS max,
           event_count, anomaly_count
    FROM windows ORDER BY window_start, sensor LIMIT 50"""
)
def window_report_head(spark: SparkSession, sf: str) -> DataFrame:
    return preview(window_report(statistics(log(spark, sf), RULES)), 50, "window_start", "sensor")


@check(
    f"""{WITH_LOG}, {SQL_WINDOWS}
    SELECT sensor, CAST(year(window_start) AS INTEGER) AS year,
           CAST(month(window_start) AS INTEGER) AS month, CAST(day(window_start) AS INTEGER) AS day,
           CAST(sum(event_count) AS BIGINT) AS record_count,
           {sql_round('sum(avg_value * event_count) / sum(event_count)', 3)} AS avg_value,
           {sql_round('min(min_value)', 3)} AS min_value, {sql_round('max(max_value)', 3)} AS max_value,
           CAST(sum(anomaly_count) AS BIGINT) AS anomaly_count,
           {sql_round('100.0::DOUBLE * sum(anomaly_count) / sum(event_count)', 2)} AS anomaly_pct
    FROM windows GROUP BY 1, 2, 3, 4"""
)
def window_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Days recomputed from the windows."""
    return rollup_windows(statistics(log(spark, sf), RULES))


@check(
    f"""{WITH_LOG}
    SELECT '{TOPIC}' AS topic, "partition", "offset", sensor AS key, kafka_timestamp AS "timestamp",
           value AS sent_value, device_id AS sent_device FROM log"""
)
def log_records(spark: SparkSession, sf: str) -> DataFrame:
    """Bounded scan with decoded keys and payloads."""
    return decode(log(spark, sf)).select(
        "topic",
        "partition",
        "offset",
        "key",
        "timestamp",
        F.get_json_object("value", "$.value").cast("double").alias("sent_value"),
        F.get_json_object("value", "$.device_id").alias("sent_device"),
    )


@check(
    f"""{WITH_LOG}
    SELECT sensor AS message_key, sensor, value, unit, device_id, event_time, "partition", "offset",
           kafka_timestamp FROM log"""
)
def parsed_readings(spark: SparkSession, sf: str) -> DataFrame:
    return parse_readings(log(spark, sf))


# which damaged payloads the typed parser keeps, and what value it reads
SQL_TYPED = f"""
typed AS (
  SELECT *, CASE WHEN event_id % 50 = 4 THEN 'radar' ELSE sensor END AS parsed_sensor,
         CASE event_id % 50 WHEN 7 THEN 999.9 WHEN 8 THEN 'NaN'::DOUBLE WHEN 13 THEN -500.5
              WHEN 17 THEN 'NaN'::DOUBLE WHEN 18 THEN 'Infinity'::DOUBLE
              ELSE value END AS parsed_value
  FROM log WHERE event_id % 50 NOT IN (0, 1, 2, 3, 5, 6, 9, 11, 12, 14, 15, 16)
)"""


@check(
    f"""{WITH_LOG}, {SQL_TYPED}
    SELECT parsed_sensor AS sensor, isnan(parsed_value) AS is_nan,
           CASE WHEN isnan(parsed_value) THEN 0 ELSE parsed_value END AS value,
           event_time, "partition", "offset" FROM typed"""
)
def clean_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged log: what survives the null filter. NaN does."""
    kept = q.drop_malformed(parse_readings(broken_log(spark, sf)))
    return kept.select(
        "sensor",
        F.isnan("value").alias("is_nan"),
        F.nanvl("value", F.lit(0.0)).alias("value"),
        "event_time",
        "partition",
        "offset",
    )


@check(
    f"""{WITH_LOG}, {SQL_TYPED}
    SELECT parsed_sensor AS sensor, parsed_value AS value, "partition", "offset"
    FROM typed WHERE NOT isnan(parsed_value) AND parsed_value BETWEEN -100 AND 2000"""
)
def range_gated(spark: SparkSession, sf: str) -> DataFrame:
    kept = q.drop_malformed(parse_readings(broken_log(spark, sf)))
    gated = q.in_range(kept, RULES.corrupt_below, RULES.corrupt_above)
    return gated.select("sensor", "value", "partition", "offset")


@check(
    f"""{WITH_LOG}, {SQL_TYPED}
    SELECT parsed_sensor AS sensor, "partition", "offset" FROM typed WHERE event_id % 50 <> 4"""
)
def known_sensors(spark: SparkSession, sf: str) -> DataFrame:
    kept = q.in_domain(q.drop_malformed(parse_readings(broken_log(spark, sf))), RULES)
    return kept.select("sensor", "partition", "offset")


@check(
    f"""{WITH_LOG}, {SQL_TYPED}
    SELECT parsed_sensor AS sensor, parsed_value AS value, "partition", "offset" FROM typed
    WHERE event_id % 50 NOT IN (4, 7, 8, 13, 17, 18)
      AND value BETWEEN 0 AND CASE sensor WHEN 'error' THEN 200 WHEN 'purchase' THEN 400 ELSE 500 END"""
)
def physically_possible(spark: SparkSession, sf: str) -> DataFrame:
    kept = q.in_physical_range(q.drop_malformed(parse_readings(broken_log(spark, sf))), RULES)
    return kept.select("sensor", "value", "partition", "offset")


@check(
    f"""{WITH_LOG}
    SELECT sensor, value, "partition", "offset", unit AS rule_unit,
           CASE sensor WHEN 'purchase' THEN 100.0::DOUBLE WHEN 'error' THEN 120.0::DOUBLE END
             AS anomaly_above
    FROM log"""
)
def rules_attached(spark: SparkSession, sf: str) -> DataFrame:
    """Rules as a table, joined by sensor."""
    rules = RULES.to_frame(spark).select("sensor", F.col("unit").alias("rule_unit"), "anomaly_above")
    rows = parse_readings(log(spark, sf)).select("sensor", "value", "partition", "offset")
    return q.attach_rules(rows, rules)


@check(
    f"""{WITH_LOG}
    SELECT sensor, value, event_time, "partition", "offset", is_anomaly FROM log"""
)
def flagged_readings(spark: SparkSession, sf: str) -> DataFrame:
    rows = flagged(log(spark, sf), RULES)
    return rows.select("sensor", "value", "event_time", "partition", "offset", "is_anomaly")


@check(
    f"""{WITH_LOG}
    SELECT device_id, value, "partition", "offset", value > user_id % 100 AS is_anomaly FROM log"""
)
def flagged_by_rules_table(spark: SparkSession, sf: str) -> DataFrame:
    """A rule for every device, and for a thousand and one that send nothing: rules as a table of any size."""
    events = table(spark, sf, "events")
    devices = events.select("user_id").distinct()
    limit = (F.col("user_id") % 100).cast("double").alias("anomaly_above")
    rules = devices.select(F.format_string("dev-%d", "user_id").alias("sensor"), limit)
    spare = spark.range(1001).select(F.format_string("spare-%d", "id").alias("sensor"), F.lit(0.0))
    rows = q.flag_anomalies(parse_readings(log(spark, sf)), rules.union(spare), "device_id")
    return rows.select("device_id", "value", "partition", "offset", "is_anomaly")


@check(
    f"""{WITH_LOG}, {SQL_TYPED}
    SELECT parsed_sensor AS sensor, "partition", "offset" FROM typed
    WHERE event_id % 50 NOT IN (4, 7, 8, 13, 17, 18)
      AND value BETWEEN 0 AND CASE sensor WHEN 'error' THEN 200 WHEN 'purchase' THEN 400 ELSE 500 END"""
)
def possible_by_rules_table(spark: SparkSession, sf: str) -> DataFrame:
    """Domain and physical range from a table."""
    rules = RULES.to_frame(spark)
    kept = q.in_domain(q.drop_malformed(parse_readings(broken_log(spark, sf))), rules)
    return q.in_physical_range(kept, rules).select("sensor", "partition", "offset")


@check(
    f"""{WITH_LOG}
    SELECT event_time, sensor, value, unit, device_id FROM log WHERE is_anomaly"""
)
def anomalies(spark: SparkSession, sf: str) -> DataFrame:
    rows = q.only_anomalies(flagged(log(spark, sf), RULES))
    return rows.select("event_time", "sensor", "value", "unit", "device_id")


@check(
    f"""{WITH_LOG}
    SELECT event_time, kafka_timestamp, sensor, value, unit, device_id FROM log
    ORDER BY kafka_timestamp DESC, "partition", "offset" LIMIT 20"""
)
def newest_records(spark: SparkSession, sf: str) -> DataFrame:
    """The report on the last 20 records to arrive."""
    rows = preview(
        flagged(log(spark, sf), RULES), 20, F.desc("kafka_timestamp"), "partition", "offset"
    )
    return rows.select("event_time", "kafka_timestamp", "sensor", "value", "unit", "device_id")


@check(
    f"""{WITH_LOG}
    SELECT sensor, count(*) AS total, count(*) FILTER (is_anomaly) AS anomalies FROM log GROUP BY 1"""
)
def breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return sensor_breakdown(flagged(log(spark, sf), RULES))


@check(
    f"""{WITH_LOG}
    SELECT "partition", "offset", sensor AS message_key, value, unit, device_id,
           'ALERT: HIGH ' || upper(sensor) || ' ' || printf('%.2f', value) || ' ' || unit AS message
    FROM log WHERE is_anomaly"""
)
def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return q.alerts(parse_readings(log(spark, sf)), RULES)


@check(
    f"""{WITH_LOG}
    SELECT "partition", "offset",
           CASE WHEN event_id % 50 IN (0, 11, 15) THEN 'missing_sensor,missing_value,missing_event_time'
                WHEN event_id % 50 IN (1, 9, 14) THEN
                  CASE event_id % 50 WHEN 1 THEN 'missing_value,missing_event_time'
                       ELSE 'missing_event_time' END
                WHEN event_id % 50 = 2 THEN 'missing_sensor,missing_event_time'
                WHEN event_id % 50 IN (3, 5, 6, 12, 16) THEN 'missing_value'
                WHEN event_id % 50 IN (8, 17) THEN 'not_a_number'
                ELSE 'out_of_range' END AS reasons
    FROM log WHERE event_id % 50 IN {REJECTED}"""
)
def quarantined(spark: SparkSession, sf: str) -> DataFrame:
    """The rejected side of the split, with every reason."""
    _, rejected = q.split_valid(parse_readings(broken_log(spark, sf)), RULES)
    return rejected.select("partition", "offset", F.array_join("reasons", ",").alias("reasons"))


@check(
    f"""{WITH_LOG}
    SELECT CASE WHEN event_id % 50 = 4 THEN 'radar' ELSE sensor END AS sensor, "partition", "offset"
    FROM log WHERE event_id % 50 NOT IN {REJECTED}"""
)
def accepted_by_split(spark: SparkSession, sf: str) -> DataFrame:
    """The good side of the split."""
    valid, _ = q.split_valid(parse_readings(broken_log(spark, sf)), RULES)
    return valid.select("sensor", "partition", "offset")


SQL_JUDGED = """
judged AS (
  SELECT *, event_id % 50 AS c,
         CASE event_id % 50 WHEN 12 THEN 1.0 WHEN 13 THEN -500.5 WHEN 7 THEN 999.9 ELSE value END AS number,
         CASE sensor WHEN 'error' THEN 200 WHEN 'purchase' THEN 400 ELSE 500 END AS high
  FROM log
), verdict AS (
  SELECT *, CASE WHEN c IN (0, 11, 14, 15, 17, 18) THEN 'not_json' WHEN c IN (1, 2) THEN 'missing_fields'
                 WHEN c = 4 THEN 'unknown_sensor' WHEN c IN (3, 5) THEN 'not_numeric'
                 WHEN c = 8 OR number NOT BETWEEN 0 AND high THEN 'out_of_range' END AS error
  FROM judged
)"""


@check(
    f"""{WITH_LOG}, {SQL_JUDGED}
    SELECT "partition", "offset", error,
           CAST(CASE WHEN error IS NULL THEN 201 WHEN error IN ('not_json', 'missing_fields') THEN 400
                ELSE 422 END AS INTEGER) AS status_code,
           CASE WHEN c = 1 THEN 'value' WHEN c = 2 THEN 'sensor'
                WHEN c IN (0, 11, 14, 15, 17, 18) THEN 'sensor,value' ELSE '' END AS missing
    FROM verdict"""
)
def validated_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged bodies judged as submitted to the API."""
    judged = q.validate_payloads(broken_log(spark, sf), RULES)
    return judged.select(
        "partition", "offset", "error", "status_code", F.array_join("missing", ",").alias("missing")
    )


@check(
    f"""{WITH_LOG}, {SQL_JUDGED}
    SELECT sensor, number AS value, '' AS unit, CAST(1700000000155 AS BIGINT) AS "timestamp",
           'api-v1' AS source, 'api' AS device_id
    FROM verdict WHERE error IS NULL"""
)
def accepted_submissions(spark: SparkSession, sf: str) -> DataFrame:
    """What the API would publish, at a fixed clock."""
    judged = q.validate_payloads(broken_log(spark, sf), RULES)
    return q.accepted_readings(judged, now_ms=F.lit(1_700_000_000_155).cast("bigint"))


@check(
    f"""WITH {SQL_LOG}
    SELECT "partition", "offset", event_id % 50 IN (0, 14, 15, 17, 18) AS is_raw,
           CASE WHEN event_id % 50 IN (0, 14, 15, 17, 18)
                THEN '{{"raw":"' || replace({sql_body()}, '"', '\\"') || '"}}' ELSE {sql_body()} END AS payload
    FROM log"""
)
def json_or_raw_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = json_or_raw(broken_log(spark, sf))
    return rows.select("partition", "offset", "is_raw", "payload")


@check(
    """SELECT 'user' || user_id AS message_key, event_type AS event, 'user' || user_id AS user_id,
              'sess_' || (user_id % 1000) AS session_id, ts AS event_ts,
              CASE WHEN event_type = 'purchase' THEN props END AS item,
              CASE WHEN event_type = 'purchase' THEN value END AS amount
       FROM events"""
)
def user_events(spark: SparkSession, sf: str) -> DataFrame:
    """User events published as JSON and parsed back; item and amount only where they were sent."""
    bought = F.col("event_type") == "purchase"
    sent = table(spark, sf, "events").select(
        F.concat(F.lit("user"), F.col("user_id")).alias("user_id"),
        F.col("event_type").alias("event"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("ts"),
        F.concat(F.lit("sess_"), F.col("user_id") % 1000).alias("session_id"),
        F.when(bought, F.col("props")).alias("item"),
        F.when(bought, F.col("value")).alias("amount"),
    )
    records = to_log_records(sent, "user_id", "user-events").withColumns(
        {"partition": F.lit(0), "offset": F.lit(0).cast("bigint")}
    )
    parsed = parse_user_events(records)
    return parsed.select("message_key", "event", "user_id", "session_id", "event_ts", "item", "amount")


@check(
    f"""{WITH_LOG}
    SELECT '{TOPIC}' AS topic, device_id AS key,
           '{{"sensor":"' || sensor || '","value":' || CAST(value AS VARCHAR) || ',"unit":"' || unit
             || '","timestamp":' || ms || ',"device_id":"' || device_id || '"}}' AS value
    FROM log"""
)
def published_records(spark: SparkSession, sf: str) -> DataFrame:
    """The shape of a keyed publish: key and value as text."""
    readings = parse_readings(log(spark, sf)).withColumn("timestamp", F.unix_millis("event_time"))
    fields = ["sensor", "value", "unit", "timestamp", "device_id"]
    records = to_log_records(readings, "device_id", TOPIC, fields)
    return records.select("topic", F.col("key").cast("string"), F.col("value").cast("string"))


@check(
    f"""{WITH_LOG}
    SELECT "partition", "offset", '' AS unit, 'api' AS device_id, 'api-v1' AS source,
           CAST(1700000000155 AS BIGINT) AS "timestamp" FROM log"""
)
def defaults_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads without unit and device, stamped with source and clock."""
    rows = parse_readings(broken_log(spark, sf)).select("partition", "offset", "unit", "device_id")
    return with_defaults(rows, "api", "api-v1", F.lit(1_700_000_000_155).cast("bigint"))


@check(
    """SELECT event_id,
              strftime(ts, '%Y-%m-%dT%H:%M:%S')
                || CASE WHEN epoch_us(ts) // 1000 % 1000 = 0 THEN ''
                        ELSE '.' || lpad(CAST(epoch_us(ts) // 1000 % 1000 AS VARCHAR), 3, '0') || '000' END
                || '+00:00' AS iso,
              strftime(ts, '%Y-%m-%d') AS date
       FROM events"""
)
def time_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Epoch milliseconds as ISO text, and dates put together from their parts."""
    rows = with_date_parts(table(spark, sf, "events"), "ts")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return rows.select(
        "event_id",
        epoch_ms_to_iso(ms).alias("iso"),
        date_string(F.col("year"), F.col("month"), F.col("day")).alias("date"),
    )


@check(
    """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
              CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS events
       FROM events GROUP BY 1, 2, 3, 4"""
)
def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = with_date_parts(table(spark, sf, "events"), "ts", "hour")
    return parts.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("events"))


@check(
    """SELECT size_text, count(*) AS lines FROM (
         SELECT CASE WHEN n < 1024 THEN printf('%.1f B', n::DOUBLE)
                     WHEN n < 1048576 THEN printf('%.1f KB', n / 1024.0::DOUBLE)
                     WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576.0::DOUBLE)
                     ELSE printf('%.1f GB', n / 1073741824.0::DOUBLE) END AS size_text
         FROM (SELECT l_orderkey * l_linenumber * 640 AS n FROM lineitem)) GROUP BY 1"""
)
def byte_texts(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("l_orderkey") * F.col("l_linenumber") * 640
    texts = table(spark, sf, "lineitem").select(human_bytes(size).alias("size_text"))
    return texts.groupBy("size_text").agg(F.count(F.lit(1)).alias("lines"))


@check(
    f"""{WITH_LOG}
    SELECT "partition", "offset", CASE WHEN unit = 'C' THEN 'F' ELSE unit END AS unit,
           {sql_round("CASE WHEN unit = 'C' THEN value * 1.8 + 32.0 ELSE value END", 4)} AS value
    FROM log"""
)
def fahrenheit(spark: SparkSession, sf: str) -> DataFrame:
    converted = celsius_to_fahrenheit(parse_readings(log(spark, sf)))
    return converted.select(
        "partition", "offset", "unit", round_half_up(F.col("value"), 4).alias("value")
    )
