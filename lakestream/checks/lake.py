"""Zones, gold, SQL over the views, file maintenance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.checks.fixture import (
    RULES,
    SQL_LOG,
    TOPIC,
    broken_log,
    check,
    compacted,
    curated,
    lake,
    log,
    sql_body,
    sql_pct,
    sql_round,
)
from lakestream.functions.columns import round_half_up
from lakestream.functions.folders import delete_folder
from lakestream.functions.payload import parse_readings
from lakestream.operators import drift, lake_audit, lake_queries
from lakestream.operators.lake_audit import partition_files
from lakestream.operators.log_audit import batch_stats
from lakestream.operators.quality import drop_malformed
from lakestream.plans import daily_parts
from lakestream.plans.lake import Lake, curated_readings
from lakestream.plans.lake import rebuild_curated as rebuild
from lakestream.plans.maintenance import compact, verify_compaction, zone_as_written
from lakestream.schemas import (
    CURATED_PARTITIONS,
    CURATED_ZONE,
    GOLD_ZONE,
    RAW_PARTITIONS,
    RAW_ZONE,
    SensorRule,
    SensorRules,
)
from lakestream.session import scratch_path
from lakestream.sinks.batch import write_batch, write_gold, write_raw, write_verified
from lakestream.sources.zones import read_or_empty, read_zone, register_views, replay_raw
from lakestream.streaming.writers import raw_zone_rows, write_batch_once

WITH_LOG = f"WITH {SQL_LOG}"
SENSOR = "purchase"
AS_OF = dt.date(2024, 1, 30)


def _stats(digits: int) -> str:
    return f"""count(*) AS record_count, {sql_round('avg(value)', digits)} AS avg_value,
      {sql_round('min(value)', digits)} AS min_value, {sql_round('max(value)', digits)} AS max_value,
      count(*) FILTER (is_anomaly) AS anomaly_count,
      {sql_pct('count(*) FILTER (is_anomaly)', 'count(*)')} AS anomaly_pct"""


SQL_DAILY = f"SELECT sensor AS sensor_type, year, month, day, {_stats(3)} FROM log"


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, year, month, day, value, unit, device_id, event_time, "partition",
           "offset", is_anomaly FROM log"""
)
def curated_zone(spark: SparkSession, sf: str) -> DataFrame:
    """Silver read back through partition discovery."""
    return read_zone(spark, lake(spark, sf, "curated").curated).drop("source")


@check(f"{WITH_LOG} {SQL_DAILY} GROUP BY 1, 2, 3, 4")
def daily_stats(spark: SparkSession, sf: str) -> DataFrame:
    return lake_queries.daily_stats(curated(spark, sf))


@check(f"{WITH_LOG} {SQL_DAILY} GROUP BY 1, 2, 3, 4")
def gold_zone(spark: SparkSession, sf: str) -> DataFrame:
    """Gold as it was written."""
    return read_zone(spark, lake(spark, sf, "gold").gold, GOLD_ZONE)


@check(
    f"""{WITH_LOG}, corrected AS (SELECT * FROM log WHERE sensor <> '{SENSOR}' OR value <= 50)
    {SQL_DAILY.replace('FROM log', 'FROM corrected')} GROUP BY 1, 2, 3, 4"""
)
def gold_rebuilt_for_one_sensor(spark: SparkSession, sf: str) -> DataFrame:
    """Rebuilding one sensor from corrected readings replaces its figures and leaves the others."""
    path = scratch_path(spark, "gold")
    write_gold(lake_queries.daily_stats(curated(spark, sf)), path)
    corrected = curated(spark, sf).filter("value <= 50")
    write_gold(lake_queries.daily_stats(corrected, SENSOR), path, SENSOR)
    return read_zone(spark, path, GOLD_ZONE)


@check(
    f"""{WITH_LOG}, days AS (SELECT 'all' AS rebuilt, * FROM log WHERE day > 10
                             UNION ALL SELECT 'one' AS rebuilt, * FROM log WHERE day > 10 OR sensor <> '{SENSOR}')
    SELECT rebuilt, sensor AS sensor_type, year, month, day, {_stats(3)} FROM days GROUP BY 1, 2, 3, 4, 5"""
)
def gold_after_correction(spark: SparkSession, sf: str) -> DataFrame:
    """Gold built, a third of every month withdrawn from silver, and gold built again: for all sensors, and
    for one. Days that silver no longer has are gone, where they were rebuilt."""
    zone = curated(spark, sf).withColumn("month", F.col("month") * 100 + F.expr("(day - 1) div 10"))
    corrected = zone.filter("day > 10")
    parts = []
    for rebuilt, sensor in (("all", None), ("one", SENSOR)):
        path = scratch_path(spark, "gold")
        write_gold(lake_queries.daily_stats(zone), path)
        write_gold(lake_queries.daily_stats(corrected, sensor), path, sensor)
        gold = read_zone(spark, path, GOLD_ZONE).withColumn("month", F.expr("month div 100"))
        parts.append(gold.withColumn("month", F.col("month").cast("int")).withColumn("rebuilt", F.lit(rebuilt)))
    return parts[0].unionByName(parts[1])


@check(
    f"""{WITH_LOG}, corrected AS (
      SELECT * FROM log WHERE sensor <> '{SENSOR}' OR day NOT BETWEEN 10 AND 12 OR value <= 50)
    {SQL_DAILY.replace('FROM log', 'FROM corrected')} GROUP BY 1, 2, 3, 4"""
)
def gold_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Gold from the figures of three batches, after readings of one sensor on three days have been withdrawn from
    all of them: only those days are computed anew."""
    made, parts = Lake(scratch_path(spark, "lake"), TOPIC), scratch_path(spark, "parts")
    rows = curated_readings(log(spark, sf), RULES)
    for b in range(3):
        part = F.col("offset") % 3 == b
        write_batch_once(rows.filter(part), made.curated, b, CURATED_PARTITIONS)
        daily_parts.add_batches(spark, made, parts)
    sound = (F.col("sensor_type") != SENSOR) | ~F.col("day").between(10, 12) | (F.col("value") <= 50)
    for b in range(3):
        write_batch_once(rows.filter((F.col("offset") % 3 == b) & sound), made.curated, b, CURATED_PARTITIONS)
    days = [(SENSOR, dt.date(2024, 1, d)) for d in (10, 11, 12)]
    daily_parts.correct_days(spark, made, parts, days)
    return daily_parts.read_gold_parts(spark, parts)


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, count(*) AS total_records, {sql_round('avg(value)', 2)} AS overall_avg,
           {sql_round('min(value)', 2)} AS overall_min, {sql_round('max(value)', 2)} AS overall_max,
           count(*) FILTER (is_anomaly) AS total_anomalies FROM log GROUP BY 1"""
)
def sensor_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return lake_queries.sensor_comparison(curated(spark, sf))


_DAY_REPORT = f"""{sql_round('avg(value)', 2)} AS avg_value, {sql_round('min(value)', 2)} AS min_value,
  {sql_round('max(value)', 2)} AS max_value, count(*) AS total_records,
  count(*) FILTER (is_anomaly) AS anomalies"""


@check(
    f"""{WITH_LOG} SELECT sensor AS sensor_type, year, month, day, {_DAY_REPORT}
    FROM log WHERE sensor = '{SENSOR}' GROUP BY 1, 2, 3, 4"""
)
def sql_day_report(spark: SparkSession, sf: str) -> DataFrame:
    """Daily figures of one sensor, as SQL with a bound argument."""
    zones = lake(spark, sf, "curated", "gold")
    register_views(spark, zones.curated, zones.gold)
    return lake_queries.run_sql(spark, "day_report", sensor=SENSOR)


@check(
    f"""{WITH_LOG} SELECT sensor AS sensor_type, day, {_DAY_REPORT}
    FROM log WHERE sensor = '{SENSOR}' GROUP BY 1, 2"""
)
def day_of_month_report(spark: SparkSession, sf: str) -> DataFrame:
    return lake_queries.day_report(curated(spark, sf), SENSOR, by_day_of_month=True)


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, count(*) AS total, count(*) FILTER (is_anomaly) AS anomalies,
           {sql_pct('count(*) FILTER (is_anomaly)', 'count(*)')} AS anomaly_pct
    FROM log GROUP BY 1"""
)
def sql_anomaly_shares(spark: SparkSession, sf: str) -> DataFrame:
    register_views(spark, lake(spark, sf, "curated").curated)
    return lake_queries.run_sql(spark, "anomaly_shares")


@check(
    f"""{WITH_LOG}
    SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, {sql_round('avg(value)', 2)} AS avg_value,
           count(*) AS readings FROM log WHERE sensor = '{SENSOR}' GROUP BY 1"""
)
def sql_hourly_trend(spark: SparkSession, sf: str) -> DataFrame:
    register_views(spark, lake(spark, sf, "curated").curated)
    return lake_queries.run_sql(spark, "hourly_trend", sensor=SENSOR)


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, {sql_round('avg(value)', 2)} AS mean,
           {sql_round('stddev_samp(value)', 2)} AS std_dev, {sql_round('min(value)', 2)} AS p0,
           {sql_round('max(value)', 2)} AS p100, count(*) AS n FROM log GROUP BY 1"""
)
def sql_sensor_spread(spark: SparkSession, sf: str) -> DataFrame:
    register_views(spark, lake(spark, sf, "curated").curated)
    return lake_queries.run_sql(spark, "sensor_spread")


@check(
    f"""{WITH_LOG}
    SELECT count(*) AS all_rows, count(*) FILTER (sensor = '{SENSOR}') AS sensor_rows FROM log"""
)
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lake_queries.row_counts(curated(spark, sf), SENSOR)


@check(
    f"""{WITH_LOG}
    SELECT strftime(ts, '%Y-%m-%d') AS date, '{SENSOR}' AS sensor_type, {_stats(3)}
    FROM log WHERE sensor = '{SENSOR}' AND ts::DATE >= DATE '{AS_OF}' - 7 GROUP BY 1"""
)
def sensor_stats_days(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics endpoint: one sensor, the last seven days, newest first."""
    return lake_queries.sensor_stats(curated(spark, sf), SENSOR, 7, AS_OF)


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, "partition", "offset" FROM log WHERE ts::DATE >= DATE '{AS_OF}' - 3"""
)
def recent_readings(spark: SparkSession, sf: str) -> DataFrame:
    rows = lake_queries.last_days(curated(spark, sf), 3, AS_OF)
    return rows.select("sensor_type", "partition", "offset")


@check(f"{WITH_LOG} SELECT DISTINCT sensor AS sensor_type FROM log")
def sensor_types(spark: SparkSession, sf: str) -> DataFrame:
    return lake_queries.sensor_types(spark, lake(spark, sf, "curated").curated, RULES.sensors)


@check(
    f"""{WITH_LOG}
    SELECT sensor, value, unit, device_id, event_time, "partition", "offset",
           date_trunc('milliseconds', kafka_timestamp) AS kafka_timestamp FROM log"""
)
def raw_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Readings parsed again from the raw zone's JSON, which keeps arrival times to the millisecond."""
    zones = lake(spark, sf, "raw")
    return drop_malformed(parse_readings(replay_raw(spark, zones.raw, zones.topic))).drop("message_key")


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, year, month, day, count(*) AS readings,
           count(*) FILTER (CASE sensor WHEN 'view' THEN value > 50 ELSE false END) AS anomalies
    FROM log WHERE value <= 400 GROUP BY 1, 2, 3, 4"""
)
def curated_rebuilt(spark: SparkSession, sf: str) -> DataFrame:
    """Silver reprocessed from bronze under other rules."""
    stricter = SensorRules((SensorRule("view", "u", 50.0),), corrupt_above=400.0)
    zone = rebuild(spark, lake(spark, sf, "raw"), scratch_path(spark, "rebuilt"), stricter)
    return zone.groupBy("sensor_type", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("readings"), F.count_if("is_anomaly").alias("anomalies")
    )


@check(
    f"""{WITH_LOG}
    SELECT count(DISTINCT (sensor, year, month, day)) AS after_files, true AS fewer,
           count(*) AS same_rows FROM log"""
)
def compaction(spark: SparkSession, sf: str) -> DataFrame:
    """A zone three writers have appended to, compacted to one file per directory, rows unchanged."""
    source, target = scratch_path(spark, "scattered"), scratch_path(spark, "compacted")
    for partition in range(3):
        rows = curated(spark, sf).filter(F.col("partition") == partition)
        rows.write.mode("append").partitionBy(*CURATED_PARTITIONS).parquet(source)
    report = compact(spark, source, target)
    rows = verify_compaction(spark, source, target)
    return report.select(
        "after_files",
        (F.col("after_files") < F.col("before_files")).alias("fewer"),
        F.lit(rows).cast("bigint").alias("same_rows"),
    )


@check(
    f"""{WITH_LOG}
    SELECT count(DISTINCT (sensor, year, month, day)) AS full_files,
           count(DISTINCT (sensor, year, month, day)) FILTER (sensor = '{SENSOR}') AS pruned_files,
           count(*) AS full_rows, count(*) FILTER (sensor = '{SENSOR}') AS pruned_rows,
           true AS partition_filter FROM log"""
)
def pruning(spark: SparkSession, sf: str) -> DataFrame:
    """Files opened for everything and for one sensor."""
    zone = read_zone(spark, compacted(spark, sf), CURATED_ZONE)
    report = lake_audit.pruning_report(zone, zone.filter(F.col("sensor_type") == SENSOR))
    return report.select("full_files", "pruned_files", "full_rows", "pruned_rows", "partition_filter")


@check(
    f"""{WITH_LOG}
    SELECT 'curated' AS zone, 'parquet' AS kind, count(DISTINCT (sensor, year, month, day)) AS files,
           true AS small_files FROM log"""
)
def inventory(spark: SparkSession, sf: str) -> DataFrame:
    """File counts per zone; at test scale the files are many and small."""
    files = lake_audit.file_inventory(spark, {"curated": compacted(spark, sf)})
    return lake_audit.inventory_summary(files).select("zone", "kind", "files", "small_files")


@check(
    f"""{WITH_LOG}, files AS (SELECT DISTINCT sensor, year, month, day FROM log), dirs AS (
      SELECT unnest(['sensor_type=' || sensor,
                     'sensor_type=' || sensor || '/year=' || year,
                     'sensor_type=' || sensor || '/year=' || year || '/month=' || month]) AS directory
      FROM files)
    SELECT directory, count(*) AS files FROM dirs GROUP BY 1"""
)
def directory_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Files below every directory down to the month."""
    files = lake_audit.file_inventory(spark, {"curated": compacted(spark, sf)})
    return lake_audit.dir_rollup(files, max_depth=3).select("directory", "files")


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, count(*) AS readings, count(*) FILTER (sensor = '{SENSOR}') AS with_firmware
    FROM log GROUP BY 1"""
)
def evolved_zone(spark: SparkSession, sf: str) -> DataFrame:
    """Old files lack a column that new files have; it reads as null."""
    path = scratch_path(spark, "evolved")
    rows = curated(spark, sf).select("sensor_type", "value", "event_time")
    newer = F.col("sensor_type") == SENSOR
    write_batch(rows.filter(~newer), f"{path}/generation=1")
    write_batch(rows.filter(newer).withColumn("firmware", F.lit("1.2")), f"{path}/generation=2")
    return (
        read_zone(spark, path, merge_schema=True)
        .groupBy("sensor_type")
        .agg(F.count(F.lit(1)).alias("readings"), F.count("firmware").alias("with_firmware"))
    )


@check(f"""{WITH_LOG} SELECT sensor, value, "partition", "offset" FROM log""")
def verified_write(spark: SparkSession, sf: str) -> DataFrame:
    """Written, read back and compared before it is used."""
    path = scratch_path(spark, "verified")
    rows = parse_readings(log(spark, sf)).select("sensor", "value", "partition", "offset")
    write_verified(rows, path)
    return spark.read.parquet(path)


@check(
    f"""{WITH_LOG}
    SELECT CAST(year(kafka_timestamp) AS INTEGER) AS year, CAST(month(kafka_timestamp) AS INTEGER) AS month,
           CAST(day(kafka_timestamp) AS INTEGER) AS day, CAST(hour(kafka_timestamp) AS INTEGER) AS hour,
           "partition" AS kafka_partition, "offset" AS kafka_offset, sensor AS message_key,
           {sql_body()} AS raw_json FROM log"""
)
def raw_zone(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze of the damaged log: every payload kept, in the hour it arrived."""
    path = scratch_path(spark, "raw")
    write_raw(raw_zone_rows(broken_log(spark, sf)), path)
    zone = read_or_empty(spark, path, RAW_ZONE, "json")
    key = F.col("message_key").cast("string").alias("message_key")
    return zone.select(*RAW_PARTITIONS, "kafka_partition", "kafka_offset", key, "raw_json")


@check(
    f"""{WITH_LOG}
    SELECT "partition", "offset", sensor AS key,
           upper(hex(CASE WHEN "offset" % 7 = 0 THEN from_hex('FF00FE') ELSE encode({sql_body()}) END)) AS bytes
    FROM log"""
)
def raw_bytes_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Keys and payloads come back from bronze byte for byte, undecodable ones too."""
    path = scratch_path(spark, "raw")
    odd = F.when(F.col("offset") % 7 == 0, F.unhex(F.lit("FF00FE"))).otherwise(F.col("value"))
    write_raw(raw_zone_rows(broken_log(spark, sf).withColumn("value", odd)), path)
    rows = replay_raw(spark, path)
    return rows.select("partition", "offset", F.col("key").cast("string").alias("key"), F.hex("value").alias("bytes"))


@check(
    f"""{WITH_LOG}
    SELECT "partition", "offset" // 50 AS chunk, sensor, count(*) AS count,
           {sql_round('min(value)', 2)} AS min, {sql_round('max(value)', 2)} AS max,
           {sql_round('avg(value)', 2)} AS avg FROM log GROUP BY 1, 2, 3"""
)
def batch_stats_of_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed statistics over a replay of bronze equal those over the log."""
    zones = lake(spark, sf, "raw")
    return batch_stats(parse_readings(replay_raw(spark, zones.raw, zones.topic)))


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, count(*) AS total, count(*) FILTER (is_anomaly) AS anomalies,
           {sql_pct('count(*) FILTER (is_anomaly)', 'count(*)')} AS anomaly_pct
    FROM log GROUP BY 1"""
)
def anomaly_shares(spark: SparkSession, sf: str) -> DataFrame:
    return lake_queries.anomaly_shares(curated(spark, sf))


@check(
    f"""{WITH_LOG}
    SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, {sql_round('avg(value)', 2)} AS avg_value,
           count(*) AS readings FROM log WHERE sensor = '{SENSOR}' GROUP BY 1"""
)
def hourly_trend(spark: SparkSession, sf: str) -> DataFrame:
    return lake_queries.hourly_trend(curated(spark, sf), SENSOR)


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, {sql_round('avg(value)', 2)} AS mean,
           {sql_round('stddev_samp(value)', 2)} AS std_dev, {sql_round('min(value)', 2)} AS p0,
           {sql_round('max(value)', 2)} AS p100, count(*) AS n FROM log GROUP BY 1"""
)
def sensor_spread(spark: SparkSession, sf: str) -> DataFrame:
    return lake_queries.sensor_spread(curated(spark, sf))


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, year, month, day, value, "partition", "offset",
           CASE WHEN "partition" = 2 THEN '1.' || "offset" END AS firmware FROM log"""
)
def compaction_evolved(spark: SparkSession, sf: str) -> DataFrame:
    """Compaction keeps a column that only the newer files have, and the check would see its loss."""
    source, target = scratch_path(spark, "evolving"), scratch_path(spark, "compacted")
    rows = curated(spark, sf).select(*CURATED_PARTITIONS, "value", "partition", "offset")
    newer = rows.filter("partition = 2").withColumn("firmware", F.concat(F.lit("1."), F.col("offset")))
    for part in (rows.filter("partition < 2"), newer):
        part.write.mode("append").partitionBy(*CURATED_PARTITIONS).parquet(source)
    compact(spark, source, target)
    verify_compaction(spark, source, target, exact=True)
    kept = zone_as_written(spark, target)
    return kept.withColumns({c: F.col(c).cast("int") for c in ("year", "month", "day")})


@check(
    f"""{WITH_LOG}
    SELECT lpad(CAST(user_id % 5 AS VARCHAR), 3, '0') AS sensor_type, count(*) AS readings,
           {sql_round('sum(value)', 3)} AS total FROM log GROUP BY 1"""
)
def compaction_text_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Sensors named 000 to 004 keep their names."""
    source, target = scratch_path(spark, "numbered"), scratch_path(spark, "compacted")
    user = F.substring_index("device_id", "-", -1).cast("bigint")
    named = curated(spark, sf).withColumn("sensor_type", F.lpad((user % 5).cast("string"), 3, "0"))
    named.write.partitionBy(*CURATED_PARTITIONS).parquet(source)
    compact(spark, source, target)
    verify_compaction(spark, source, target)
    sensors = lake_queries.sensor_types(spark, target)
    rows = zone_as_written(spark, target).join(sensors, "sensor_type")
    return rows.groupBy("sensor_type").agg(
        F.count(F.lit(1)).alias("readings"), round_half_up(F.sum("value"), 3).alias("total")
    )


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, year, month, day, "partition", "offset" FROM log
    WHERE NOT (sensor = '{SENSOR}' AND day <= 10)"""
)
def compaction_partial_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """One sensor compacted again after days were withdrawn from it: they leave the target too, and the
    check compares the selected part."""
    source, target = scratch_path(spark, "corrected"), scratch_path(spark, "compacted")
    rows = curated(spark, sf).select(*CURATED_PARTITIONS, "partition", "offset")
    rows.write.partitionBy(*CURATED_PARTITIONS).parquet(source)
    compact(spark, source, target)
    withdrawn = (F.col("sensor_type") == SENSOR) & (F.col("day") <= 10)
    folders = partition_files(spark, source, paths=True).filter(withdrawn)
    for row in folders.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).distinct().collect():
        delete_folder(spark, row.folder)
    one = F.col("sensor_type") == SENSOR
    compact(spark, source, target, where=one)
    verify_compaction(spark, source, target, one)
    verify_compaction(spark, source, target)
    kept = zone_as_written(spark, target)
    return kept.withColumns({c: F.col(c).cast("int") for c in ("year", "month", "day")})


@check(f"""{WITH_LOG} SELECT sensor AS sensor_type, day, device_id, event_time, value, "partition", "offset" FROM log""")
def clustered_zone(spark: SparkSession, sf: str) -> DataFrame:
    """The curated zone compacted with its rows in Z-order of device and time."""
    target = scratch_path(spark, "clustered")
    source = lake(spark, sf, "curated").curated
    compact(spark, source, target, cluster_by=("device_id", "event_time"))
    verify_compaction(spark, source, target)
    zone = read_zone(spark, target, CURATED_ZONE)
    return zone.select("sensor_type", "day", "device_id", "event_time", "value", "partition", "offset")


@check(
    f"""{WITH_LOG}, texts AS (SELECT CAST(day(kafka_timestamp) AS INTEGER) AS day, {sql_body()} AS body FROM log
      WHERE event_id % 50 NOT IN (17, 18)),  -- bare NaN and Infinity, which DuckDB takes for JSON
    objects AS (SELECT day, body FROM texts WHERE json_valid(body) AND json_type(body) = 'OBJECT'),
    fields AS (SELECT day, body, unnest(json_keys(body)) AS field FROM objects),
    found AS (
      SELECT day, field, CASE json_type(body, '$.' || field) WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean'
             WHEN 'DOUBLE' THEN 'number' WHEN 'NULL' THEN 'null' ELSE 'integer' END AS found, count(*) AS payloads
      FROM fields GROUP BY ALL),
    wanted AS (
      SELECT * FROM (VALUES ('sensor', ['text', 'null']), ('value', ['number', 'integer', 'null']), ('unit', ['text', 'null']),
        ('timestamp', ['integer', 'null']), ('device_id', ['text', 'null'])) t(field, taken))
    SELECT day, field, CASE WHEN taken IS NULL THEN 'added' ELSE 'retyped' END AS drift, found, payloads
    FROM found LEFT JOIN wanted USING (field) WHERE taken IS NULL OR NOT list_contains(taken, found)
    UNION ALL
    SELECT day, field, 'missing', NULL, n - coalesce(held, 0) FROM (SELECT day, count(*) AS n FROM objects GROUP BY 1), wanted
    LEFT JOIN (SELECT day AS d, field AS f, sum(payloads)::BIGINT AS held FROM found GROUP BY 1, 2) ON d = day AND f = field
    WHERE n > coalesce(held, 0)"""
)
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """What the damaged payloads hold that the readers do not expect, by day."""
    rows = broken_log(spark, sf).withColumn("raw_json", F.col("value").cast("string"))
    return drift.schema_drift(rows.withColumn("day", F.dayofmonth("timestamp")), ["day"])
