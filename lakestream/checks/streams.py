"""The streaming operators, each run over the whole log until nothing is left, then read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.checks.etl import SQL_WINDOWS
from lakestream.checks.fixture import (
    REJECTED,
    RULES,
    SQL_LOG,
    TOPIC,
    broken_config,
    check,
    event_ids,
    log,
    log_config,
    log_path,
    once,
    sql_body,
    sql_pct,
    sql_round,
)
from lakestream.functions.columns import round_half_up
from lakestream.functions.payload import parse_readings
from lakestream.operators.lake_audit import list_files, partition_files
from lakestream.operators.log_audit import dedupe_log
from lakestream.operators.windows import window_bounds
from lakestream.plans.etl import flagged_readings, run_etl, statistics
from lakestream.plans.lake import Lake, build_gold, read_lake, run_lake
from lakestream.plans.maintenance import compact_batches, expire_batches
from lakestream.schemas import CURATED_PARTITIONS, RAW_ZONE
from lakestream.session import scratch_path, streaming_session
from lakestream.sinks.batch import write_batch
from lakestream.sources.batches import layout, range_folder
from lakestream.sources.log import LogConfig, read_log_stream
from lakestream.sources.zones import read_or_empty, read_stream_output
from lakestream.streaming import late, latest, seen, writers
from lakestream.streaming.supervise import ProgressTotals, run_queries, window_state

WITH_LOG = f"WITH {SQL_LOG}"


@check(
    f"""{WITH_LOG}, {SQL_WINDOWS}
    SELECT window_start, window_end, sensor, {sql_round('avg_value', 4)} AS avg_value, min_value,
           max_value, event_count, anomaly_count
    FROM windows WHERE window_end <= (SELECT max(ts) - INTERVAL '2 minutes' FROM events)"""
)
def window_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Append mode emits exactly the windows the watermark has closed."""
    root = scratch_path(spark, "etl")
    run_etl(streaming_session(spark), log_config(spark, sf), root, RULES, trigger=None)
    windows = window_bounds(read_stream_output(spark, f"{root}/windows"))
    return windows.withColumn("avg_value", round_half_up(F.col("avg_value"), 4))


@check(
    f"""{WITH_LOG}
    SELECT sensor, value, event_time, "partition", "offset", is_anomaly FROM log"""
)
def flagged_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The dual write: readings next to the statistics."""
    root = scratch_path(spark, "etl")
    session = streaming_session(spark)
    run_etl(session, log_config(spark, sf), root, RULES, keep_readings=True, trigger=None)
    rows = read_stream_output(spark, f"{root}/readings")
    return rows.select("sensor", "value", "event_time", "partition", "offset", "is_anomaly")


def _in_four_batches(spark: SparkSession, sf: str) -> LogConfig:
    """The log cut into about four micro-batches, however large it is."""
    files = list_files(spark, log_path(spark, sf)).count()
    return log_config(spark, sf, max_files_per_batch=max(1, -(-files // 4)))


def _streamed_lake(spark: SparkSession, sf: str) -> Lake:
    """Raw and curated zones fed from the damaged log."""
    config = broken_config(spark, sf)

    def build(root: str) -> None:
        run_lake(streaming_session(spark), config, Lake(root), RULES, trigger=None)

    return Lake(once(spark, "streamed-lake", sf, build))


@check(
    f"""{WITH_LOG}
    SELECT "partition" AS kafka_partition, "offset" AS kafka_offset, {sql_body()} AS raw_json,
           sensor AS message_key, CAST(hour(kafka_timestamp) AS INTEGER) AS hour FROM log"""
)
def raw_zone_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze keeps every payload, good or not."""
    zone = read_or_empty(spark, _streamed_lake(spark, sf).raw, RAW_ZONE, "json")
    key = F.col("message_key").cast("string").alias("message_key")
    return zone.select("kafka_partition", "kafka_offset", "raw_json", key, "hour")


@check(
    f"""{WITH_LOG}
    SELECT CASE WHEN event_id % 50 = 4 THEN 'radar' ELSE sensor END AS sensor_type, year, month, day,
           CASE event_id % 50 WHEN 7 THEN 999.9 ELSE value END AS value, "partition", "offset",
           CASE event_id % 50 WHEN 4 THEN false WHEN 7 THEN sensor IN ('purchase', 'error')
                ELSE is_anomaly END AS is_anomaly
    FROM log WHERE event_id % 50 NOT IN {REJECTED}"""
)
def curated_zone_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Silver keeps what parses and is in range."""
    zone = read_lake(spark, _streamed_lake(spark, sf))
    return zone.select(
        "sensor_type", "year", "month", "day", "value", "partition", "offset", "is_anomaly"
    )


@check(
    f"""{WITH_LOG}
    SELECT event_id % 50 IN {REJECTED} AS rejected, "partition", "offset",
           CASE WHEN event_id % 50 IN (0, 11, 15) THEN 'missing_sensor,missing_value,missing_event_time'
                WHEN event_id % 50 IN (9, 14) THEN 'missing_event_time'
                WHEN event_id % 50 = 1 THEN 'missing_value,missing_event_time'
                WHEN event_id % 50 = 2 THEN 'missing_sensor,missing_event_time'
                WHEN event_id % 50 IN (3, 5, 6, 12, 16) THEN 'missing_value'
                WHEN event_id % 50 IN (8, 17) THEN 'not_a_number'
                WHEN event_id % 50 IN (13, 18) THEN 'out_of_range' ELSE '' END AS reasons,
           CASE WHEN event_id % 50 IN (0, 1, 3, 5, 6, 8, 11, 12, 15, 16, 17, 18) THEN NULL
                WHEN event_id % 50 = 7 THEN 999.9 WHEN event_id % 50 = 13 THEN -500.5 ELSE value END AS finite_value
    FROM log"""
)
def dead_letter_stream(spark: SparkSession, sf: str) -> DataFrame:
    """One scan, good and rejected rows to two tables."""
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "rejected")
    readings = parse_readings(read_log_stream(streaming_session(spark), broken_config(spark, sf)))
    writers.write_split(
        readings, good, bad, scratch_path(spark, "checkpoint"), RULES, None
    ).awaitTermination()
    sides = [
        spark.read.parquet(path).select(
            F.lit(flag).alias("rejected"),
            "partition",
            "offset",
            F.array_join("reasons", ",").alias("reasons") if flag else F.lit("").alias("reasons"),
            F.when(F.abs("value") < float("inf"), F.col("value")).alias("finite_value"),
        )
        for path, flag in ((good, False), (bad, True))
    ]
    return sides[0].unionByName(sides[1])


@check(
    f"""{WITH_LOG}
    SELECT "partition", "offset" // 50 AS chunk, sensor, count(*) AS count,
           {sql_round('min(value)', 2)} AS min, {sql_round('max(value)', 2)} AS max,
           {sql_round('avg(value)', 2)} AS avg FROM log GROUP BY 1, 2, 3"""
)
def batch_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk statistics of a stream; one batch takes the whole log here."""
    path = scratch_path(spark, "stats")
    return _streamed_chunks(spark, log_config(spark, sf), path, scratch_path(spark, "checkpoint"))


def _streamed_chunks(spark: SparkSession, config: LogConfig, path: str, checkpoint: str) -> DataFrame:
    readings = parse_readings(read_log_stream(streaming_session(spark), config))
    writers.stream_batch_stats(readings, path, checkpoint, trigger=None).awaitTermination()
    return writers.read_batch_stats(spark.read.parquet(path))


@check(
    f"""{WITH_LOG}
    SELECT "partition", "offset" // 50 AS chunk, sensor, count(*) AS count,
           {sql_round('min(value)', 2)} AS min, {sql_round('max(value)', 2)} AS max,
           {sql_round('avg(value)', 2)} AS avg, true AS cut_somewhere FROM log GROUP BY 1, 2, 3"""
)
def batch_stats_many_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same chunks from micro-batches that cut them: every batch has some of each chunk's records."""
    folder, path = scratch_path(spark, "cut"), scratch_path(spark, "stats")
    checkpoint = scratch_path(spark, "checkpoint")
    config = LogConfig(TOPIC, format="parquet", path=folder)
    for part in range(4):
        log(spark, sf).filter(F.col("offset") % 4 == part).write.mode("append").parquet(folder)
        found = _streamed_chunks(spark, config, path, checkpoint)
    batches = spark.read.parquet(path).select("ingest_batch").distinct().count()
    return found.withColumn("cut_somewhere", F.lit(batches == 4))


@check(
    f"""{WITH_LOG}
    SELECT sensor, value, unit, device_id, event_time, "partition", "offset" FROM log
    QUALIFY row_number() OVER (PARTITION BY sensor
      ORDER BY ms DESC, "partition" DESC, "offset" DESC) = 1"""
)
def latest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The maintained view, fed in several micro-batches."""
    path = scratch_path(spark, "latest")
    config = _in_four_batches(spark, sf)
    readings = parse_readings(read_log_stream(streaming_session(spark), config))
    writers.maintain_latest(
        readings, path, scratch_path(spark, "checkpoint"), None
    ).awaitTermination()
    return writers.read_latest(spark.read.parquet(path))


@check(f"""{WITH_LOG} SELECT "partition", "offset", sensor, is_anomaly FROM log""")
def idempotent_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Micro-batches written by id, and one of them delivered again."""
    path, checkpoint = scratch_path(spark, "once"), scratch_path(spark, "checkpoint")
    config = _in_four_batches(spark, sf)
    rows = flagged_readings(read_log_stream(streaming_session(spark), config), RULES)
    writers.foreach_batch_once(rows, path, checkpoint, None).awaitTermination()
    copy = scratch_path(spark, "redelivered")
    write_batch(spark.read.parquet(writers.batch_folder(path, 0)), copy)
    writers.write_batch_once(spark.read.parquet(copy), path, 0)
    return spark.read.parquet(path).select("partition", "offset", "sensor", "is_anomaly")


@check(
    f"""{WITH_LOG}
    SELECT CASE WHEN sensor IN ('purchase', 'view') THEN sensor ELSE 'rest' END AS branch, sensor, value,
           "partition", "offset" FROM log"""
)
def fan_out_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Three outputs of one stream, which together take every record."""
    paths = {name: scratch_path(spark, name) for name in ("purchase", "view", "rest")}
    log_rows = read_log_stream(streaming_session(spark), log_config(spark, sf))
    named = F.when(F.col("sensor").isin("purchase", "view"), F.col("sensor")).otherwise("rest")
    branches = {path: lambda rows, name=name: rows.filter(named == name) for name, path in paths.items()}
    writers.fan_out(
        parse_readings(log_rows), branches, scratch_path(spark, "checkpoint"), None
    ).awaitTermination()
    parts = [
        spark.read.parquet(path).select(F.lit(name).alias("branch"), "sensor", "value", "partition", "offset")
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@check(f"""{WITH_LOG} SELECT "partition", "offset", sensor, value FROM log""")
def deduplicated_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose files are delivered again later, in a batch of their own, have no second effect."""
    folder, out = scratch_path(spark, "redelivering"), scratch_path(spark, "deduplicated")
    records = log(spark, sf)
    records.write.parquet(folder)
    checkpoint = scratch_path(spark, "checkpoint")

    def run() -> None:
        session = streaming_session(spark, large_state=False)
        stream = read_log_stream(session, LogConfig(TOPIC, format="parquet", path=folder))
        rows = parse_readings(dedupe_log(stream, within="3650 days"))
        writers.write_stream(rows, out, checkpoint, None).awaitTermination()

    run()
    records.filter(F.col("offset") % 2 == 0).write.mode("append").parquet(folder)
    run()
    return read_stream_output(spark, out).select("partition", "offset", "sensor", "value")


@check(
    f"""{WITH_LOG}, {SQL_WINDOWS}
    SELECT window_start, window_end, sensor, {sql_round('avg_value', 4)} AS avg_value, min_value,
           max_value, event_count, anomaly_count
    FROM windows WHERE window_end <= (SELECT max(ts) - INTERVAL '2 minutes' FROM events)"""
)
def restarted_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics over the first half of the log, stopped, and resumed from the checkpoint when the rest
    has arrived: the same windows as in one run, each once."""
    folder, out = scratch_path(spark, "growing"), scratch_path(spark, "windows")
    checkpoint = scratch_path(spark, "checkpoint")
    records = log(spark, sf)
    sent = F.get_json_object(F.col("value").cast("string"), "$.timestamp").cast("bigint")
    middle = sum(records.agg(F.min(sent), F.max(sent)).first()) // 2
    for part in (sent < middle, sent >= middle):
        records.filter(part).write.mode("append").parquet(folder)
        config = LogConfig(TOPIC, format="parquet", path=folder)
        windows = statistics(read_log_stream(streaming_session(spark), config), RULES)
        writers.write_stream(windows, out, checkpoint, None).awaitTermination()
    found = window_bounds(read_stream_output(spark, out))
    return found.withColumn("avg_value", round_half_up(F.col("avg_value"), 4))


@check("SELECT count(*) AS messages, 0::BIGINT AS late_rows, true AS rate_known FROM events")
def stream_throughput(spark: SparkSession, sf: str) -> DataFrame:
    """What a run reports about itself: messages taken, rows dropped as late, and a rate."""
    session = streaming_session(spark)
    totals = ProgressTotals()
    session.streams.addListener(totals)
    path, checkpoint = scratch_path(spark, "measured"), scratch_path(spark, "checkpoint")
    windows = statistics(read_log_stream(session, log_config(spark, sf)), RULES)
    try:
        run_queries(session, [lambda: writers.write_stream(windows, path, checkpoint, None)])
        totals.settle(1)
    finally:
        session.streams.removeListener(totals)
    return totals.to_frame(spark).select(
        "messages",
        F.col("dropped_late").alias("late_rows"),
        (F.col("busy_ms") > 0).alias("rate_known"),
    )


@check(
    f"""{WITH_LOG}
    SELECT sensor AS sensor_type, year, month, day, count(*) AS record_count,
           {sql_round('avg(value)', 3)} AS avg_value, {sql_round('min(value)', 3)} AS min_value,
           {sql_round('max(value)', 3)} AS max_value, count(*) FILTER (is_anomaly) AS anomaly_count,
           {sql_pct('count(*) FILTER (is_anomaly)', 'count(*)')} AS anomaly_pct
    FROM log GROUP BY 1, 2, 3, 4"""
)
def lake_after_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """Streamed, compacted, streamed on, compacted again with the first range merged, and cleaned up: gold
    is that of the whole log, and no directory has more files than there are ranges and open batches."""
    folder, made = scratch_path(spark, "growing"), Lake(scratch_path(spark, "lake"), TOPIC)
    records = log(spark, sf).repartition(4)
    for part in range(3):
        records.filter(F.col("offset") % 3 == part).write.mode("append").parquet(folder)
        files = list_files(spark, folder).count()
        config = LogConfig(TOPIC, format="parquet", path=folder, max_files_per_batch=max(1, files // (part + 1) // 2))
        run_lake(streaming_session(spark), config, made, RULES, keep_raw=False, trigger=None)
        if part < 2:
            compact_batches(spark, made.curated, made.compacted, merge_after=1)
            expire_batches(spark, made.curated, made.compacted)
    now = layout(spark, made.curated, made.compacted)
    files = partition_files(spark, range_folder(made.compacted, *now.ranges[0]))
    most = files.groupBy(*CURATED_PARTITIONS).count().agg(F.max("count")).first()[0]
    if len(now.ranges) != 1 or now.replaced or now.old or most != 1:
        raise AssertionError(f"not compacted: {now}, {most} files in a directory")
    return build_gold(spark, made)


@check(
    f"""{WITH_LOG}
    SELECT device_id, sensor, value, event_time, "partition", "offset", true AS only_changes FROM log
    QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY ms DESC, "partition" DESC, "offset" DESC) = 1"""
)
def latest_by_device_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The newest reading of every device as a log of changes, over four batches, half of them merged. No batch
    writes more rows than it has devices."""
    path, folder = scratch_path(spark, "changes"), scratch_path(spark, "quarters")
    checkpoint = scratch_path(spark, "checkpoint")
    records = log(spark, sf)
    for part in range(4):
        records.filter(F.col("offset") % 4 == part).write.mode("append").parquet(folder)
        config = LogConfig(TOPIC, format="parquet", path=folder)
        readings = parse_readings(read_log_stream(streaming_session(spark), config))
        latest.maintain_changes(readings, path, checkpoint, trigger=None).awaitTermination()
        if part == 2:
            latest.merge_changes(spark, path)
            latest.expire_changes(spark, path)
    written = spark.read.parquet(f"{path}/changes").groupBy("ingest_batch").count()
    devices = parse_readings(records).groupBy((F.col("offset") % 4).alias("part")).agg(F.count_distinct("device_id").alias("n"))
    sparse = written.join(devices, F.col("ingest_batch") == F.col("part")).filter(F.col("count") > F.col("n")).isEmpty()
    found = latest.read_changes(spark, path).withColumn("only_changes", F.lit(sparse and written.count() == 2))
    return found.select("device_id", "sensor", "value", "event_time", "partition", "offset", "only_changes")


@check(
    f"""{WITH_LOG}, kept AS (SELECT * FROM log WHERE "offset" % 97 <> 5),
    holes AS (SELECT "partition", count(*) FILTER (gap > 1) + 1 AS ranges FROM (
      SELECT "partition", "offset" - lag("offset") OVER (PARTITION BY "partition" ORDER BY "offset") AS gap FROM kept) GROUP BY 1)
    SELECT "partition", "offset", sensor, value, CAST(ranges AS BIGINT) AS ranges FROM kept JOIN holes USING ("partition")"""
)
def deduplicated_by_ranges_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A log with holes, whose files are delivered again, whole and in part: a record counts once, and what is
    remembered of a partition is a range for each hole and one more."""
    path, folder = scratch_path(spark, "by-ranges"), scratch_path(spark, "redelivering")
    checkpoint = scratch_path(spark, "checkpoint")
    records = log(spark, sf).filter(F.col("offset") % 97 != 5)
    for part in (F.col("offset") % 3 != 1, F.col("offset") % 2 == 0, F.lit(True)):
        records.filter(part).write.mode("append").parquet(folder)
        stream = read_log_stream(streaming_session(spark), LogConfig(TOPIC, format="parquet", path=folder))
        seen.deduplicate_by_ranges(stream, path, checkpoint, None, width=64).awaitTermination()
    ranges = seen.read_seen(spark, path).groupBy("partition").agg(F.count(F.lit(1)).alias("ranges"))
    rows = parse_readings(seen.read_deduplicated(spark, path))
    return rows.join(ranges, "partition").select("partition", "offset", "sensor", "value", "ranges")


@check(
    f"""{WITH_LOG}, {SQL_WINDOWS}
    SELECT window_start, window_end, sensor FROM windows
    WHERE window_end > (SELECT max(ts) - INTERVAL '2 minutes' FROM events)"""
)
def open_windows(spark: SparkSession, sf: str) -> DataFrame:
    """What a stopped stream still holds in its state: the windows that the watermark has not closed."""
    root = scratch_path(spark, "etl")
    run_etl(streaming_session(spark), log_config(spark, sf), root, RULES, trigger=None)
    return window_state(spark, f"{root}/checkpoints/windows")


@check(
    f"""{WITH_LOG}, parts AS (
      SELECT *, event_id * 7 % 4 AS batch, time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end FROM log),
    latest AS (SELECT batch, max(event_time) AS latest FROM parts GROUP BY 1),
    marks AS (SELECT b.batch, max(l.latest) - INTERVAL '2 minutes' AS watermark FROM latest b JOIN latest l ON l.batch < b.batch GROUP BY 1)
    SELECT "partition", "offset", sensor, event_time, CAST(p.batch AS INTEGER) AS batch, watermark
    FROM parts p JOIN marks m ON m.batch = p.batch WHERE window_end <= watermark"""
)
def late_rows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Four batches of one log, each with readings of all days: what the watermark of the batches before has closed."""
    path, folder = scratch_path(spark, "late"), scratch_path(spark, "quarters")
    checkpoint = scratch_path(spark, "checkpoint")
    for part in range(4):
        quarter = log(spark, sf).join(event_ids(spark, sf), ["partition", "offset"])
        quarter.filter(F.col("event_id") * 7 % 4 == part).drop("event_id").write.mode("append").parquet(folder)
        stream = read_log_stream(streaming_session(spark), LogConfig(TOPIC, format="parquet", path=folder))
        late.keep_late(parse_readings(stream), path, checkpoint, trigger=None).awaitTermination()
    found = late.read_late(spark, path).withColumnRenamed("ingest_batch", "batch")
    return found.select("partition", "offset", "sensor", "event_time", "batch", "watermark")
