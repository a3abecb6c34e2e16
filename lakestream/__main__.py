"""Command line: python -m lakestream <command>, or through spark-submit."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.functions.payload import decode, parse_readings
from lakestream.operators import lake_audit, lake_queries, log_audit, quality
from lakestream.operators.windows import window_report
from lakestream.plans import maintenance
from lakestream.plans.etl import run_etl, run_etl_batch
from lakestream.plans.lake import Lake, build_gold, lake_sensors, read_lake, run_lake
from lakestream.schemas import COMMITTED, DEFAULT_RULES
from lakestream.session import prepare, streaming_session
from lakestream.sources.batches import layout
from lakestream.sources.log import LATEST, LogConfig, StartPosition, end_offsets, read_log_batch
from lakestream.sources.zones import read_stream_output, register_views
from lakestream.streaming.supervise import committed_offsets
from lakestream.streaming.writers import LAKE_TRIGGER, STATS_TRIGGER

SHOWN = 30


def show(args: argparse.Namespace, title: str, df: DataFrame) -> None:
    """Print the first `--rows` rows (0: all of them), and write everything to `--save`, if given."""
    print(f"\n{title}")
    if args.save:
        folder = f"{args.save}/{title.lower().replace(' ', '_')}"
        df.write.mode("overwrite").json(folder)
        print(f"written to {folder}")
    df.show(args.rows or df.count(), truncate=False)


def log_of(args: argparse.Namespace) -> LogConfig:
    if args.path:
        return LogConfig(args.topic, format=args.format, path=args.path)
    return LogConfig(
        args.topic,
        args.servers,
        max_records_per_batch=args.max_records,
        fail_on_data_loss=not args.skip_lost,
    )


def readings_of(spark: SparkSession, args: argparse.Namespace, *extra: str) -> DataFrame:
    return parse_readings(read_log_batch(spark, log_of(args)), extra=extra)


def etl(spark: SparkSession, args: argparse.Namespace) -> None:
    trigger = None if args.once else args.trigger or STATS_TRIGGER
    run_etl(
        streaming_session(spark),
        log_of(args),
        args.out,
        keep_readings=args.raw,
        trigger=trigger,
        start=LATEST if args.latest else StartPosition.earliest(),
    )


def etl_batch(spark: SparkSession, args: argparse.Namespace) -> None:
    windows = run_etl_batch(spark, log_of(args), args.out)
    show(args, "Windows", window_report(windows))
    totals = windows.groupBy("sensor").agg(
        F.sum("event_count").alias("total"), F.sum("anomaly_count").alias("anomalies")
    )
    show(args, "Readings per sensor", totals.orderBy("sensor"))


def read_output(spark: SparkSession, args: argparse.Namespace) -> None:
    """What `etl` has written so far."""
    windows = read_stream_output(spark, f"{args.out}/windows")
    show(args, "Windows", window_report(windows))
    totals = windows.groupBy("sensor").agg(
        F.count(F.lit(1)).alias("windows"),
        F.sum("event_count").alias("readings"),
        F.sum("anomaly_count").alias("anomalies"),
    )
    show(args, "Readings per sensor", totals.orderBy("sensor"))


def alerts(spark: SparkSession, args: argparse.Namespace) -> None:
    found = quality.alerts(readings_of(spark, args))
    show(args, "Alerts", found.orderBy("partition", "offset"))


def batch_stats(spark: SparkSession, args: argparse.Namespace) -> None:
    chunks = log_audit.batch_stats(readings_of(spark, args, "topic"), args.chunk)
    show(args, "Chunks", chunks.orderBy("topic", "partition", "chunk", "sensor"))


def lag(spark: SparkSession, args: argparse.Namespace) -> None:
    """Of a consumer whose committed offsets are given, of the stream whose checkpoint is, or of the consumers in a
    table of topic, partition and committed."""
    ends = end_offsets(read_log_batch(spark, log_of(args)))
    if args.checkpoint:
        committed = committed_offsets(spark, args.checkpoint)
    elif args.table:
        committed = spark.read.schema(COMMITTED).parquet(args.table)
    else:
        committed = log_audit.offsets_from_json(spark, "committed", args.committed)
    table = log_audit.lag_flags(log_audit.lag_table(ends, committed))
    show(args, "Lag", table.orderBy("topic", "partition"))
    show(args, "Status", log_audit.lag_status(table))


def audit(spark: SparkSession, args: argparse.Namespace) -> None:
    log = read_log_batch(spark, log_of(args))
    show(args, "Partitions", log_audit.partition_completeness(log).orderBy("topic", "partition"))
    show(args, "Gaps", log_audit.offset_gaps(log).orderBy("topic", "partition", "after_offset"))
    show(args, "Keys on several partitions", log_audit.key_partitions(decode(log)).filter("not single"))


def lake(spark: SparkSession, args: argparse.Namespace) -> None:
    trigger = None if args.once else args.trigger or LAKE_TRIGGER
    run_lake(
        streaming_session(spark),
        log_of(args),
        Lake(args.lake, args.topic),
        keep_raw=not args.no_raw,
        trigger=trigger,
    )


def gold(spark: SparkSession, args: argparse.Namespace) -> None:
    zones = Lake(args.lake)
    built = build_gold(spark, zones, args.sensor)
    show(args, "Gold", built.orderBy("sensor_type", "year", "month", "day"))
    show(args, "Sensors", lake_queries.sensor_comparison(read_lake(spark, zones)).orderBy("sensor_type"))


def query(spark: SparkSession, args: argparse.Namespace) -> None:
    zones = Lake(args.lake)
    sensor = lake_queries.checked_sensor(args.sensor)
    register_views(spark, read_lake(spark, zones), zones.gold)
    for name in ("day_report", "anomaly_shares", "hourly_trend", "sensor_spread"):
        bound = {"sensor": sensor} if ":sensor" in lake_queries.SQL[name] else {}
        show(args, name, lake_queries.run_sql(spark, name, **bound))
    full = spark.table("sensor_curated")
    pruned = full.filter(F.col("sensor_type") == sensor)
    show(args, "Partition pruning", lake_audit.pruning_report(full, pruned))
    pruned.select("sensor_type", "value").explain("formatted")


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Closed batches of a streamed lake into a range; a lake without batches into a folder of its own."""
    zones = Lake(args.lake)
    if args.dry_run:
        show(args, "To compact", maintenance.compaction_report(spark, zones.curated))
        return
    if layout(spark, zones.curated, zones.compacted) is not None:
        done = maintenance.compact_batches(
            spark, zones.curated, zones.compacted, files_per_partition=args.target_files, cluster_by=args.cluster_by
        )
        print(f"batches {done[0]} to {done[1]}, rows unchanged" if done else "no closed batch")
        if args.expire:
            print(f"{len(maintenance.expire_batches(spark, zones.curated, zones.compacted))} folders removed")
        return
    where = F.expr(args.where) if args.where else None
    report = maintenance.compact(
        spark,
        zones.curated,
        zones.compacted,
        files_per_partition=args.target_files,
        where=where,
        cluster_by=args.cluster_by,
    )
    show(args, "Compacted", report)
    rows = maintenance.verify_compaction(spark, zones.curated, zones.compacted, where)
    print(f"{rows} rows, unchanged")


def explore(spark: SparkSession, args: argparse.Namespace) -> None:
    root = args.lake
    zones = {
        "raw": f"{root}/raw",
        "curated": f"{root}/curated",
        "consumption": f"{root}/consumption",
        "compacted": f"{root}/curated-compacted",
    }
    chosen = {args.zone: zones[args.zone]} if args.zone else zones
    files = lake_audit.file_inventory(spark, chosen)
    show(args, "Zones", lake_audit.inventory_summary(files).orderBy("zone", "kind"))
    show(args, "Directories", lake_audit.dir_rollup(files, 4).orderBy("zone", "directory"))


def stats(spark: SparkSession, args: argparse.Namespace) -> None:
    sensor = lake_queries.checked_sensor(args.sensor)
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else None
    rows = lake_queries.sensor_stats(read_lake(spark, Lake(args.lake)), sensor, args.days, as_of)
    show(args, f"{sensor} by day", rows)


def sensors(spark: SparkSession, args: argparse.Namespace) -> None:
    show(args, "Sensors", lake_sensors(spark, Lake(args.lake), DEFAULT_RULES.sensors))


def latest(spark: SparkSession, args: argparse.Namespace) -> None:
    sensor = lake_queries.checked_sensor(args.sensor)
    log = read_log_batch(spark, log_of(args))
    if args.exact:
        found = log_audit.latest_readings(parse_readings(log), args.n, sensor)
    else:
        found = log_audit.latest_of_log(log, args.n, sensor, args.seek_back, extend=args.seek_back is None)
    show(args, "Latest", found)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lakestream", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(work, help: str, *, log: bool = False, lake_root: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(work.__name__.replace("_", "-"), help=help)
        sub.set_defaults(work=work)
        sub.add_argument("--rows", type=int, default=SHOWN, help="rows to print of a result, 0 for all")
        sub.add_argument("--save", help="folder to write whole results to, as JSON lines")
        if log:
            sub.add_argument("--servers", default="localhost:9092", help="Kafka bootstrap servers")
            sub.add_argument("--topic", default="sensor-events")
            sub.add_argument("--path", help="read the log from files instead of Kafka")
            sub.add_argument("--format", default="parquet", help="format of --path")
            sub.add_argument("--max-records", type=int, help="records per micro-batch")
            sub.add_argument("--skip-lost", action="store_true", help="go on where retention removed offsets")
        if lake_root:
            sub.add_argument("--lake", required=True, help="root folder of the lake")
        return sub

    sub = command(etl, "window statistics as a stream", log=True)
    sub.add_argument("--out", required=True)
    sub.add_argument("--raw", action="store_true", help="keep the flagged readings as well")
    sub.add_argument("--latest", action="store_true", help="skip what the log already holds")
    sub.add_argument("--trigger", help='such as "10 seconds"')
    sub.add_argument("--once", action="store_true", help="process what there is and stop")
    command(etl_batch, "the same statistics over a bounded read", log=True).add_argument(
        "--out", required=True
    )
    command(read_output, "what etl has written").add_argument("--out", required=True)
    command(alerts, "readings above their sensor's threshold", log=True)
    command(batch_stats, "statistics of chunks of the log", log=True).add_argument(
        "--chunk", type=int, default=log_audit.CHUNK
    )
    position = command(lag, "how far a consumer is behind", log=True).add_mutually_exclusive_group(required=True)
    position.add_argument("--committed", help='offsets as Spark reports them: {"topic": {"0": 12}}')
    position.add_argument("--checkpoint", help="checkpoint folder of a Kafka stream")
    position.add_argument("--table", help="Parquet table of topic, partition and committed")
    command(audit, "gaps and repeats of the log, and keys that are spread", log=True)
    sub = command(lake, "feed the raw and curated zones", log=True, lake_root=True)
    sub.add_argument("--no-raw", action="store_true")
    sub.add_argument("--trigger", help='such as "30 seconds"')
    sub.add_argument("--once", action="store_true", help="process what there is and stop")
    command(gold, "build the gold zone", lake_root=True).add_argument("--sensor")
    command(query, "SQL over the curated zone", lake_root=True).add_argument(
        "--sensor", default="temperature"
    )
    sub = command(compact, "merge small files", lake_root=True)
    sub.add_argument("--dry-run", action="store_true")
    sub.add_argument("--target-files", type=int, default=1, help="files per directory")
    sub.add_argument("--where", help="SQL condition on partition columns (a lake without batches)")
    sub.add_argument("--expire", action="store_true", help="remove the batches that ranges have replaced")
    sub.add_argument("--cluster-by", nargs="+", default=(), metavar="COLUMN", help="columns to lay rows out by together")
    command(explore, "files and sizes of the zones", lake_root=True).add_argument(
        "--zone", choices=["raw", "curated", "consumption", "compacted"]
    )
    sub = command(stats, "one sensor over the last days", lake_root=True)
    sub.add_argument("sensor")
    sub.add_argument("--days", help="1 to 90, 7 if not given")
    sub.add_argument("--as-of", help="last day, today if not given")
    command(sensors, "sensors with data", lake_root=True)
    sub = command(latest, "newest readings of one sensor", log=True)
    sub.add_argument("sensor")
    sub.add_argument("-n", type=int, default=1)
    sub.add_argument("--exact", action="store_true", help="by time over the whole log, not from its end")
    sub.add_argument("--seek-back", type=int, help="look at so many offsets and no further: may be partial")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = prepare(SparkSession.builder.appName(f"lakestream-{args.command}").getOrCreate())
    args.work(spark, args)


if __name__ == "__main__":
    main()
