from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import body, records, utc
from lakestream.functions.payload import parse_readings
from lakestream.operators import log_audit as audit
from lakestream.operators.windows import window_bounds
from lakestream.plans.etl import flagged_readings, run_etl, run_etl_batch, statistics
from lakestream.plans.lake import Lake, curated_readings, read_lake, run_lake
from lakestream.plans.maintenance import compact
from lakestream.schemas import LOG_RECORD, RAW_ZONE
from lakestream.session import scratch_path, streaming_session
from lakestream.sources import log as src
from lakestream.sources import zones
from lakestream.streaming import supervise, writers


@pytest.fixture
def feed(spark, tmp_path):
    """A file log that grows one file at a time."""

    class Feed:
        path = str(tmp_path / "log")
        config = src.LogConfig("t", format="parquet", path=path, max_files_per_batch=1)
        offset = 0

        def add(self, *bodies, arrived="2024-01-01T10:00:00"):
            rows = records(spark, bodies, first=self.offset, arrived=arrived)
            self.offset += len(bodies)
            rows.coalesce(1).write.mode("append").parquet(self.path)

    return Feed()


@pytest.fixture
def session(spark):
    return streaming_session(spark, 2)


def at(sensor, value, time):
    return body(sensor, value, f"2024-01-01T{time}")


def emitted(spark, path):
    rows = window_bounds(zones.read_stream_output(spark, path)).collect()
    return {(r.window_start.strftime("%H:%M"), r.sensor, r.avg_value, r.event_count) for r in rows}


def test_windows_close_late_rows_drop_and_a_restart_continues(spark, session, feed, tmp_path):
    root = str(tmp_path / "out")
    run = lambda: run_etl(session, feed.config, root, trigger=None)
    feed.add(at("t", 1.0, "10:00:00"), at("t", 3.0, "10:04:59"), at("h", 5.0, "10:05:00"))
    run()
    assert emitted(spark, f"{root}/windows") == set()
    feed.add(at("t", 9.0, "10:12:00"))
    run()
    closed = {("10:00", "t", 2.0, 2), ("10:05", "h", 5.0, 1)}
    assert emitted(spark, f"{root}/windows") == closed
    totals = supervise.ProgressTotals()
    session.streams.addListener(totals)
    feed.add(at("t", 100.0, "10:01:00"), at("t", 7.0, "10:11:00"))
    run()
    totals.settle(1)
    session.streams.removeListener(totals)
    assert emitted(spark, f"{root}/windows") == closed
    late = supervise.late_rows(totals.to_frame(spark)).first()
    assert late.late_rows == 1
    throughput = supervise.query_throughput(totals.to_frame(spark)).first()
    assert throughput.messages == 2 and throughput.messages_per_second > 0
    feed.add(at("t", 1.0, "10:30:00"))
    run()
    assert ("10:10", "t", 8.0, 2) in emitted(spark, f"{root}/windows")


def test_stream_and_batch_agree_on_closed_windows(spark, session, feed, tmp_path):
    feed.add(*[at("t", float(i), f"10:{i:02d}:00") for i in range(40)])
    root = str(tmp_path / "out")
    run_etl(session, feed.config, root, keep_readings=True, trigger=None)
    batch = window_bounds(run_etl_batch(spark, feed.config, f"{root}/batch"))
    stream = window_bounds(zones.read_stream_output(spark, f"{root}/windows"))
    open_windows = audit.compare_results(batch, stream, ["window_start", "window_end", "sensor"]).collect()
    assert {(r.status, r.window_start.minute) for r in open_windows} == {("only_left", 35)}
    assert spark.read.parquet(f"{root}/readings").count() == 40


def test_an_old_checkpoint_resumes_and_a_replay_needs_a_fresh_folder_too(spark, session, feed, tmp_path):
    out, fresh = str(tmp_path / "out"), str(tmp_path / "fresh")
    rows = lambda: flagged_readings(src.read_log_stream(session, feed.config))
    feed.add(body("t", 1.0), body("t", 2.0))
    writers.write_stream(rows(), out, str(tmp_path / "c1"), None).awaitTermination()
    writers.write_stream(rows(), out, str(tmp_path / "c1"), None).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    # the folder's own log already knows batch 0 and ignores it
    writers.write_stream(rows(), out, str(tmp_path / "c2"), None).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    writers.write_stream(rows(), fresh, str(tmp_path / "c3"), None).awaitTermination()
    both = spark.read.parquet(out).unionByName(spark.read.parquet(fresh)).withColumn("topic", F.lit("t"))
    assert audit.partition_completeness(both).first().repeats == 2


def test_starting_at_offsets(spark, session, feed, tmp_path):
    feed.add(*[body("t", float(i)) for i in range(6)])
    start = src.StartPosition.at_offsets({"t": {0: 4}})
    rows = parse_readings(src.read_log_stream(session, feed.config, start))
    writers.write_stream(rows, str(tmp_path / "o"), str(tmp_path / "c"), None).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_a_batch_takes_at_most_the_files_allowed(spark, session, feed, tmp_path):
    for i in range(3):
        feed.add(body("t", float(i)))
    rows = parse_readings(src.read_log_stream(session, feed.config))
    query = writers.foreach_batch_once(rows, str(tmp_path / "o"), str(tmp_path / "c"), None)
    query.awaitTermination()
    assert sorted(p["numInputRows"] for p in supervise.progress_rows(query)) == [1, 1, 1]
    assert {r.ingest_batch for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {0, 1, 2}


def test_zones_from_one_log(spark, session, feed, tmp_path):
    feed.add(body("t", 1.0), "broken", body("t", 1e9), body("h", 91.0, source="x"), arrived="2024-02-01T23:30:00")
    lake = Lake(str(tmp_path / "lake"))
    run_lake(session, feed.config, lake, trigger=None)
    raw = zones.read_or_empty(spark, lake.raw, RAW_ZONE, "json")
    assert raw.count() == 4 and {(r.month, r.day, r.hour) for r in raw.collect()} == {(2, 1, 23)}
    silver = read_lake(spark, lake)
    assert {(r.sensor_type, r.month, r.day, r.source) for r in silver.collect()} == {("t", 1, 1, None), ("h", 1, 1, "x")}
    again = zones.replay_raw(spark, lake.raw, "t")
    fates = audit.reconcile_summary(audit.reconcile(parse_readings(again), silver)).collect()
    assert {r.status: r.offsets for r in fates} == {"curated": 2, "rejected": 2}
    run_lake(session, feed.config, lake, keep_raw=False, trigger=None)
    assert read_lake(spark, lake).count() == 2


def test_the_lake_without_raw(spark, session, feed, tmp_path):
    feed.add(body("t", 1.0))
    lake = Lake(str(tmp_path / "lake"))
    assert len(run_lake(session, feed.config, lake, keep_raw=False, trigger=None)) == 1
    assert zones.read_or_empty(spark, lake.raw, RAW_ZONE, "json").isEmpty()


def test_a_stream_forgets_positions_only_after_the_watermark(spark, feed, tmp_path):
    session = streaming_session(spark, 2, large_state=True)
    feed.add(body("t", 1.0), body("t", 2.0))
    records(spark, [body("t", 1.0), body("t", 2.0)]).coalesce(1).write.mode("append").parquet(feed.path)
    unique = audit.dedupe_log(src.read_log_stream(session, feed.config))
    writers.write_stream(unique, str(tmp_path / "o"), str(tmp_path / "c"), None).awaitTermination()
    assert sorted(r.offset for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [0, 1]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "o")
    for _ in range(2):
        writers.write_batch_once(spark.range(3), path, 0)
    writers.write_batch_once(spark.range(5), path, 1)
    assert spark.read.parquet(path).count() == 8


def test_batches_by_id_can_be_compacted(spark, session, feed, tmp_path):
    """A plain file sink hides files its log does not know; batches by id have no such log."""
    for i in range(3):
        feed.add(body("t", float(i)), body("h", float(i)))
    source = str(tmp_path / "o")
    rows = curated_readings(src.read_log_stream(session, feed.config))
    writers.foreach_batch_once(rows, source, str(tmp_path / "c"), None, ["sensor_type"]).awaitTermination()
    report = compact(spark, source, str(tmp_path / "n"), ["sensor_type"]).first()
    assert (report.before_files, report.after_files) == (6, 2)
    assert spark.read.parquet(str(tmp_path / "n")).count() == 6


def test_dead_letters(spark, session, feed, tmp_path):
    feed.add(body("t", 1.0), "broken")
    good, bad = str(tmp_path / "g"), str(tmp_path / "b")
    rows = parse_readings(src.read_log_stream(session, feed.config))
    writers.write_split(rows, good, bad, str(tmp_path / "c"), trigger=None).awaitTermination()
    assert [r.offset for r in spark.read.parquet(good).collect()] == [0]
    assert [(r.offset, r.reasons[0]) for r in spark.read.parquet(bad).collect()] == [(1, "missing_sensor")]


def test_the_latest_view_follows_the_stream(spark, session, feed, tmp_path):
    path, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")

    def run():
        rows = parse_readings(src.read_log_stream(session, feed.config))
        writers.maintain_latest(rows, path, checkpoint, None).awaitTermination()
        return {r.sensor: (r.value, r.offset) for r in writers.read_latest(spark.read.parquet(path)).collect()}

    feed.add(at("t", 1.0, "10:00:00"), at("h", 2.0, "10:00:00"))
    assert run() == {"t": (1.0, 0), "h": (2.0, 1)}
    feed.add(at("t", 3.0, "10:05:00"), at("h", 4.0, "09:00:00"))
    assert run() == {"t": (3.0, 2), "h": (2.0, 1)}
    for i in range(4, 16):
        feed.add(at("t", float(i), "11:00:00"))
    assert run() == {"t": (15.0, 15), "h": (2.0, 1)}
    assert spark.read.parquet(path).select("slot").distinct().count() == 10


def test_statistics_per_micro_batch(spark, session, feed, tmp_path):
    feed.add(*[("k", body("t", float(i))) for i in range(4)])
    feed.add(*[("k", body("t", 9.0))])
    rows = parse_readings(src.read_log_stream(session, feed.config))
    writers.stream_batch_stats(rows, str(tmp_path / "o"), str(tmp_path / "c"), trigger=None).awaitTermination()
    parts = spark.read.parquet(str(tmp_path / "o"))
    assert {(r.ingest_batch, r["count"], r.total) for r in parts.collect()} == {(0, 4, 6.0), (1, 1, 9.0)}
    # both hold some of one chunk
    got = [(r["count"], r.min, r.max, r.avg) for r in writers.read_batch_stats(parts).collect()]
    assert got == [(5, 0.0, 9.0, 3.0)]


def test_one_failure_stops_the_others_and_is_raised(spark, session, feed, tmp_path):
    feed.add(body("t", 1.0))
    rows = parse_readings(src.read_log_stream(session, feed.config))

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    steady = []

    def start_steady():
        steady.append(writers.write_stream(rows, str(tmp_path / "o"), str(tmp_path / "c"), "1 second"))
        return steady[0]

    with pytest.raises(StreamingQueryException, match="sink is down"):
        supervise.run_queries(
            session, [start_steady, lambda: writers.foreach_batch(rows, fail, str(tmp_path / "f"), None)]
        )
    assert not steady[0].isActive


def test_positions_of_a_running_stream(spark):
    progress = {
        "sources": [
            {"endOffset": {"t": {"0": 12, "2": 18}}, "latestOffset": {"t": {"0": 12, "1": 19, "2": 29}}}
        ]
    }
    ends, committed = supervise.stream_positions(spark, progress)
    lag = audit.lag_table(ends, committed)
    assert {(r.partition, r.committed, r.lag) for r in lag.collect()} == {(0, 12, 0), (1, 0, 19), (2, 18, 11)}
    assert audit.lag_status(lag).first().total_lag == 30


def test_the_same_transformation_serves_both(spark, session, feed):
    feed.add(body("t", 1.0))
    stream = src.read_log_stream(session, feed.config)
    assert stream.schema == LOG_RECORD
    for build in (flagged_readings, statistics, curated_readings):
        bounded = build(src.read_log_batch(spark, feed.config))
        assert build(stream).isStreaming and build(stream).dtypes == bounded.dtypes


def test_scratch_paths_are_fresh_and_follow_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_event_time_is_utc(spark, feed):
    feed.add(at("t", 1.0, "23:59:59.999"))
    row = curated_readings(src.read_log_batch(spark, feed.config)).first()
    assert row.event_time == utc("2024-01-01T23:59:59.999").replace(tzinfo=None) and row.day == 1
