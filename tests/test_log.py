from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from helpers import body, epoch_ms, plan_of, records
from lakestream.functions.payload import parse_readings
from lakestream.operators import log_audit as audit
from lakestream.sinks import batch as sinks
from lakestream.sources import bounds
from lakestream.sources import log as src
from lakestream.sources import time_index

KAFKA = src.LogConfig("sensor-events", "b1:9092,b2:9092")


def test_kafka_stream_options():
    options = src.stream_options(KAFKA)
    assert options == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092",
        "subscribe": "sensor-events",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    bounded = src.LogConfig("t", "b", max_records_per_batch=50, min_partitions=64)
    options = src.stream_options(bounded, src.LATEST)
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("50", "64")
    assert options["startingOffsets"] == "latest"


def test_kafka_batch_options():
    options = src.batch_options(KAFKA)
    assert (options["startingOffsets"], options["endingOffsets"]) == ("earliest", "latest")
    at = src.StartPosition.at_offsets({"sensor-events": {0: 5, 2: 9}})
    options = src.batch_options(KAFKA, at, src.StartPosition.at_time(1_700_000_000_000))
    assert json.loads(options["startingOffsets"]) == {"sensor-events": {"0": 5, "2": 9}}
    assert options["endingTimestamp"] == "1700000000000"


def test_publish_options():
    options = sinks.publish_options("b:9092", {"kafka.retries": "3"})
    assert options["kafka.acks"] == "all" and options["kafka.compression.type"] == "gzip"
    assert options["kafka.retries"] == "3" and options["kafka.linger.ms"] == "10"


@pytest.fixture(scope="module")
def file_log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log"))
    for p, n in ((0, 100), (1, 10), (2, 3)):
        rows = records(spark, [(f"s{i % 2}", body(f"s{i % 2}", float(i))) for i in range(n)], p)
        sinks.append_to_file_log(rows.drop("timestampType"), path)
    return src.LogConfig("t", format="parquet", path=path)


def test_reading_between_offsets(spark, file_log):
    start = src.StartPosition.at_offsets({"t": {0: 90}})
    end = src.StartPosition.at_offsets({"t": {1: 4}})
    rows = src.read_log_batch(spark, file_log, start, end).groupBy("partition").count().collect()
    assert {r["partition"]: r["count"] for r in rows} == {0: 10, 1: 4, 2: 3}


def test_reading_between_times(spark, file_log):
    ten = epoch_ms("2024-01-01T10:00:00")
    assert src.read_log_batch(spark, file_log, src.StartPosition.at_time(ten)).count() == 113
    assert src.read_log_batch(spark, file_log, src.StartPosition.at_time(ten + 1)).count() == 0
    until = src.StartPosition.at_time(ten)
    assert src.read_log_batch(spark, file_log, end=until).count() == 0


@pytest.fixture(scope="module")
def unordered(spark, tmp_path_factory):
    """Partition 0 with times 0, 50, 10, 30, 60, 20, ...; 1 early, 2 late."""
    path = str(tmp_path_factory.mktemp("unordered"))
    log = records(spark, [body("a", float(i)) for i in range(40)])
    for p in range(3):
        minutes = (F.col("offset") * 50 % 90 + F.lit([0, -500, 500][p])).cast("int")
        at = F.col("timestamp") + F.make_interval(mins=minutes)
        moved = log.withColumn("partition", F.lit(p)).withColumn("timestamp", at)
        sinks.append_to_file_log(moved.drop("timestampType"), path)
    return src.LogConfig("t", format="parquet", path=path)


def places(df):
    return sorted((r.partition, r.offset) for r in df.collect())


def test_a_time_is_the_first_offset_that_late(spark, unordered):
    """What follows is read whatever its time; a partition without such a record is at its end."""
    at = src.StartPosition.at_time(epoch_ms("2024-01-01T10:30:00"))
    first = next(i for i in range(40) if i * 50 % 90 >= 30)
    late = [(0, i) for i in range(first, 40)] + [(2, i) for i in range(40)]
    assert places(src.read_log_batch(spark, unordered, at)) == late
    early = [(0, i) for i in range(first)] + [(1, i) for i in range(40)]
    assert places(src.read_log_batch(spark, unordered, end=at)) == early
    stream = src.read_log_stream(spark, unordered, at)
    query = stream.writeStream.format("memory").queryName("from_time").trigger(availableNow=True).start()
    query.awaitTermination()
    assert places(spark.table("from_time")) == late


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_the_time_index_finds_the_same(spark, unordered, tmp_path, width):
    whole = src.read_log_batch(spark, unordered)
    path = str(tmp_path / "index")
    lagging = whole.filter("offset < 10 or (partition = 2 and offset < 25)").filter("partition <> 1")
    assert time_index.extend_time_index(lagging, path, width) > 0
    assert time_index.extend_time_index(lagging, path, width) == 0
    for step in range(2):
        index = time_index.read_time_index(spark, path)
        for minute in (-1000, -480, 0, 30, 85, 89, 100, 520, 1000):
            ms = epoch_ms("2024-01-01T10:00:00") + minute * 60_000
            found = time_index.first_by_index(whole, index, ms).orderBy("partition").collect()
            assert found == src.first_at(whole, ms).orderBy("partition").collect()
        time_index.extend_time_index(whole, path, width)
    assert time_index.read_time_index(spark, path).count() == time_index.time_index(whole, width).count()
    with pytest.raises(ValueError, match="width"):
        time_index.extend_time_index(whole, path, width + 1)


def test_a_lookup_reads_one_bucket_of_a_partition(spark, unordered, tmp_path):
    whole, path = src.read_log_batch(spark, unordered), str(tmp_path / "index")
    time_index.extend_time_index(whole, path, 10)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        found = time_index.first_by_index(whole, time_index.read_time_index(spark, path), epoch_ms("2024-01-01T10:30:00"))
        plan = plan_of(found)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(offset,0),LessThan(offset,10)" in plan.replace(" ", "")
    assert "GreaterThanOrEqual(offset,40)" in plan.replace(" ", "")


def test_latest_needs_offsets_on_a_file_log(spark, file_log):
    with pytest.raises(ValueError, match="at_offsets"):
        src.read_log_stream(spark, file_log, src.LATEST)


@pytest.mark.parametrize("literal", [200, 0])
def test_the_tail_of_every_partition(spark, file_log, monkeypatch, literal):
    monkeypatch.setattr(bounds, "PUSHED_PARTITIONS", literal)
    tail = src.tail_log(src.read_log_batch(spark, file_log), 5)
    got = sorted((r.partition, r.offset) for r in tail.collect())
    assert got == [(0, o) for o in range(95, 100)] + [(1, o) for o in range(5, 10)] + [(2, 0), (2, 1), (2, 2)]
    if literal:
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
        try:
            assert "GreaterThanOrEqual(offset,95)" in plan_of(src.tail_log(src.read_log_batch(spark, file_log), 5))
        finally:
            spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_the_tail_has_fixed_ends(spark, tmp_path, monkeypatch):
    """What arrives after the ends were looked up is in neither form of the tail."""
    path = str(tmp_path / "log")
    records(spark, [body("a", float(i)) for i in range(20)]).write.parquet(path)
    cfg = src.LogConfig("t", format="parquet", path=path)
    ends = src.end_offsets(src.read_log_batch(spark, cfg)).collect()
    records(spark, [body("a", 1.0)] * 5, 0, 20).write.mode("append").parquet(path)
    records(spark, [body("a", 1.0)] * 5, 7).write.mode("append").parquet(path)
    for pushed in (200, 0):
        monkeypatch.setattr(bounds, "PUSHED_PARTITIONS", pushed)
        tail = src.tail_log(src.read_log_batch(spark, cfg), 4, ends)
        assert sorted((r.partition, r.offset) for r in tail.collect()) == [(0, o) for o in range(16, 20)]


def test_ends_are_found_without_reading_payloads(spark, file_log):
    plan = plan_of(src.end_offsets(src.read_log_batch(spark, file_log)))
    assert "ReadSchema: struct<topic:string,partition:int,offset:bigint>" in plan


def test_seeking_by_given_ends(spark):
    ends = spark.createDataFrame([("t", 0, 100), ("t", 1, 3)], src.ENDS).collect()
    position = src.tail_positions(ends, 30)
    assert position.kafka_options() == {"startingOffsets": '{"t": {"0": 70, "1": 0}}'}
    kafka = src.batch_options(src.LogConfig("t", "b:9092"), position)
    assert kafka["startingOffsets"] == '{"t": {"0": 70, "1": 0}}' and kafka["failOnDataLoss"] == "true"
    assert src.batch_options(src.LogConfig("t", "b:9092", fail_on_data_loss=False))["failOnDataLoss"] == "false"


def test_numbers_for_latest_and_earliest_on_a_file_log(spark, file_log):
    with pytest.raises(ValueError, match="latest"):
        src.read_log_batch(spark, file_log, src.StartPosition.at_offsets({"t": {0: -1}}))
    assert src.read_log_batch(spark, file_log, src.StartPosition.at_offsets({"t": {0: -2}})).count() == 113


def test_how_far_to_look_back():
    assert [src.seek_back_for(n) for n in (1, 5, 10, 11)] == [30, 30, 30, 33]


def test_end_offsets(spark, file_log):
    ends = src.end_offsets(src.read_log_batch(spark, file_log)).collect()
    assert {r["partition"]: r["end"] for r in ends} == {0: 100, 1: 10, 2: 3}


# --- latest readings -------------------------------------------------------------------------------


def readings(spark, rows, partition=0, first=0):
    return parse_readings(records(spark, [body(*r) for r in rows], partition, first), extra=("topic",))


def test_latest_by_time_not_by_arrival(spark):
    log = readings(spark, [("a", 1.0, "2024-01-01T12:00:00"), ("a", 2.0, "2024-01-01T11:00:00"), ("b", 3.0, None)])
    got = {r.sensor_type: (r.value, r.event_time) for r in audit.latest_readings(log).collect()}
    assert got == {"a": (1.0, "2024-01-01T12:00:00+00:00"), "b": (3.0, None)}


def test_equal_times_are_ordered_by_position(spark):
    log = readings(spark, [("a", 1.0), ("a", 2.0)]).unionByName(readings(spark, [("a", 3.0)], 1))
    assert audit.latest_readings(log).first().value == 3.0
    ranked = audit.latest_readings(log, 2).orderBy("rank").collect()
    assert [r.value for r in ranked] == [3.0, 2.0]


def test_a_missing_time_comes_last(spark):
    log = readings(spark, [("a", 1.0, None), ("a", 2.0, "1970-01-02T00:00:00")])
    assert [r.value for r in audit.latest_readings(log, 2, "a").orderBy("rank").collect()] == [2.0, 1.0]


def test_a_quiet_sensor_is_found(spark):
    log = records(spark, [body("rare", 1.0)] + [body("busy", 1.0)] * 990)
    assert audit.latest_of_log(log, 1, "rare", 30, extend=False).isEmpty()
    assert [r.value for r in audit.latest_of_log(log, 1, "rare").collect()] == [1.0]
    assert audit.latest_of_log(log, 5, "rare").count() == 1
    assert audit.latest_of_log(log, 5, "none").isEmpty()
    assert audit.latest_of_log(log.limit(0), 5, "rare").isEmpty()
    assert audit.latest_readings(parse_readings(log), 1, "rare").count() == 1


def test_the_newest_reading_parses_the_log_once(spark):
    plan = plan_of(audit.latest_readings(readings(spark, [("a", 1.0)])))
    assert plan.count("Scan ExistingRDD") == 1 and "WindowGroupLimit" in plan


def test_a_quiet_partition_may_hold_the_newest(spark):
    """The first partition has enough readings near its end, the second a newer one far back."""
    many = records(spark, [body("a", float(i), "2024-01-01T10:00:00") for i in range(60)])
    deep = records(spark, [body("a", 99.0, "2024-01-02T10:00:00")] + [body("b", 1.0)] * 500, 1)
    assert audit.latest_of_log(many.union(deep), 2, "a").orderBy("rank").first().value == 99.0
    assert audit.latest_of_log(many.union(deep), 1, "a", extend=False).first().value == 59.0


def test_the_rank_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(audit.latest_readings(readings(spark, [("a", 1.0)]), 3))


# --- chunks ----------------------------------------------------------------------------------------


def test_statistics_of_one_batch(spark):
    values = {"pressure": [982.81, 1034.67], "temperature": [12.12, 24.454, 35.77]}
    log = records(spark, [(s, body("other", v)) for s, vs in values.items() for v in vs] + [(None, body("x", 1.0)), ("", body("x", 1.0))])
    got = {r.sensor: (r["count"], r.min, r.max, r.avg) for r in audit.batch_stats(parse_readings(log)).collect()}
    assert got == {"pressure": (2, 982.81, 1034.67, 1008.74), "temperature": (3, 12.12, 35.77, 24.11)}


def test_topics_are_kept_apart(spark):
    log = records(spark, [("s", body("s", 1.0, "2024-01-01T12:00:00")), ("s", body("s", 2.0))])
    other = log.withColumn("topic", F.lit("u")).filter("offset = 1")
    both = parse_readings(log.filter("offset = 0").unionAll(other), extra=("topic",))
    assert {(r.topic, r["count"]) for r in audit.batch_stats(both).collect()} == {("t", 1), ("u", 1)}
    assert audit.late_events(both).isEmpty()
    same = parse_readings(log, extra=("topic",))
    assert [r.offset for r in audit.late_events(same).collect()] == [1]


def test_chunks_follow_offsets(spark):
    log = records(spark, [("s", body("s", 1.0)) for _ in range(7)], first=48)
    got = {r.chunk: r["count"] for r in audit.batch_stats(parse_readings(log), 50).collect()}
    assert got == {0: 2, 1: 5}


# --- gaps, routing, duplicates ---------------------------------------------------------------------


def positions(spark, offsets, partition=0):
    rows = [("t", partition, o, "k") for o in offsets]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string")


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_gaps_within_and_across_buckets(spark, width):
    log = positions(spark, [0, 1, 1, 1, 4, 5, 20]).unionAll(positions(spark, [7, 9], 1))
    got = {(r.partition, r.after_offset, r.next_offset, r.missing) for r in audit.offset_gaps(log, width).collect()}
    assert got == {(0, 1, 4, 2), (0, 5, 20, 14), (1, 7, 9, 1)}


def test_completeness(spark):
    rows = audit.partition_completeness(positions(spark, [3, 4, 4, 4, 8])).collect()
    assert [tuple(r) for r in rows] == [("t", 0, 3, 8, 5, 3, 2)]


def test_key_routing(spark):
    rows = [("user1", 0), ("user2", 2), ("user3", 2), ("user4", 1), ("user5", 1), ("user1", 0)]
    log = spark.createDataFrame([("t", k, p) for k, p in rows], "topic string, key string, partition int")
    got = {r.key: (r.partition_list, r.single, r.records) for r in audit.key_partitions(log).collect()}
    assert got == {
        "user1": ([0], True, 2), "user2": ([2], True, 1), "user3": ([2], True, 1),
        "user4": ([1], True, 1), "user5": ([1], True, 1),
    }
    moved = audit.key_partitions(log.unionAll(spark.createDataFrame([("t", "user1", 1)], log.schema)))
    assert moved.filter("not single").first().partition_list == [0, 1]


def test_replays_are_removed(spark):
    log = records(spark, [body("a", 1.0)] * 4)
    assert audit.dedupe_log(log.unionAll(log).unionAll(log)).count() == 4


# --- late, delayed, different ----------------------------------------------------------------------


def test_late_against_what_was_seen_before(spark):
    times = ["10:00:00", "10:04:59", "10:12:00", "10:01:00", "10:11:00", "10:06:59"]
    log = parse_readings(records(spark, [body("t", float(i), f"2024-01-01T{t}") for i, t in enumerate(times)]))
    for width in (2, 1000):
        late = audit.late_events(log, width=width).collect()
        # at 10:12 the watermark is 10:10: it has closed the windows of 10:00 and 10:05
        assert sorted(r.offset for r in late) == [3, 5]


def test_copies_of_a_late_record_are_one_row(spark):
    log = parse_readings(records(spark, [body("t", 1.0, "2024-01-01T10:12:00"), body("t", 2.0)]))
    late = audit.late_events(log.unionAll(log.filter("offset = 1")).unionAll(log)).collect()
    assert [(r.offset, r.copies) for r in late] == [(1, 3)]


def test_delay_and_directory_of_late_arrivals(spark):
    log = records(
        spark,
        [body("t", 1.0, "2023-12-31T23:59:00"), body("t", 1.0, "2024-01-01T00:00:30"), body("t", 1.0, None)],
        arrived="2024-01-01T00:01:30",
    )
    row = audit.ingestion_delay(parse_readings(log)).first()
    assert (row.readings, row.min_delay_ms, row.max_delay_ms, row.late, row.earlier_day) == (2, 60000, 150000, 1, 1)


def test_delay_quantiles(spark):
    bodies = [body("t", 1.0, f"2024-01-01T00:00:{s:02d}") for s in range(20)]
    log = records(spark, bodies, arrived="2024-01-01T00:00:20")
    row = audit.delay_quantiles(parse_readings(log), (0.5, 0.95, 1.0)).first()
    assert (row.p50_ms, row.p95_ms, row.p100_ms) == (10000, 19000, 20000)


def test_differences_between_results(spark):
    a = spark.createDataFrame([("x", 1.0, 1), ("y", 2.0, 2), ("z", 3.0, None)], "k string, v double, n int")
    b = spark.createDataFrame([("x", 1.0 + 1e-12, 1), ("y", 2.5, 2), ("w", 0.0, 0)], "k string, v double, n int")
    got = {r.k: (r.status, r.differences) for r in audit.compare_results(a, b, ["k"], 1e-9).collect()}
    assert {k: s for k, (s, _) in got.items()} == {"y": "differs", "z": "only_left", "w": "only_right"}
    assert got["y"][1] == ["v"]
    assert "x" in {r.k for r in audit.compare_results(a, b, ["k"]).collect()}
    assert audit.compare_results(a, a, ["k"]).isEmpty()


def test_multisets(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    b = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v int")
    assert {(r.v, r.surplus) for r in audit.multiset_diff(a, b).collect()} == {(1, 1), (3, -1)}
    assert not audit.same_rows(a, b) and not audit.same_rows(a, b, exact=True)
    assert audit.same_rows(a, a.orderBy("v").repartition(3)) and audit.same_rows(a, a, exact=True)
    assert not audit.same_rows(a, a.distinct())


def test_reconciliation(spark):
    raw = parse_readings(records(spark, [body("a", 1.0), "broken", body("a", 2.0), body("a", 3.0), body("a", 1e9)]))
    kept = spark.createDataFrame([(0, 0), (0, 3), (0, 3), (0, 99)], "partition int, offset bigint")
    got = {r.offset: (r.status, r.reasons) for r in audit.reconcile(raw, kept).collect()}
    assert {o: s for o, (s, _) in got.items()} == {
        0: "curated", 1: "rejected", 2: "lost", 3: "duplicated", 4: "rejected", 99: "unexpected",
    }
    assert got[4][1] == ["out_of_range"]
    counts = {r.status: r.offsets for r in audit.reconcile_summary(audit.reconcile(raw, kept)).collect()}
    assert counts["rejected"] == 2


def test_a_healthy_log_is_audited_without_moving_its_positions(spark):
    """One aggregate per bucket feeds both the borders and the search for holes."""
    log = records(spark, [body("a", 1.0)] * 500)
    gaps = audit.offset_gaps(log, width=50)
    assert gaps.collect() == []
    holed = log.filter("offset not in (7, 8, 120, 399)")
    twice = holed.union(holed.filter("offset in (6, 9, 9, 200, 201)"))
    gaps = audit.offset_gaps(twice, width=50)
    found = sorted((r.after_offset, r.next_offset, r.missing) for r in gaps.collect())
    assert "ReusedExchange" in plan_of(gaps)
    assert found == [(6, 9, 2), (119, 121, 1), (398, 400, 1)]


def test_records_delivered_once_are_not_shuffled(spark):
    log = records(spark, [body("a", float(i)) for i in range(300)])
    clean = audit.dedupe_log(log.union(log.filter("offset < 3")), plain_rows=0)
    assert clean.count() == 300 and clean.columns == log.columns
    assert sorted(r.offset for r in clean.collect()) == list(range(300))
    assert "BroadcastHashJoin" in plan_of(clean)  # the positions delivered again, found by their size
    nulls = log.withColumn("topic", F.lit(None).cast("string"))
    assert audit.dedupe_log(nulls.union(nulls)).count() == 300
    assert audit.dedupe_log(nulls.union(nulls.filter("offset < 3")), plain_rows=0).count() == 300


def test_many_repeats_are_removed_in_one_shuffle(spark):
    log = records(spark, [body("a", float(i)) for i in range(300)])
    for found in (audit.dedupe_log(log.union(log), plain_rows=0), audit.dedupe_log(log.union(log.limit(1)))):
        assert "Join" not in plan_of(found) and found.count() == 300
    assert audit.dedupe_log(log.limit(0), plain_rows=0).count() == 0
