from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import body, plan_of, records
from lakestream.functions.folders import delete_folder
from lakestream.operators import lake_audit, lake_queries
from lakestream.operators.lake_queries import daily_stats
from lakestream.plans import daily_parts, maintenance
from lakestream.plans.lake import (
    Lake,
    build_gold,
    curated_readings,
    lake_sensors,
    read_lake,
    rebuild_curated,
)
from lakestream.schemas import (
    CURATED_PARTITIONS,
    CURATED_ZONE,
    DEFAULT_RULES,
    GOLD_ZONE,
    READING_V2,
    SensorRule,
    SensorRules,
    schema,
)
from lakestream.sinks import batch as sinks
from lakestream.sources import zones
from lakestream.sources.batches import layout, range_folder
from lakestream.streaming.writers import raw_zone_rows, write_batch_once

DAYS = [f"2024-0{m}-{d:02d}" for m in (1, 2) for d in (1, 2, 3)]


def readings(spark):
    rows = []
    for sensor in ("temperature", "humidity", "pressure"):
        for i, day in enumerate(DAYS):
            rows += [body(sensor, 30.0 + 10 * k + i, f"{day}T{k:02d}:00:00") for k in range(3)]
    return records(spark, rows)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    made = Lake(str(tmp_path_factory.mktemp("lake")))
    log = readings(spark)
    sinks.write_raw(raw_zone_rows(log), made.raw)
    sinks.write_curated(curated_readings(log), made.curated)
    build_gold(spark, made)
    return made


def curated(spark, lake):
    return zones.read_zone(spark, lake.curated, CURATED_ZONE)


def test_directories_become_typed_columns(spark, lake):
    found = dict(zones.read_zone(spark, lake.curated).dtypes)
    assert found["sensor_type"] == "string" and {found[c] for c in ("year", "month", "day")} == {"int"}
    assert "domain" not in found


def test_gold_per_day(spark, lake):
    row = zones.read_zone(spark, lake.gold, GOLD_ZONE).filter("sensor_type='temperature' and month=2 and day=3").first()
    assert (row.record_count, row.avg_value, row.min_value, row.max_value) == (3, 45.0, 35.0, 55.0)
    assert (row.anomaly_count, row.anomaly_pct) == (2, 66.67)


def test_rebuilding_one_sensor_keeps_the_others(spark, tmp_path):
    copy = Lake(str(tmp_path))
    sinks.write_curated(curated_readings(readings(spark)), copy.curated)
    build_gold(spark, copy)
    changed = curated(spark, copy).filter("sensor_type = 'humidity'").withColumn("value", F.lit(1.0))
    sinks.write_gold(lake_queries.daily_stats(changed), copy.gold, "humidity")
    gold = zones.read_zone(spark, copy.gold, GOLD_ZONE)
    assert gold.count() == 18
    assert {r.avg_value for r in gold.filter("sensor_type = 'humidity'").collect()} == {1.0}
    assert gold.filter("sensor_type <> 'humidity' and avg_value = 1.0").isEmpty()


def test_day_of_month_merges_months(spark, lake):
    assert lake_queries.day_report(curated(spark, lake), "humidity").count() == 6
    merged = lake_queries.day_report(curated(spark, lake), "humidity", by_day_of_month=True).collect()
    assert [(r.day, r.total_records) for r in merged] == [(1, 6), (2, 6), (3, 6)]


def test_views_and_bound_arguments(spark, lake):
    assert zones.register_views(spark, lake.curated, lake.gold) == ["sensor_curated", "sensor_daily"]
    assert zones.register_views(spark, lake.curated, lake.gold + "-none") == ["sensor_curated"]
    hostile = "x' OR '1'='1"
    assert lake_queries.run_sql(spark, "pruned_count", sensor=hostile).first().n == 0
    assert lake_queries.run_sql(spark, "pruned_count", sensor="humidity").first().n == 18
    assert lake_queries.run_sql(spark, "full_count").first().n == 54
    shares = lake_queries.run_sql(spark, "anomaly_shares").collect()
    assert [r.sensor_type for r in shares] == ["temperature", "humidity", "pressure"]


def test_sql_and_dataframe_forms_agree(spark, lake):
    zones.register_views(spark, lake.curated)
    zone = curated(spark, lake)
    pairs = [
        (lake_queries.run_sql(spark, "day_report", sensor="humidity"), lake_queries.day_report(zone, "humidity")),
        (lake_queries.run_sql(spark, "hourly_trend", sensor="humidity"), lake_queries.hourly_trend(zone, "humidity")),
        (lake_queries.run_sql(spark, "sensor_spread"), lake_queries.sensor_spread(zone)),
        (lake_queries.run_sql(spark, "anomaly_shares"), lake_queries.anomaly_shares(zone)),
    ]
    for a, b in pairs:
        assert a.collect() == b.select(*a.columns).collect()


def test_deviation_of_a_single_reading_is_null(spark):
    one = curated_readings(records(spark, [body("pressure", 1000.0)]))
    row = lake_queries.sensor_spread(one).first()
    assert row.std_dev is None and row.n == 1


def test_statistics_of_the_last_days(spark, lake):
    rows = lake_queries.sensor_stats(curated(spark, lake), "temperature", 1, dt.date(2024, 2, 3)).collect()
    assert [r.date for r in rows] == ["2024-02-03", "2024-02-02"]
    assert lake_queries.sensor_stats(curated(spark, lake), "temperature", "32", dt.date(2024, 2, 3)).count() == 5
    assert lake_queries.sensor_stats(curated(spark, lake), "radar", 7, dt.date(2024, 2, 3)).isEmpty()


def test_empty_figures_are_served_as_zero(spark):
    empty = spark.createDataFrame(
        [(None, None, None, None, None, 0, 0, False, "pressure", 2024, 1, 1)], CURATED_ZONE
    )
    row = lake_queries.sensor_stats(empty, "pressure", 7, dt.date(2024, 1, 2)).first()
    assert (row.record_count, row.avg_value, row.anomaly_pct) == (0, 0.0, 0.0)


@pytest.mark.parametrize("days", ["abc", 0, 91, "0", 1.5, True, -1])
def test_bad_spans_are_refused(days):
    with pytest.raises(ValueError):
        lake_queries.checked_days(days)


def test_good_spans():
    assert [lake_queries.checked_days(d) for d in (None, 3, "3", 1, 90)] == [7, 3, 3, 1, 90]


def test_unknown_sensor_is_refused():
    with pytest.raises(ValueError, match="radar"):
        lake_queries.checked_sensor("radar")
    assert lake_queries.checked_sensor("humidity") == "humidity"


def test_sensor_types(spark, lake):
    found = lake_queries.sensor_types(spark, lake.curated, ["radar"])
    assert [r[0] for r in found.collect()] == ["humidity", "pressure", "temperature"]
    nothing = lake.root + "/none"
    assert lake_queries.sensor_types(spark, nothing).isEmpty()
    known = lake_queries.sensor_types(spark, nothing, DEFAULT_RULES.sensors)
    assert [r[0] for r in known.collect()] == DEFAULT_RULES.sensors


def test_gold_of_nothing(spark, tmp_path):
    empty = Lake(str(tmp_path))
    assert build_gold(spark, empty).isEmpty()
    assert zones.register_views(spark, empty.curated, empty.gold) == ["sensor_curated"]
    assert lake_queries.run_sql(spark, "full_count").first().n == 0


def test_missing_zones_are_empty_and_other_errors_are_not_hidden(spark, lake):
    assert zones.read_or_empty(spark, lake.root + "/none", GOLD_ZONE).isEmpty()
    assert not zones.zone_exists(spark, lake.root + "/none") and zones.zone_exists(spark, lake.gold)
    with pytest.raises(Exception, match="no-such-format"):
        zones.read_or_empty(spark, lake.root, GOLD_ZONE, "no-such-format")


def test_row_counts_read_no_data_column(spark, lake):
    counts = lake_queries.row_counts(curated(spark, lake), "humidity")
    assert tuple(counts.first()) == (54, 18)
    assert "ReadSchema: struct<>" in plan_of(counts)


def test_recent_days_prune_directories(spark, lake):
    recent = lake_queries.last_days(curated(spark, lake), 1, dt.date(2024, 2, 3))
    report = lake_audit.pruning_report(curated(spark, lake), recent).first()
    assert (report.full_files, report.pruned_files, report.partition_filter) == (18, 6, True)
    one = curated(spark, lake).filter("sensor_type = 'humidity'")
    assert lake_audit.pruning_report(curated(spark, lake), one).first().pruned_files == 6


def test_silver_from_bronze_with_new_rules(spark, lake, tmp_path):
    rules = SensorRules((SensorRule("pressure", "hPa", 50.0),), corrupt_above=52.0)
    zone = rebuild_curated(spark, lake, str(tmp_path / "again"), rules)
    assert zone.agg(F.max("value")).first()[0] == 52.0
    assert {r.sensor_type for r in zone.filter("is_anomaly").collect()} == {"pressure"}
    same = rebuild_curated(spark, lake, str(tmp_path / "same"))
    # the raw zone keeps no key, and the curated zone needs none
    assert maintenance.verify_same_rows(curated(spark, lake), same, exact=True) == 54


def test_a_field_that_was_not_read_at_first_is_recovered_from_bronze(spark, tmp_path):
    made = Lake(str(tmp_path / "lake"))
    log = records(spark, [body("humidity", 1.0), body("humidity", 2.0, firmware="1.2")])
    sinks.write_raw(raw_zone_rows(log), made.raw)
    assert "firmware" not in curated_readings(log).columns
    wider = schema(**{f.name: f.dataType.typeName() for f in READING_V2}, firmware="string")
    zone = rebuild_curated(spark, made, str(tmp_path / "wide"), schema=wider)
    assert {(r.value, r.firmware) for r in zone.collect()} == {(1.0, None), (2.0, "1.2")}
    assert set(CURATED_ZONE.fieldNames()) < set(zone.columns)


def test_evolved_schema(spark, tmp_path):
    old, new = str(tmp_path / "z/g=1"), str(tmp_path / "z/g=2")
    sinks.write_batch(spark.range(2), old)
    sinks.write_batch(spark.range(2).withColumn("firmware", F.lit("2")), new)
    merged = zones.read_zone(spark, str(tmp_path / "z"), merge_schema=True)
    assert merged.filter("firmware is null").count() == 2


def test_verified_write(spark, tmp_path, monkeypatch):
    assert sinks.write_verified(spark.range(5), str(tmp_path / "v")) == 5
    changed = (F.col("id") + F.when(F.col("id") == 3, 1).otherwise(0)).alias("id")
    monkeypatch.setattr(sinks, "write_batch", lambda df, path, by: df.select(changed).write.parquet(path))
    with pytest.raises(sinks.WriteMismatch):
        sinks.write_verified(spark.range(5), str(tmp_path / "w"))


def test_a_hot_directory_is_written_by_several_tasks(spark, tmp_path):
    """One sensor has nine tenths of the rows; only its directory is split."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = F.when(F.col("id") % 10 > 0, "hot").otherwise("cold")
        rows = spark.range(0, 40_000, 1, 8).select(hot.alias("k"), F.xxhash64("id").alias("v"))
        sinks.gathered(rows, ["k"]).write.partitionBy("k").parquet(str(tmp_path / "z"))
    finally:
        for name in settings:
            spark.conf.unset(name)
    files = {r.k: r["count"] for r in lake_audit.partition_files(spark, str(tmp_path / "z")).groupBy("k").count().collect()}
    assert files["hot"] > 2 and files["cold"] == 1
    assert spark.read.parquet(str(tmp_path / "z")).count() == 40_000


# --- files -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scattered(spark, lake, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scattered"))
    curated(spark, lake).repartition(6).write.mode("overwrite").partitionBy(*CURATED_PARTITIONS).parquet(path)
    return path


def test_compaction_to_one_file_per_directory(spark, lake, scattered, tmp_path):
    target = str(tmp_path / "c")
    report = maintenance.compact(spark, scattered, target).first()
    assert report.before_files > 18 and report.after_files == 18
    assert report.reduction_pct == round((1 - 18 / report.before_files) * 100, 1)
    assert maintenance.verify_same_rows(curated(spark, lake), zones.read_zone(spark, target, CURATED_ZONE)) == 54
    per_directory = lake_audit.partition_files(spark, target).groupBy(*CURATED_PARTITIONS).count()
    assert {r["count"] for r in per_directory.collect()} == {1}


def test_a_large_directory_is_spread_over_several_files(spark, scattered, tmp_path):
    listed = lake_audit.partition_files(spark, scattered)
    plan = maintenance.planned_files(listed, CURATED_PARTITIONS, target_bytes=3000)
    planned = plan.agg(F.sum("_files"), F.max("_files")).first()
    assert planned[1] > 1
    report = maintenance.compact(spark, scattered, str(tmp_path / "c"), target_bytes=3000).first()
    assert 18 < report.after_files <= planned[0]
    bound = maintenance.compact(spark, scattered, str(tmp_path / "d"), files_per_partition=2).first()
    assert 18 <= bound.after_files <= 36


def test_compacting_a_part(spark, scattered, tmp_path):
    target = str(tmp_path / "c")
    maintenance.compact(spark, scattered, target, where=F.col("month") == 1, sort_by=["event_time"])
    assert {r.month for r in spark.read.parquet(target).select("month").distinct().collect()} == {1}
    assert spark.read.parquet(target).count() == 27
    report = maintenance.compact(spark, scattered, target, where=F.col("month") == 2).first()
    assert report.after_files == 9 and report.before_files > 9
    assert spark.read.parquet(target).count() == 54


def test_a_part_without_source_leaves_the_target(spark, scattered, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    spark.read.parquet(scattered).write.partitionBy(*CURATED_PARTITIONS).parquet(source)
    maintenance.compact(spark, source, target)
    assert delete_folder(spark, f"{source}/sensor_type=humidity/year=2024/month=2")
    assert not delete_folder(spark, f"{source}/sensor_type=humidity/year=2024/month=2")
    with pytest.raises(maintenance.RowsChanged):
        maintenance.verify_compaction(spark, source, target, F.col("sensor_type") == "humidity")
    maintenance.compact(spark, source, target, where=F.col("sensor_type") == "humidity")
    assert maintenance.verify_compaction(spark, source, target) == 45
    assert maintenance.verify_compaction(spark, source, target, F.col("sensor_type") == "humidity") == 9


def test_a_target_with_other_columns_is_refused(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    rows = spark.createDataFrame([("01", 1, 1), ("02", 2, 1)], "k string, v int, m int")
    rows.write.partitionBy("k", "m").parquet(source)
    maintenance.compact(spark, source, target, ["k", "m"])
    assert {r.k for r in maintenance.zone_as_written(spark, target).collect()} == {"01", "02"}
    rows.withColumn("w", F.lit(1)).write.mode("append").partitionBy("k", "m").parquet(source)
    with pytest.raises(maintenance.ColumnsChanged):
        maintenance.compact(spark, source, target, ["k", "m"], where=F.col("k") == "01")
    maintenance.compact(spark, source, target, ["k", "m"])
    assert "w" in maintenance.zone_as_written(spark, target).columns


@pytest.mark.parametrize("name", ["a b", "x/y", "50%", "a=b", "q:r", "é", "it's"])
def test_gold_of_a_sensor_with_an_odd_name(spark, tmp_path, name):
    path = str(tmp_path / "gold")
    day = [(1, 2, 1.0, 1.0, 1.0, 0, 0.0, n, 2024, m) for n in (name, "other") for m in (1, 2)]
    rows = spark.createDataFrame(day, GOLD_ZONE)
    sinks.write_gold(rows, path)
    sinks.write_gold(rows.filter("month = 2").withColumn("record_count", F.lit(9).cast("long")), path, name)
    got = zones.read_zone(spark, path, GOLD_ZONE).collect()
    assert sorted((r.sensor_type, r.month, r.record_count) for r in got) == sorted(
        [(name, 2, 9), ("other", 1, 2), ("other", 2, 2)]
    )


def batch(spark, curated_path, number, *rows, **more):
    zone = curated_readings(records(spark, [body(*r) for r in rows]))
    write_batch_once(zone.withColumns(more), curated_path, number, CURATED_PARTITIONS)


def test_batches_are_compacted_into_ranges(spark, tmp_path):
    made = Lake(str(tmp_path))
    where = (spark, made.curated, made.compacted)
    assert maintenance.compact_batches(*where) is None and layout(*where) is None
    assert read_lake(spark, made).count() == 0
    batch(spark, made.curated, 0, ("humidity", 1.0), ("humidity", 2.0))
    assert maintenance.compact_batches(*where) is None  # the newest batch may be repeated
    batch(spark, made.curated, 1, ("humidity", 3.0), firmware=F.lit("1.2"))
    batch(spark, made.curated, 2)
    assert maintenance.compact_batches(*where) == (0, 1)
    assert read_lake(spark, made).count() == 3
    kept = maintenance.zone_as_written(spark, range_folder(made.compacted, 0, 1))
    assert {(r.value, r.firmware) for r in kept.collect()} == {(1.0, None), (2.0, None), (3.0, "1.2")}
    batch(spark, made.curated, 2, ("humidity", 4.0))
    batch(spark, made.curated, 3, ("temperature", 5.0))
    assert maintenance.compact_batches(*where, merge_after=2) == (2, 2)
    batch(spark, made.curated, 4, ("temperature", 6.0))
    assert maintenance.compact_batches(*where, merge_after=2) == (0, 3)
    now = layout(*where)
    assert (now.ranges, now.replaced, now.live, now.old) == (((0, 3),), ((0, 1), (2, 2)), (4,), (0, 1, 2, 3))
    assert sorted(r.value for r in read_lake(spark, made).collect()) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert len(maintenance.expire_batches(*where)) == 6 and maintenance.expire_batches(*where) == []
    assert sorted(r.value for r in read_lake(spark, made).collect()) == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    assert [r.sensor_type for r in lake_sensors(spark, made).collect()] == ["humidity", "temperature"]
    assert build_gold(spark, made).agg(F.sum("record_count")).first()[0] == 6


def test_a_range_that_is_not_finished_is_not_read(spark, tmp_path):
    made = Lake(str(tmp_path))
    for number in range(3):
        batch(spark, made.curated, number, ("humidity", float(number)))
    unfinished = range_folder(made.compacted, 0, 1)
    read_lake(spark, made).limit(1).write.partitionBy(*CURATED_PARTITIONS).parquet(unfinished)
    delete_folder(spark, f"{unfinished}/_SUCCESS")
    assert sorted(r.value for r in read_lake(spark, made).collect()) == [0.0, 1.0, 2.0]
    assert maintenance.compact_batches(spark, made.curated, made.compacted) == (0, 1)
    assert sorted(r.value for r in read_lake(spark, made).collect()) == [0.0, 1.0, 2.0]


def three_batches(spark, root):
    made = Lake(root)
    for number in range(3):
        batch(spark, made.curated, number, ("humidity", float(number)), ("temperature", 40.0 + number))
    return made


@pytest.mark.parametrize("step", ["_found", "mark_complete"])
def test_a_range_counts_only_after_its_rows_were_compared(spark, tmp_path, monkeypatch, step):
    """Whatever ends the job, at the comparison or between it and the end, readers go on with the batches, which are
    not removed, and the next run makes the range."""
    made = three_batches(spark, str(tmp_path))
    where = (spark, made.curated, made.compacted)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(maintenance, step, killed)
    with pytest.raises(KeyboardInterrupt):
        maintenance.compact_batches(*where)
    monkeypatch.undo()
    assert layout(*where).ranges == () and maintenance.expire_batches(*where) == []
    assert read_lake(spark, made).count() == 6
    assert maintenance.compact_batches(*where) == (0, 1)
    assert read_lake(spark, made).count() == 6 and len(maintenance.expire_batches(*where)) == 2
    assert read_lake(spark, made).count() == 6


def test_a_range_with_other_rows_is_refused(spark, tmp_path, monkeypatch):
    made = three_batches(spark, str(tmp_path))
    where = (spark, made.curated, made.compacted)
    found = maintenance._found
    monkeypatch.setattr(maintenance, "_found", lambda df: found(df.limit(3)))
    with pytest.raises(maintenance.RowsChanged):
        maintenance.compact_batches(*where)
    assert layout(*where).ranges == () and read_lake(spark, made).count() == 6


def test_compaction_opens_only_the_folders_concerned(spark, tmp_path):
    """Footers of batches long compacted are not read: they may even be damaged."""
    made = three_batches(spark, str(tmp_path))
    where = (spark, made.curated, made.compacted)
    maintenance.compact_batches(*where)
    for part in (tmp_path / "curated/domain=iot/ingest_batch=0").rglob("*.parquet"):
        part.write_bytes(b"damaged")
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    batch(spark, made.curated, 3, ("humidity", 9.0))
    assert maintenance.compact_batches(*where) == (2, 2)
    assert read_lake(spark, made).count() == 7


def gold_of(rows):
    return sorted(tuple(r[c] for c in ("sensor_type", "day", "record_count", "avg_value", "max_value", "anomaly_count")) for r in rows)


def test_gold_follows_batches_and_corrections(spark, tmp_path):
    """Batches, a repeated batch, a correction that takes the largest value and all of a day, later batches, a correction of
    the correction, compaction, and everything anew: always the gold of the whole zone."""
    made, parts = Lake(str(tmp_path / "lake")), str(tmp_path / "parts")
    days = ("2024-01-01T10:00:00", "2024-01-02T10:00:00")

    def same():
        return gold_of(daily_parts.read_gold_parts(spark, parts).collect()) == gold_of(daily_stats(read_lake(spark, made)).collect())

    assert daily_parts.add_batches(spark, made, parts) == [] and daily_parts.read_gold_parts(spark, parts).isEmpty()
    assert daily_parts.correct_days(spark, made, parts, [("humidity", dt.date(2024, 1, 1))]) is None
    for number in range(2):
        batch(spark, made.curated, number, *[(s, 30.0 + 10 * number + i, days[i]) for s in ("temperature", "humidity") for i in (0, 1)])
        assert daily_parts.add_batches(spark, made, parts)[-1] == number and same()
    batch(spark, made.curated, 1, ("temperature", 99.0, days[0]), ("humidity", 1.0, days[1]))
    assert daily_parts.add_batches(spark, made, parts) == [1] and same()
    # the largest temperature of the first day goes, and all of the second
    batch(spark, made.curated, 0, ("temperature", 30.0, days[0]), ("humidity", 31.0, days[1]))
    batch(spark, made.curated, 1)
    touched = [("temperature", dt.date(2024, 1, d)) for d in (1, 2)] + [("humidity", dt.date(2024, 1, 2))]
    assert not same()
    assert daily_parts.correct_days(spark, made, parts, touched) == 0
    daily_parts.correct_days(spark, made, parts, [("humidity", dt.date(2024, 1, 1))])
    assert same()
    batch(spark, made.curated, 2, ("temperature", 50.0, days[1]), ("humidity", 2.0, days[0]))
    assert daily_parts.add_batches(spark, made, parts) == [2] and same()
    assert daily_parts.correct_days(spark, made, parts, touched) == 2 and same()
    maintenance.compact_batches(spark, made.curated, made.compacted)
    maintenance.expire_batches(spark, made.curated, made.compacted)
    batch(spark, made.curated, 3, ("pressure", 5.0, days[0]))
    assert daily_parts.add_batches(spark, made, parts) == [3] and same()
    assert daily_parts.correct_all(spark, made, parts) == 3 and same()
    batch(spark, made.curated, 4, ("pressure", 7.0, days[0]))
    daily_parts.add_batches(spark, made, parts)
    assert same()


def test_batches_removed_too_early_are_noticed(spark, tmp_path):
    made, parts = three_batches(spark, str(tmp_path / "lake")), str(tmp_path / "parts")
    maintenance.compact_batches(spark, made.curated, made.compacted)
    maintenance.expire_batches(spark, made.curated, made.compacted)
    with pytest.raises(ValueError, match="correct_all"):
        daily_parts.add_batches(spark, made, parts)
    assert daily_parts.correct_all(spark, made, parts) == 2
    assert daily_parts.add_batches(spark, made, parts) == []
    assert daily_parts.read_gold_parts(spark, parts).agg(F.sum("record_count")).first()[0] == 6


def test_a_correction_opens_the_files_of_its_days(spark, tmp_path):
    made = Lake(str(tmp_path))
    for number in range(2):
        rows = [(s, 1.0, f"2024-01-{d:02}T10:00:00") for s in ("humidity", "pressure") for d in range(1, 9)]
        batch(spark, made.curated, number, *rows)
    days = [("humidity", dt.date(2024, 1, d)) for d in (2, 5)]
    zone = read_lake(spark, made)
    report = lake_audit.pruning_report(zone, zone.filter(daily_parts.on_days(days))).first()
    assert (report.full_files, report.pruned_files, report.pruned_rows) == (32, 4, 4)


def test_null_directories_survive_compaction(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    rows.repartition(3).write.partitionBy("k").parquet(source)
    maintenance.compact(spark, source, target, ["k"])
    assert spark.read.parquet(target).count() == 3


def test_dry_run_and_a_changed_rewrite(spark, scattered):
    dry = maintenance.compaction_report(spark, scattered).first()
    assert dry.before_avg == dry.before_bytes // dry.before_files
    zone = spark.read.parquet(scattered)
    with pytest.raises(maintenance.RowsChanged):
        maintenance.verify_same_rows(zone, zone.limit(53))


def test_inventory(spark, lake, scattered):
    files = lake_audit.file_inventory(spark, {"curated": lake.curated, "raw": lake.raw, "gold": lake.root + "/none"})
    rows = {(r.zone, r.kind): r for r in lake_audit.inventory_summary(files).collect()}
    assert set(rows) == {("curated", "parquet"), ("raw", "json")}
    silver = rows["curated", "parquet"]
    assert silver.files == 18 and silver.small_files
    assert silver.avg_bytes == silver.total_bytes // 18 and silver.total_text.endswith("KB")
    assert not rows["raw", "json"].small_files
    assert [r.zone for r in lake_audit.small_file_zones(files).collect()] == ["curated"]
    by_uri = lake_audit.file_inventory(spark, {"curated": f"file://{lake.curated}/"})
    assert by_uri.collect() == files.filter("zone = 'curated'").collect()
    rows = lake_audit.dir_rollup(files.filter("zone = 'curated'"), 2).collect()
    by_directory = {r.directory: r.files for r in rows}
    assert by_directory["sensor_type=humidity"] == 6 and by_directory["sensor_type=humidity/year=2024"] == 6
    assert max(d.count("/") for d in by_directory) == 1
    assert sum(r.total_bytes for r in rows if "/" not in r.directory) == silver.total_bytes
