"""Published figures, reproduced from published figures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import utc
from lakestream.functions.columns import percentage
from lakestream.operators import log_audit as audit
from lakestream.operators.windows import rollup_windows

# Published figures. Start, sensor, average, minimum, maximum, readings, anomalies
WINDOWS = [
    ("10:00", "humidity", 60.24, 20.63, 88.29, 12, 0),
    ("10:00", "pressure", 1009.24, 983.68, 1029.06, 11, 0),
    ("10:00", "temperature", 26.03, 18.8, 35.78, 7, 1),
    ("10:50", "humidity", 54.98, 20.73, 93.47, 78, 6),
    ("10:50", "pressure", 1007.10, 976.01, 1044.34, 58, 0),
    ("10:50", "temperature", 22.69, 8.05, 41.57, 64, 4),
    ("12:00", "humidity", 59.49, 20.19, 94.94, 174, 12),
    ("12:00", "pressure", 1008.73, 975.59, 1045.0, 156, 0),
    ("12:00", "temperature", 25.42, 8.09, 41.96, 170, 33),
]
# readings, average, anomalies, percent
DAYS = {
    "humidity": (264, 58.19, 18, 6.82),
    "pressure": (225, 1008.34, 0, 0.0),
    "temperature": (241, 24.71, 38, 15.77),
}


@pytest.fixture(scope="module")
def windows(spark):
    rows = [(utc(f"2026-04-28T{start}:00"), *rest) for start, *rest in WINDOWS]
    frame = spark.createDataFrame(
        rows,
        "start timestamp, sensor string, avg_value double, min_value double, max_value double, "
        "event_count bigint, anomaly_count bigint",
    )
    window = F.struct("start", (F.col("start") + F.expr("INTERVAL 5 minutes")).alias("end"))
    return frame.withColumn("window", window).drop("start")


def test_days_from_windows(windows):
    got = {r.sensor: r for r in rollup_windows(windows).collect()}
    for sensor, (n, mean, anomalies, pct) in DAYS.items():
        row = got[sensor]
        assert (row.record_count, row.anomaly_count, row.anomaly_pct) == (n, anomalies, pct)
        assert row.avg_value == pytest.approx(mean, abs=0.011)
        assert (row.year, row.month, row.day) == (2026, 4, 28)
    assert got["temperature"].min_value == 8.05 and got["temperature"].max_value == 41.96


def test_percentages(spark):
    for n, _, anomalies, pct in DAYS.values():
        assert spark.range(1).select(percentage(F.lit(anomalies), F.lit(n))).first()[0] == pct


def _lag(spark, rows):
    ends = spark.createDataFrame([("t", p, e) for p, _, e in rows], "topic string, partition int, end bigint")
    done = spark.createDataFrame([("t", p, c) for p, c, _ in rows if c is not None], "topic string, partition int, committed bigint")
    return audit.lag_table(ends, done)


@pytest.mark.parametrize("nothing", [-1001, None])
def test_lag_of_a_consumer_behind(spark, nothing):
    lag = _lag(spark, [(0, 12, 12), (1, nothing, 19), (2, 18, 29)])
    assert {(r.partition, r.committed, r.end, r.lag) for r in lag.collect()} == {
        (0, 12, 12, 0), (1, 0, 19, 19), (2, 18, 29, 11),
    }
    assert tuple(audit.lag_status(lag).first()) == ("t", 30, "BEHIND")


def test_lag_of_a_healthy_consumer(spark):
    lag = _lag(spark, [(0, 313, 313), (1, 19, 19), (2, 578, 578)])
    assert tuple(audit.lag_status(lag).first()) == ("t", 0, "HEALTHY")
    assert {r.flag for r in audit.lag_flags(lag).collect()} == {"ok"}


def test_a_consumer_ahead_of_the_log_has_no_lag(spark):
    rows = audit.lag_flags(_lag(spark, [(0, 10, 5), (1, 0, 51), (2, 1, 51)])).collect()
    assert {r.partition: (r.lag, r.flag) for r in rows} == {0: (0, "ok"), 1: (51, "high"), 2: (50, "behind")}


def test_fifteen_messages_arrive(spark):
    once = spark.range(15).withColumnRenamed("id", "seq")
    row = audit.sequence_audit(once, 15).first()
    assert (row.received, row.missing, row.enough, row.complete) == (15, 0, True, True)
    again = audit.sequence_audit(once.unionAll(once), 15).first()
    assert (again.received, again.repeated, again.enough, again.complete) == (30, 15, True, True)


def test_repeats_can_hide_a_loss_from_the_count(spark):
    seqs = spark.createDataFrame([(s,) for s in [*range(10), *range(10)]], "seq bigint")
    row = audit.sequence_audit(seqs, 15).first()
    assert (row.enough, row.complete, row.missing) == (True, False, 5)
    listed = audit.sequence_counts(seqs, 15).filter("status = 'missing'")
    assert {r.seq for r in listed.collect()} == set(range(10, 15))


def test_nothing_arrives(spark):
    row = audit.sequence_audit(spark.createDataFrame([], "seq bigint"), 3).first()
    assert (row.received, row.missing, row.enough) == (0, 3, False)
