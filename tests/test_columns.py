from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestream.functions import columns as c


def python_iso(ms):
    try:
        return dt.datetime.fromtimestamp(ms / 1000, tz=dt.timezone.utc).isoformat()
    except (ValueError, OSError, OverflowError):
        return None


def python_bytes(n):
    size = float(n)
    for unit in ("B", "KB", "MB", "GB"):
        if size < 1024:
            return f"{size:.1f} {unit}"
        size /= 1024
    return f"{size:.1f} TB"


def apply(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", expression.alias("y")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 4_000_000_000_000), min_size=50, max_size=50))
def test_iso_text_is_what_python_writes(spark, values):
    assert apply(spark, values, "bigint", c.epoch_ms_to_iso(F.col("x"))) == [python_iso(v) for v in values]


def test_iso_text_at_the_edges(spark):
    values = [0, 1, 1000, 1_700_000_000_155, 253_402_300_799_000, 253_402_300_800_000, 2**62, None]
    expected = [python_iso(v) if v is not None else None for v in values]
    assert apply(spark, values, "bigint", c.epoch_ms_to_iso(F.col("x"))) == expected


def test_an_impossible_time_is_null_and_not_an_error(spark):
    values = [1_700_000_000_155, 2**63 - 1, -(2**63), None]
    got = apply(spark, values, "bigint", F.unix_millis(c.epoch_ms_to_timestamp(F.col("x"))))
    assert got == [1_700_000_000_155, None, None, None]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 2**52), min_size=50, max_size=50))
def test_byte_text(spark, values):
    assert apply(spark, values, "bigint", c.human_bytes(F.col("x"))) == [python_bytes(v) for v in values]


def test_byte_text_rounds_ties_as_c_does(spark):
    values = [0, 1023, 1024, 1280, 1792, 1_048_575, 1_048_576, 1 << 40, 1 << 50]
    assert apply(spark, values, "bigint", c.human_bytes(F.col("x"))) == [python_bytes(v) for v in values]


def test_rounding_is_half_up_and_ignores_summation_noise(spark):
    values = [0.125, 2.675, 12.345, 12.344999999999999, 12.3449, -0.125]
    got = apply(spark, values, "double", c.round_half_up(F.col("x"), 2))
    assert got == [0.13, 2.68, 12.35, 12.35, 12.34, -0.13]


def test_percentage_of_nothing_is_null(spark):
    rows = spark.createDataFrame([(38, 241), (18, 264), (0, 225), (0, 0)], "a bigint, n bigint")
    got = [r[0] for r in rows.select(c.percentage(F.col("a"), F.col("n"))).collect()]
    assert got == [15.77, 6.82, 0.0, None]


def test_date_parts_and_date_text(spark):
    rows = spark.sql("select timestamp'2024-03-05 23:59:59' as ts")
    got = c.with_date_parts(rows, "ts", "hour").first()
    assert (got.year, got.month, got.day, got.hour) == (2024, 3, 5, 23)
    text = c.date_string(F.lit(2024), F.lit(3), F.lit(5))
    assert rows.select(text).first()[0] == "2024-03-05"
    assert "hour" not in c.with_date_parts(rows, "ts", "day").columns


def test_only_celsius_is_converted(spark):
    rows = spark.createDataFrame([(100.0, "C"), (50.0, "%")], "value double, unit string")
    assert [tuple(r) for r in c.celsius_to_fahrenheit(rows).collect()] == [(212.0, "F"), (50.0, "%")]


@pytest.mark.parametrize("flags,expected", [((True, True), ["a", "b"]), ((False, True), ["b"]), ((False, False), [])])
def test_names_where(spark, flags, expected):
    checks = {"a": F.lit(flags[0]), "b": F.lit(flags[1])}
    assert spark.range(1).select(c.names_where(checks)).first()[0] == expected
