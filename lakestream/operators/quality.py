"""Filters, validation and anomaly flags."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestream.functions.columns import names_where, utf8
from lakestream.functions.payload import computed_once, with_json
from lakestream.schemas import DEFAULT_RULES, SensorRules

REQUIRED = ("sensor", "value", "event_time")


def drop_malformed(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Keep rows that have a sensor, a value and a time. NaN is a value here, which `dropna` would drop."""
    for column in required:
        df = df.filter(F.col(column).isNotNull())
    return df


def in_range(df: DataFrame, low: float, high: float, value: str = "value") -> DataFrame:
    """Inclusive gate against corrupt values. Drops NaN, which Spark sorts above every number."""
    return df.filter(F.col(value).between(low, high))


def only_sensor(df: DataFrame, sensor: str | None, column: str = "sensor_type") -> DataFrame:
    """One sensor, or all of them for None. On a partition column this prunes directories."""
    return df if sensor is None else df.filter(F.col(column) == sensor)


def only_anomalies(df: DataFrame) -> DataFrame:
    return df.filter("is_anomaly")


# Rules are either a few, written in code (`SensorRules`), or a table of any size with the columns of
# `SensorRules.FRAME`, one row per sensor. The former become expressions; the latter are joined by sensor,
# and Spark broadcasts them while they are small.
Rules = SensorRules | DataFrame
_RULE = "_rule"


def _with_rule(df: DataFrame, rules: DataFrame, sensor: str) -> DataFrame:
    """Every row with the rule of its sensor, null if it has none."""
    row = F.struct(*[c for c in SensorRules.FRAME.fieldNames() if c in rules.columns]).alias(_RULE)
    table = rules.filter(F.col("sensor").isNotNull()).select(F.col("sensor").alias("_of"), row)
    return df.join(table, F.col(sensor) == F.col("_of"), "left").drop("_of")


def in_domain(df: DataFrame, rules: Rules = DEFAULT_RULES, sensor: str = "sensor") -> DataFrame:
    """Keep known sensors."""
    if isinstance(rules, DataFrame):
        return _with_rule(df, rules, sensor).filter(F.col(_RULE).isNotNull()).drop(_RULE)
    return df.filter(F.col(sensor).isin(rules.sensors))


def anomaly(rules: SensorRules, sensor: str, value: str) -> Column:
    """Strictly above the threshold of the row's sensor. Inline, so no join and no shuffle."""
    flagged = F.lit(False)
    for rule in rules.rules:
        if rule.anomaly_above is not None:
            over = (F.col(sensor) == rule.sensor) & (F.col(value) > rule.anomaly_above)
            flagged = flagged | over
    return F.coalesce(flagged, F.lit(False))


def flag_anomalies(
    df: DataFrame, rules: Rules = DEFAULT_RULES, sensor: str = "sensor", value: str = "value"
) -> DataFrame:
    """Add `is_anomaly`; nothing is dropped."""
    if isinstance(rules, DataFrame):
        over = F.coalesce(F.col(value) > F.col(f"{_RULE}.anomaly_above"), F.lit(False))
        return _with_rule(df, rules, sensor).withColumn("is_anomaly", over).drop(_RULE)
    return df.withColumn("is_anomaly", anomaly(rules, sensor, value))


def _in_physical_range(rules: SensorRules, sensor: Column, value: Column) -> Column:
    inside = F.lit(False)
    for rule in rules.rules:
        if rule.physical_low is not None:
            within = value.between(rule.physical_low, rule.physical_high)
            inside = inside | ((sensor == rule.sensor) & within)
    return F.coalesce(inside, F.lit(False))


def in_physical_range(
    df: DataFrame, rules: Rules = DEFAULT_RULES, sensor: str = "sensor", value: str = "value"
) -> DataFrame:
    """Keep readings their sensor can physically produce, bounds included."""
    if isinstance(rules, DataFrame):
        low, high = F.col(f"{_RULE}.physical_low"), F.col(f"{_RULE}.physical_high")
        return _with_rule(df, rules, sensor).filter(F.col(value).between(low, high)).drop(_RULE)
    return df.filter(_in_physical_range(rules, F.col(sensor), F.col(value)))


def attach_rules(df: DataFrame, rules: DataFrame, on: str = "sensor", how: str = "left") -> DataFrame:
    """The columns of a rules table, one row per sensor or device, next to every reading."""
    return df.join(rules, [on], how)


def alerts(log: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per record whose *key* names a sensor and whose payload value is above its threshold.
    Stateless, so it runs on a stream as well. Takes rows of `parse_readings`."""
    message = F.format_string(
        "ALERT: HIGH %s %.2f %s", F.upper("message_key"), F.col("value"), F.coalesce("unit", F.lit(""))
    )
    return only_anomalies(flag_anomalies(log, rules, "message_key")).select(
        "partition", "offset", "message_key", "value", "unit", "device_id", message.alias("message")
    )


REASONS = ("missing_sensor", "missing_value", "missing_event_time", "not_a_number", "out_of_range")


def rejection_bits(
    rules: SensorRules, sensor: str = "sensor", value: str = "value", event_time: str = "event_time"
) -> Column:
    """Why a parsed reading would not enter the curated zone, one bit per entry of REASONS; 0 for a good
    one. A number, unlike a list, can be aggregated without sorting."""
    number = F.col(value)
    failed = (
        F.col(sensor).isNull(),
        number.isNull(),
        F.col(event_time).isNull(),
        F.isnan(number),
        ~F.isnan(number) & ~number.between(rules.corrupt_below, rules.corrupt_above),
    )
    bits = F.lit(0)
    for place, check in enumerate(failed):
        bits = bits + F.when(check, 1 << place).otherwise(0)
    return bits


def reason_names(bits: Column) -> Column:
    """The reasons of `rejection_bits` as a list."""
    return names_where({name: bits.bitwiseAND(1 << i) != 0 for i, name in enumerate(REASONS)})


def with_reasons(df: DataFrame, rules: SensorRules = DEFAULT_RULES, **columns: str) -> DataFrame:
    """Add `reasons`, empty for a good reading."""
    return df.withColumn("reasons", reason_names(rejection_bits(rules, **columns)))


def split_valid(
    df: DataFrame, rules: SensorRules = DEFAULT_RULES, **columns: str
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their reasons: nothing disappears silently."""
    bits = rejection_bits(rules, **columns)
    return df.filter(bits == 0), df.filter(bits != 0).withColumn("reasons", reason_names(bits))


# The numbers Python's float() accepts as text, once trimmed.
_DIGITS = r"\d+(_\d+)*"
_FLOAT_TEXT = (
    rf"(?i)^[+-]?(inf|infinity|nan|({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?)$"
)


# White space as Python's str.strip knows it, and every decimal digit beyond ASCII with its value.
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_OTHER_DIGITS = "".join(c for c in map(chr, range(0x80, 0x20000)) if c.isdecimal())
_THEIR_VALUES = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)


def _submitted_number(field: Column, kind: Column) -> Column:
    """A variant as a double the way a lenient API reads it: numbers, numeric text and booleans."""
    text = F.btrim(F.try_variant_get(field, "$", "string"), F.lit(_BLANKS))
    text = F.when(text.rlike(r"[^\x00-\x7f]"), F.translate(text, _OTHER_DIGITS, _THEIR_VALUES)).otherwise(text)
    cleaned = F.replace(text, F.lit("_"), F.lit(""))
    return F.when(
        kind == "STRING", F.when(text.rlike(_FLOAT_TEXT), cleaned.try_cast("double"))
    ).otherwise(F.try_variant_get(field, "$", "double"))


def validate_payloads(
    df: DataFrame, rules: SensorRules = DEFAULT_RULES, body: str = "value"
) -> DataFrame:
    """Judge submitted JSON bodies as the ingest API does: the first failing check decides.

    Adds status_code (201, 400 or 422), error (null when accepted), missing (required fields that are
    absent, a null one counts as present), and the fields of the body: sensor, submitted (the number),
    unit and device_id with the defaults for absent ones. Bodies that are not one JSON document, or not an
    object, are 400; so is a bare NaN or Infinity, which is not JSON.
    """
    parsed = with_json(df, utf8(body), "_body")

    def part(name: str, kind: str = "variant") -> Column:
        return F.try_variant_get(F.col("_body"), f"$.{name}", kind)

    def text_or(name: str, default: str) -> Column:
        return F.coalesce(part(name, "string"), F.when(part(name).isNull(), F.lit(default)))

    read = parsed.withColumns({"_sensor": part("sensor"), "_value": part("value")}).withColumns(
        {
            "_sensor_kind": F.schema_of_variant("_sensor"),
            "_value_kind": F.schema_of_variant("_value"),
            "_is_object": F.col("_body").isNotNull() & utf8(body).rlike(r"^[ \t\r\n]*\{"),
        }
    )
    typed = read.withColumns(
        {
            "sensor": F.try_variant_get("_sensor", "$", "string"),
            "submitted": _submitted_number(F.col("_value"), F.col("_value_kind")),
            "unit": text_or("unit", ""),
            "device_id": text_or("device_id", "api"),
            "missing": names_where(
                {"sensor": F.col("_sensor").isNull(), "value": F.col("_value").isNull()}
            ),
        }
    )
    known = (F.col("_sensor_kind") == "STRING") & F.col("sensor").isin(rules.sensors)
    error = (
        F.when(~F.coalesce("_is_object", F.lit(False)), "not_json")
        .when(F.col("_sensor").isNull() | F.col("_value").isNull(), "missing_fields")
        .when(~F.coalesce(known, F.lit(False)), "unknown_sensor")
        .when(F.col("submitted").isNull(), "not_numeric")
        .when(~_in_physical_range(rules, F.col("sensor"), F.col("submitted")), "out_of_range")
    )
    status = (
        F.when(F.col("error").isNull(), 201)
        .when(F.col("error").isin("not_json", "missing_fields"), 400)
        .otherwise(422)
    )
    working = ("_body", "_sensor", "_value", "_sensor_kind", "_value_kind", "_is_object")
    return computed_once(typed, {"error": error}).withColumn("status_code", status).drop(*working)


def accepted_readings(validated: DataFrame, source: str = "api-v1", now_ms: Column | None = None) -> DataFrame:
    """The accepted bodies as readings to publish, stamped with the server's clock."""
    clock = now_ms if now_ms is not None else F.unix_millis(F.current_timestamp())
    return validated.filter("status_code = 201").select(
        "sensor",
        F.col("submitted").alias("value"),
        "unit",
        clock.alias("timestamp"),
        F.lit(source).alias("source"),
        "device_id",
    )
