"""Log records to typed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestream.functions.columns import epoch_ms_to_timestamp, utf8
from lakestream.schemas import READING_V1, USER_EVENT


def parsed_once(text: Column, schema: StructType, prefix: str = "") -> Column:
    """The fields of a JSON object as columns of a select, parsed once per row.

    Selecting d.x, d.y from from_json(...) and then filtering on them makes the optimizer copy the
    parser into every predicate. A generator is a barrier to that: `inline` over a one-element array
    keeps a single from_json per row, and keeps rows whose payload is malformed (all fields null).
    """
    names = [prefix + name for name in schema.fieldNames()]
    return F.inline(F.array(F.from_json(text, schema))).alias(*names)


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add costly columns behind the same barrier, so that later filters and projections read their
    values instead of repeating the expressions."""
    made = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select("*", made.alias(*columns) if len(columns) > 1 else made)


def with_json(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add a JSON document as a variant, parsed once; null unless the text is exactly one document.

    The parser stops at the end of the first document and passes over what follows. Here the text stands in
    an array before a number that the text decides: anything that closes the array early, or adds to it,
    leaves that number out of its place.
    """
    wrapped, mark = f"_wrapped_{name}", f"_mark_{name}"
    df = computed_once(df, {mark: F.xxhash64(text)})
    array = F.concat(F.lit("["), text, F.lit(","), F.col(mark).cast("string"), F.lit("]"))
    df = computed_once(df, {wrapped: F.try_parse_json(array)})
    in_place = F.try_variant_get(F.col(wrapped), "$[1]", "bigint").eqNullSafe(F.col(mark))
    alone = F.try_variant_get(F.col(wrapped), "$[2]", "variant").isNull()
    document = F.when(in_place & alone, F.try_variant_get(F.col(wrapped), "$[0]", "variant"))
    return computed_once(df, {name: document}).drop(wrapped, mark)


def decode(log: DataFrame) -> DataFrame:
    """Key and value as text, the rest of the envelope untouched."""
    return log.withColumns({"key": utf8("key"), "value": utf8("value")})


def parse_readings(
    log: DataFrame, schema: StructType = READING_V1, extra: Sequence[str] = ()
) -> DataFrame:
    """Sensor readings with the position they came from. Malformed payloads keep their row, with nulls.

    `extra` names further columns of the log to carry along. Works on batch and streaming input.
    """
    fields = parsed_once(utf8("value"), schema, prefix="_d_")
    payload = [name for name in schema.fieldNames() if name != "timestamp"]
    return log.select(
        utf8("key").alias("message_key"),
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        *extra,
        fields,
    ).select(
        "message_key",
        *[F.col(f"_d_{name}").alias(name) for name in payload],
        epoch_ms_to_timestamp(F.col("_d_timestamp")).alias("event_time"),
        "partition",
        "offset",
        "kafka_timestamp",
        *extra,
    )


def parse_user_events(log: DataFrame) -> DataFrame:
    """User events; item and amount are null where the event has none. `event_ts` is `ts` as a
    timestamp, null when it is not ISO-8601."""
    fields = parsed_once(utf8("value"), USER_EVENT)
    return log.select(utf8("key").alias("message_key"), "partition", "offset", fields).withColumn(
        "event_ts", F.try_to_timestamp(F.col("ts"))
    )


def json_or_raw(log: DataFrame) -> DataFrame:
    """`payload` is the JSON text, or {"raw": text} for bytes that are not one JSON document or not UTF-8,
    with undecodable bytes replaced."""
    decoded = F.make_valid_utf8(utf8("value"))
    is_json = F.is_valid_utf8(utf8("value")) & F.col("_json").isNotNull()
    return with_json(log, decoded, "_json").select(
        utf8("key").alias("message_key"),
        "partition",
        "offset",
        (~F.coalesce(is_json, F.lit(False))).alias("is_raw"),
        F.when(is_json, decoded)
        .otherwise(F.to_json(F.struct(F.coalesce(decoded, F.lit("")).alias("raw"))))
        .alias("payload"),
    )


def to_log_records(df: DataFrame, key: str, topic: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Rows as keyed JSON messages, in the shape Spark's Kafka sink takes. Null fields are left out."""
    body = F.struct(*(fields or df.columns))
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(body).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def with_defaults(
    df: DataFrame, device_id: str = "", source: str | None = None, now_ms: Column | None = None
) -> DataFrame:
    """Fill what a sender left out: empty unit, a default device, and optionally source and time."""
    filled = {
        "unit": F.coalesce(F.col("unit"), F.lit("")),
        "device_id": F.coalesce(F.col("device_id"), F.lit(device_id)),
    }
    if source is not None:
        filled["source"] = F.lit(source)
        filled["timestamp"] = now_ms if now_ms is not None else F.unix_millis(F.current_timestamp())
    return df.withColumns(filled)
