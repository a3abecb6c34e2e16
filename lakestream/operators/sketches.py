"""Summaries that are stored once and merged later, so that a longer span does not read its readings again: quantile
sketches of delays, and presence bitmaps of numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Accuracy of a sketch. Its rank error is below 1.4 % for one quantile with high probability at 200, and falls about
#: in proportion to one over this.
SKETCH_K = 400
#: Numbers of a bitmap (fixed value: 4096 bytes).
BITMAP_NUMBERS = 32_768


# --- delays ----------------------------------------------------------------------------------------


def delay_ms() -> Column:
    return F.unix_millis("kafka_timestamp") - F.unix_millis("event_time")


def delay_sketches(readings: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Per hour of arrival a sketch of how long readings were under way, and how many they are. Readings without
    one of the times are left out. A task sends a sketch per hour, whatever the number of readings."""
    timed = readings.withColumn("_delay", delay_ms()).filter(F.col("_delay").isNotNull())
    return timed.groupBy(F.date_trunc("hour", "kafka_timestamp").alias("arrival_hour")).agg(
        F.count("_delay").alias("readings"), F.kll_sketch_agg_bigint("_delay", k).alias("sketch")
    )


def merged_sketches(sketches: DataFrame, by: Sequence[Column | str], k: int = SKETCH_K) -> DataFrame:
    """Stored sketches of several hours as one per group."""
    return sketches.groupBy(*by).agg(
        F.sum("readings").alias("readings"), F.kll_merge_agg_bigint("sketch", k).alias("sketch")
    )


def sketch_quantiles(sketches: DataFrame, quantiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """`p50_ms` and so on of each sketch, in its place."""
    found = [
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q))).alias(f"p{round(q * 100)}_ms") for q in quantiles
    ]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], *found)


# --- presence --------------------------------------------------------------------------------------


def presence_bitmaps(messages: DataFrame, by: Sequence[Column | str], number: str = "seq") -> DataFrame:
    """Which numbers arrived, as a bitmap for every 32,768 of them: the columns of `by`, `bucket` and `bitmap`. Numbers
    from 1 on; repeats are one. Bits are set in the tasks, so a shuffle carries bitmaps."""
    numbered = messages.filter(F.col(number) >= 1)
    return numbered.groupBy(*by, F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap")
    )


def merged_bitmaps(bitmaps: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """Stored bitmaps of several days, or topics, as one per group and bucket."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def missing_ranges(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Ranges of numbers that did not arrive between the first and the last that did: the columns of `by`, `first`,
    `last` and `missing`.

    Only bytes that are not full are taken apart. Holes inside a bucket are found in it; a row per bucket tells of
    those between, missing buckets included.
    """
    hexed = bitmaps.withColumn("_hex", F.hex("bitmap"))
    byte = F.conv(F.substr("_hex", F.col("_byte") * 2 + 1, F.lit(2)), 16, 10).cast("int")
    base = (F.col("bucket") - 1) * BITMAP_NUMBERS
    # the numbers that are there, of bytes that are neither full nor empty; of full ones the ends
    some = hexed.select(*by, "bucket", F.explode(F.sequence(F.lit(0), F.lit(4095))).alias("_byte"), "_hex")
    some = some.select(*by, "bucket", (base + F.col("_byte") * 8).alias("_low"), byte.alias("_bits")).filter("_bits > 0")
    bits = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda i: F.getbit("_bits", i) == 1)
    ends = F.when(F.col("_bits") == 255, F.array(F.struct(F.lit(0).alias("a"), F.lit(7).alias("b")))).otherwise(
        F.transform(bits, lambda i: F.struct(i.alias("a"), i.alias("b")))
    )
    spans = some.select(*by, "bucket", "_low", F.explode(ends).alias("_span")).select(
        *by, "bucket", (F.col("_low") + F.col("_span.a") + 1).alias("a"), (F.col("_low") + F.col("_span.b") + 1).alias("b")
    )
    within = W.partitionBy(*by, "bucket").orderBy("a")
    inside = spans.withColumn("after", F.lag("b").over(within)).select(*by, "after", F.col("a").alias("next"))
    edges = spans.groupBy(*by, "bucket").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    along = W.partitionBy(*by).orderBy("bucket")
    between = edges.withColumn("after", F.lag("b").over(along)).select(*by, "after", F.col("a").alias("next"))
    holes = inside.unionByName(between).filter(F.col("next") > F.col("after") + 1)
    first, last = F.col("after") + 1, F.col("next") - 1
    return holes.select(*by, first.alias("first"), last.alias("last"), (last - first + 1).alias("missing"))
