"""Serving and auditing the log: latest readings, batch statistics, lag, gaps, losses, delays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakestream.functions.columns import epoch_ms_to_iso, names_where, round_half_up
from lakestream.functions.ordered import (
    BUCKET_WIDTH,
    running_max_before,
    running_total,
    with_bucket,
)
from lakestream.functions.payload import parse_readings
from lakestream.operators.quality import only_sensor, reason_names, rejection_bits
from lakestream.schemas import DEFAULT_RULES, SensorRules
from lakestream.sources.log import end_offsets, seek_back_for, tail_log

PARTITION = ("topic", "partition")
# Fixed value: messages per chunk of the batch statistics.
CHUNK = 50
# Fixed value: a partition this far behind is flagged.
HIGH_LAG = 50
#: Deduplication shuffles all records if they are no more than this, or if one in so many is a repeat.
PLAIN_ROWS, MANY_REPEATS = 2_000_000, 20


def _partition_columns(*frames: DataFrame) -> list[str]:
    """What identifies a log partition: the topic too, where the rows carry it."""
    return [c for c in PARTITION if all(c in df.columns for df in frames)]


# --- serving ---------------------------------------------------------------------------------------


def _latest_columns() -> list[Column]:
    ms = F.unix_millis("event_time")
    return [
        F.col("sensor").alias("sensor_type"),
        F.col("value"),
        F.coalesce("unit", F.lit("")).alias("unit"),
        F.coalesce("device_id", F.lit("")).alias("device_id"),
        ms.alias("timestamp"),
        epoch_ms_to_iso(ms).alias("event_time"),
        F.col("partition"),
        F.col("offset"),
    ]


def latest_readings(readings: DataFrame, n: int = 1, sensor: str | None = None) -> DataFrame:
    """The n newest readings of every sensor (or of one), of all rows of `parse_readings` given. A missing
    time counts as 0; equal times are ordered by partition and offset."""
    wanted = only_sensor(readings, sensor, "sensor").filter(F.col("sensor").isNotNull())
    age = F.coalesce(F.unix_millis("event_time"), F.lit(0))
    newest_first = W.partitionBy("sensor").orderBy(age.desc(), F.desc("partition"), F.desc("offset"))
    # the rank limit is applied in every map task before the shuffle, so a hot sensor sends n rows per task, and the
    # log is parsed once
    ranked = wanted.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") <= n)
    return ranked.select(*_latest_columns(), *([F.col("_rank").alias("rank")] if n > 1 else []))


def latest_of_log(
    log: DataFrame,
    n: int,
    sensor: str,
    seek_back: int | None = None,
    extend: bool = True,
    ends: Sequence[Row] | None = None,
) -> DataFrame:
    """The n newest readings of one sensor near the ends of a raw log's partitions, parsing only the tails.

    A partition's tail begins `seek_back` offsets before its end. One that holds fewer than n readings of the
    sensor is made four times as long, until it has n or is read to its start, whatever the others have found: a
    partition where the sensor is quiet may still hold the newest. So the answer is exact wherever times follow
    offsets within a partition; `latest_readings` over the whole log is for times that run out of order. A
    sensor that a partition never had is looked for in all of it; pass the `ends` of the partitions that matter
    where the key decides the partition. With `extend=False` the tails stay as they are, and the answer is
    partial. The ends are looked up once.
    """
    rows = list(ends) if ends is not None else end_offsets(log).collect()
    back = {(r["topic"], r["partition"]): seek_back or seek_back_for(n) for r in rows}
    short = [r for r in rows if r["end"] > back[r["topic"], r["partition"]]] if extend else []
    while short:
        parsed = parse_readings(tail_log(log, back, short), extra=["topic"])
        mine = only_sensor(parsed, sensor, "sensor").groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("found"))
        enough = {(r["topic"], r["partition"]) for r in mine.filter(F.col("found") >= n).collect()}
        short = [r for r in short if (r["topic"], r["partition"]) not in enough]
        for r in short:
            back[r["topic"], r["partition"]] *= 4
        # what is read to its start now has nothing more to give
        short = [r for r in short if r["end"] > back[r["topic"], r["partition"]]]
    return latest_readings(parse_readings(tail_log(log, back, rows)), n, sensor)


def batch_parts(readings: DataFrame, n: int = CHUNK, key: str = "message_key") -> DataFrame:
    """Per key and chunk of n consecutive offsets of a partition: count, sum and extremes, which can be merged with
    those of the rest of the chunk.

    Chunks follow offsets, not the order in which a consumer happened to poll its partitions, so a rerun
    gives the same chunks. Records without a key are left out.
    """
    return (
        readings.filter(F.col(key) != "")
        .groupBy(
            *_partition_columns(readings),
            F.expr(f"offset div {int(n)}").alias("chunk"),
            F.col(key).alias("sensor"),
        )
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.count("value").alias("values"),
            F.sum("value").alias("total"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )


def merged_batch_parts(parts: DataFrame) -> DataFrame:
    """The parts of each chunk, however micro-batches cut it, as one."""
    return parts.groupBy(*_partition_columns(parts), "chunk", "sensor").agg(
        F.sum("count").alias("count"),
        F.sum("values").alias("values"),
        F.sum("total").alias("total"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )


def finished_batch_stats(parts: DataFrame) -> DataFrame:
    """Count, extremes and average of each chunk of `batch_parts`."""
    return parts.select(
        *_partition_columns(parts),
        "chunk",
        "sensor",
        "count",
        round_half_up(F.col("min"), 2).alias("min"),
        round_half_up(F.col("max"), 2).alias("max"),
        round_half_up(F.try_divide("total", "values"), 2).alias("avg"),
    )


def batch_stats(readings: DataFrame, n: int = CHUNK, key: str = "message_key") -> DataFrame:
    """Count, extremes and average per key over chunks of n consecutive offsets of a partition."""
    return finished_batch_stats(batch_parts(readings, n, key))


# --- consumer lag ----------------------------------------------------------------------------------


def lag_table(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Per partition how far a consumer is behind. A negative or absent committed offset means nothing
    was committed, and a consumer ahead of a truncated log has no lag."""
    position = F.coalesce(F.when(F.col("committed") >= 0, F.col("committed")), F.lit(0))
    return ends.join(committed, list(PARTITION), "left").select(
        *PARTITION,
        position.alias("committed"),
        "end",
        F.greatest(F.lit(0), F.col("end") - position).alias("lag"),
    )


def lag_flags(lag: DataFrame, high: int = HIGH_LAG) -> DataFrame:
    """Each partition as ok, behind, or high."""
    flag = F.when(F.col("lag") > high, "high").when(F.col("lag") == 0, "ok").otherwise("behind")
    return lag.withColumn("flag", flag)


def lag_status(lag: DataFrame) -> DataFrame:
    """Total lag per topic and whether the consumer has caught up."""
    total = F.sum("lag")
    return lag.groupBy("topic").agg(
        total.alias("total_lag"),
        F.when(total == 0, "HEALTHY").otherwise("BEHIND").alias("status"),
    )


# --- order and completeness ------------------------------------------------------------------------


def key_partitions(log: DataFrame, key: str = "key") -> DataFrame:
    """Where each key has been written. Equal keys keep their order only if `single` holds.

    Counting per (key, partition) first leaves at most one row per partition to gather for a key.
    """
    spread = log.groupBy("topic", F.col(key).alias("key"), "partition").agg(
        F.count(F.lit(1)).alias("records")
    )
    return spread.groupBy("topic", "key").agg(
        F.sum("records").alias("records"),
        F.count(F.lit(1)).alias("partitions"),
        F.sort_array(F.collect_list("partition")).alias("partition_list"),
        (F.count(F.lit(1)) == 1).alias("single"),
    )


def _distinct_offsets(log: DataFrame) -> DataFrame:
    """Copies are counted map-side first, so that an offset delivered many times is one row."""
    return log.groupBy(*PARTITION, "offset").agg(F.count(F.lit(1)).alias("copies"))


def partition_completeness(log: DataFrame) -> DataFrame:
    """Per partition the offset range, and how many offsets are missing from it or repeated."""
    return (
        _distinct_offsets(log)
        .groupBy(*PARTITION)
        .agg(
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.sum("copies").alias("records"),
            (F.max("offset") - F.min("offset") + 1 - F.count(F.lit(1))).alias("missing"),
            (F.sum("copies") - F.count(F.lit(1))).alias("repeats"),
        )
    )


def offset_gaps(log: DataFrame, width: int = BUCKET_WIDTH) -> DataFrame:
    """Every hole in the offsets: the offset before it, the one after it, and how many are missing.

    Each bucket of `width` offsets is summed up before the shuffle: its first and last offset, and the
    exclusive or of the hashes of all. Where that equals the exclusive or over the range from first to last,
    every offset of the range is there an odd number of times, so there is no hole (but for a collision of
    64-bit hashes). Only the positions of the other buckets are shuffled and compared with their
    neighbours; the borders between buckets come from the first and last offset of each. A healthy log is
    one map-side aggregate, and no task ever sees a whole partition.
    """
    bucketed = with_bucket(log.select(*PARTITION, "offset"), "offset", width)
    # said here, or the join below says it of one side alone and the two uses of `edges` do not share a shuffle
    for column in (*PARTITION, "_bucket"):
        bucketed = bucketed.filter(F.col(column).isNotNull())
    edges = bucketed.groupBy(*PARTITION, "_bucket").agg(
        F.min("offset").alias("first"),
        F.max("offset").alias("last"),
        F.bit_xor(F.when(F.col("offset").isNotNull(), F.xxhash64("offset"))).alias("_mark"),
    )
    edges = edges.filter(F.col("_mark").isNotNull())
    expected = F.aggregate(
        F.sequence("first", "last"), F.lit(0).cast("long"), lambda mark, i: mark.bitwiseXOR(F.xxhash64(i))
    )
    suspects = edges.filter(F.col("_mark") != expected).select(*PARTITION, "_bucket")
    offsets = with_bucket(
        _distinct_offsets(bucketed.join(suspects, [*PARTITION, "_bucket"], "left_semi")), "offset", width
    )
    inside = W.partitionBy(*PARTITION, "_bucket").orderBy("offset")
    within = offsets.select(
        *PARTITION, F.lag("offset").over(inside).alias("after_offset"), F.col("offset").alias("next_offset")
    )
    along = W.partitionBy(*PARTITION).orderBy("_bucket")
    across = edges.select(
        *PARTITION, F.lag("last").over(along).alias("after_offset"), F.col("first").alias("next_offset")
    )
    missing = F.col("next_offset") - F.col("after_offset") - 1
    return within.unionByName(across).withColumn("missing", missing).filter("missing > 0")


def sequence_counts(messages: DataFrame, expected: int, seq: str = "seq") -> DataFrame:
    """Per sequence number 0..expected-1, and any beyond, how often it arrived."""
    wanted = messages.sparkSession.range(expected).withColumnRenamed("id", "seq")
    arrived = messages.groupBy(F.col(seq).alias("seq")).agg(F.count(F.lit(1)).alias("copies"))
    status = (
        F.when(F.col("copies").isNull(), "missing")
        .when((F.col("seq") < 0) | (F.col("seq") >= expected) | F.col("seq").isNull(), "unexpected")
        .when(F.col("copies") > 1, "repeated")
        .otherwise("ok")
    )
    return (
        wanted.join(arrived, "seq", "full_outer")
        .withColumn("status", status)
        .withColumn("copies", F.coalesce("copies", F.lit(0)))
    )


def sequence_audit(messages: DataFrame, expected: int, seq: str = "seq") -> DataFrame:
    """Did everything arrive? `enough` is the plain count test, which repeats can satisfy while numbers
    are missing; `complete` is the strict one."""
    missing = F.count_if(F.col("status") == "missing")
    received = F.coalesce(F.sum("copies"), F.lit(0))
    return sequence_counts(messages, expected, seq).agg(
        F.lit(expected).cast("bigint").alias("expected"),
        received.alias("received"),
        missing.alias("missing"),
        F.count_if(F.col("status") == "repeated").alias("repeated"),
        F.count_if(F.col("status") == "unexpected").alias("unexpected"),
        (received >= expected).alias("enough"),
        (missing == 0).alias("complete"),
    )


def dedupe_log(
    log: DataFrame,
    keys: Sequence[str] = ("topic", "partition", "offset"),
    event_time: str = "timestamp",
    within: str = "10 minutes",
    plain_rows: int = PLAIN_ROWS,
) -> DataFrame:
    """A re-delivered record has no second effect. On a stream the positions already seen are remembered
    for `within`, so state does not grow with the log.

    In a batch the positions delivered more than once are found from the key columns alone; records delivered
    once, payloads and all, stay where they are read. That pays where the log is large and repeats are few: up to
    `plain_rows` records, or where more than one in `MANY_REPEATS` is a repeat, all records are shuffled once
    instead. Which of several copies is kept is not defined. Null keys count as equal.
    """
    if log.isStreaming:
        return log.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(keys))
    positions = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    if plain_rows and log.count() <= plain_rows:
        return log.dropDuplicates(list(keys))
    again = F.sum(F.when(F.col("_copies") > 1, F.col("_copies")))
    records, repeats = positions.agg(F.sum("_copies"), F.coalesce(again, F.lit(0))).first()
    if (records or 0) < MANY_REPEATS * repeats:
        return log.dropDuplicates(list(keys))
    repeated = positions.filter("_copies > 1")
    marks = repeated.select(*[F.col(k).alias(f"_again_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_again_{k}")) for k in keys])
    once = log.join(marks, same, "left_anti")
    return once.unionByName(log.join(marks, same, "left_semi").dropDuplicates(list(keys)))


# --- time ------------------------------------------------------------------------------------------


def late_events(
    readings: DataFrame,
    window: str = "5 minutes",
    lateness: str = "2 minutes",
    event_time: str = "event_time",
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Readings whose window a stream with this watermark would already have closed, had it processed
    the log record by record: the window's end is not after the largest time seen earlier in the
    partition, less the tolerated lateness. Copies of a record are one row with their number."""
    # the bucket maxima and the rows come from one shuffle of this: both need `copies`, and the filter the
    # join would add to one side is on both
    partition = _partition_columns(readings)
    positions = (
        readings.groupBy(*partition, "offset", "sensor", event_time)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("_time", F.when(F.col("copies") > 0, F.col(event_time)))
    )
    for column in partition:
        positions = positions.filter(F.col(column).isNotNull())
    ordered = running_max_before(positions, partition, "offset", "_time", "seen", width)
    closes = F.window(F.col(event_time), window)["end"]
    watermark = F.col("seen") - F.expr(f"INTERVAL {lateness}")
    return (
        ordered.withColumns({"window_end": closes, "watermark": watermark})
        .filter(F.col("window_end") <= F.col("watermark"))
        .drop("seen", "_time")
    )


def ingestion_delay(readings: DataFrame, late_after_ms: int = 120_000) -> DataFrame:
    """Per hour of arrival: how long readings were under way, and how many belong to an earlier day's
    directory than the one they arrived on."""
    delay = F.unix_millis("kafka_timestamp") - F.unix_millis("event_time")
    return (
        readings.withColumn("_delay", delay)
        .groupBy(F.date_trunc("hour", "kafka_timestamp").alias("arrival_hour"))
        .agg(
            F.count("_delay").alias("readings"),
            F.min("_delay").alias("min_delay_ms"),
            round_half_up(F.avg("_delay"), 3).alias("avg_delay_ms"),
            F.max("_delay").alias("max_delay_ms"),
            F.count_if(F.col("_delay") > late_after_ms).alias("late"),
            F.count_if(F.to_date("event_time") < F.to_date("kafka_timestamp")).alias("earlier_day"),
        )
    )


def delay_quantiles(
    readings: DataFrame, quantiles: Sequence[float] = (0.5, 0.95, 0.99), resolution_ms: int = 1000
) -> DataFrame:
    """Delay quantiles per hour of arrival, exact at the given resolution: readings are first counted
    per delay step, and only the steps are accumulated, in buckets, as wrong clocks can make them many."""
    delay = F.unix_millis("kafka_timestamp") - F.unix_millis("event_time")
    steps = (
        readings.filter(F.col("event_time").isNotNull())
        .groupBy(
            F.date_trunc("hour", "kafka_timestamp").alias("arrival_hour"),
            F.floor(delay / F.lit(resolution_ms)).alias("step"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        # said here, the join on the hour adds it to neither side alone, and both read one shuffle
        .filter(F.col("arrival_hour").isNotNull())
    )
    placed = running_total(steps, ["arrival_hour"], "step", "n", "upto", "readings")
    reached = [F.col("upto") >= F.ceil(F.col("readings") * F.lit(q)) for q in quantiles]
    picks = [
        (F.min(F.when(hit, F.col("step"))) * F.lit(resolution_ms)).alias(f"p{round(q * 100)}_ms")
        for q, hit in zip(quantiles, reached)
    ]
    return placed.groupBy("arrival_hour").agg(*picks)


# --- agreement -------------------------------------------------------------------------------------


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides, with `surplus` > 0 where left has more.
    One combined count per distinct row and one shuffle, instead of two exceptAll."""
    columns = [F.col(f"`{c}`") for c in left.columns]
    both = left.withColumn("_n", F.lit(1)).unionByName(
        right.select(*columns).withColumn("_n", F.lit(-1))
    )
    return both.groupBy(*columns).agg(F.sum("_n").alias("surplus")).filter("surplus <> 0")


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row with different seeds.

    Spark's hash passes over nulls, so that (null, 'x') and ('x', null) would be alike; every column is
    hashed with a flag for null, and nested values as JSON that spells their nulls out.
    """
    parts = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith(("struct", "array", "map")):
            text = F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"})
            parts += [column.isNull(), text]
        else:
            parts += [column.isNull(), column]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)


def fingerprint_columns(df: DataFrame) -> list[Column]:
    """Aggregates that are equal for equal multisets of rows: the count, and two sums of row hashes."""
    first, second = row_hashes(df)
    return [
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(first.cast("decimal(28,0)")), F.lit(0)).alias("sum_1"),
        F.coalesce(F.sum(second.cast("decimal(28,0)")), F.lit(0)).alias("sum_2"),
    ]


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that differs, but for a collision of 64-bit hashes in both sums, between tables that do not
    hold the same rows equally often. A map-side aggregate, so it compares tables too large to shuffle."""
    return df.agg(*fingerprint_columns(df))


def same_rows(left: DataFrame, right: DataFrame, exact: bool = False) -> bool:
    """Whether both hold the same rows equally often: by fingerprint, or `exact`ly by comparing counts of
    every distinct row, which shuffles both. Tables with different columns never do."""
    if set(left.dtypes) != set(right.dtypes):
        return False
    right = right.select(*[F.col(f"`{c}`") for c in left.columns])
    if exact:
        return multiset_diff(left, right).isEmpty()
    return fingerprint(left).first() == fingerprint(right).first()


def compare_results(
    left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: float = 0.0
) -> DataFrame:
    """Two results with unique, non-null keys: the keys that disagree, and in which columns."""
    values = [c for c in left.columns if c not in keys]
    types = dict(left.dtypes)
    named = [F.col(f"`{c}`") for c in values]
    keys = [f"`{k}`" for k in keys]
    pair_l = left.select(*keys, F.struct(*named, F.lit(True).alias("_in")).alias("_l"))
    pair_r = right.select(*keys, F.struct(*named, F.lit(True).alias("_in")).alias("_r"))

    def differs(column: str) -> Column:
        a, b = F.col(f"_l.`{column}`"), F.col(f"_r.`{column}`")
        same = a.eqNullSafe(b)
        if tolerance and types[column] in ("double", "float"):
            same = same | F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))
        return ~same

    status = (
        F.when(F.col("_r").isNull(), "only_left")
        .when(F.col("_l").isNull(), "only_right")
        .when(F.size("differences") > 0, "differs")
    )
    return (
        pair_l.join(pair_r, [k[1:-1] for k in keys], "full_outer")
        .withColumn("differences", names_where({c: differs(c) for c in values}))
        .withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .select(*keys, "status", "differences")
    )


def reconcile(
    raw_readings: DataFrame, curated: DataFrame, rules: SensorRules = DEFAULT_RULES
) -> DataFrame:
    """What became of every raw offset: curated, rejected (with reasons), lost, or duplicated; and
    offsets of the curated zone that raw does not have, as unexpected."""
    position = [*_partition_columns(raw_readings, curated), "offset"]
    raw = raw_readings.select(*position, rejection_bits(rules).alias("bits"), F.lit(0).alias("kept"))
    kept = curated.select(*position, F.lit(None).cast("int").alias("bits"), F.lit(1).alias("kept"))
    # one shuffle of four numbers per row, combined before it, instead of joining two aggregates
    fate = (
        raw.unionByName(kept)
        .groupBy(*position)
        .agg(F.max("bits").alias("bits"), F.sum("kept").alias("copies"))
    )
    status = (
        F.when(F.col("bits").isNull(), "unexpected")
        .when(F.col("copies") > 1, "duplicated")
        .when(F.col("copies") == 1, "curated")
        .when(F.col("bits") > 0, "rejected")
        .otherwise("lost")
    )
    return fate.select(
        *position, "copies", reason_names(F.col("bits")).alias("reasons"), status.alias("status")
    )


def reconcile_summary(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("status").agg(F.count(F.lit(1)).alias("offsets"))


def offsets_from_json(spark: SparkSession, column: str, *documents: str) -> DataFrame:
    """Kafka offsets as a stream's progress reports them, {"topic": {"0": 12}}, as rows."""
    listed = spark.createDataFrame([(d,) for d in documents], "doc string")
    by_topic = listed.select(
        F.explode(F.from_json("doc", "map<string,map<string,bigint>>")).alias("topic", "offsets")
    )
    return by_topic.select("topic", F.explode("offsets").alias("p", column)).select(
        "topic", F.col("p").cast("int").alias("partition"), column
    )
