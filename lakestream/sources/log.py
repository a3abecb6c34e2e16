"""The event log as a bounded or streaming DataFrame.

In production the log is Kafka. The same reader takes any file format that holds records in the Kafka
source's columns (`schemas.LOG_RECORD`), which is how an archived topic is replayed and how this is tested.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakestream.schemas import LOG_RECORD, schema
from lakestream.sources.bounds import within
from lakestream.sources.time_index import first_by_index

Offsets = Mapping[str, Mapping[int, int]]

ENDS = schema(topic="string", partition="integer", end="long")


@dataclass(frozen=True)
class LogConfig:
    """Where the log is and how much of it one micro-batch takes."""

    topic: str
    bootstrap_servers: str = ""
    format: str = "kafka"
    path: str | None = None
    max_records_per_batch: int | None = None
    max_files_per_batch: int | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool = True
    extra: Mapping[str, str] = field(default_factory=dict)

    @property
    def is_kafka(self) -> bool:
        return self.format == "kafka"


@dataclass(frozen=True)
class StartPosition:
    """Where reading begins: everything, only what is new, given offsets, or a point in time.

    Resuming is not a position: a stream that restarts on its old checkpoint continues where it stopped
    whatever is given here, and replaying means starting on a fresh checkpoint.
    """

    kind: str
    offsets: Offsets | None = None
    epoch_ms: int | None = None

    @classmethod
    def earliest(cls) -> StartPosition:
        return cls("earliest")

    @classmethod
    def latest(cls) -> StartPosition:
        return cls("latest")

    resume = earliest

    @classmethod
    def at_offsets(cls, offsets: Offsets) -> StartPosition:
        return cls("offsets", offsets=offsets)

    @classmethod
    def at_time(cls, epoch_ms: int) -> StartPosition:
        return cls("timestamp", epoch_ms=epoch_ms)

    def kafka_options(self, edge: str = "starting") -> dict[str, str]:
        """Options of the Kafka source for the `starting` or the `ending` edge of a read."""
        if self.kind == "offsets":
            listed = {t: {str(p): o for p, o in ps.items()} for t, ps in self.offsets.items()}
            return {f"{edge}Offsets": json.dumps(listed, sort_keys=True)}
        if self.kind == "timestamp":
            return {f"{edge}Timestamp": str(self.epoch_ms)}
        return {f"{edge}Offsets": self.kind}

    def reached(self) -> Column:
        """The same position as a condition on file-log records: true from this position on.

        "latest", and its number -1, have no meaning for a fixed set of files; take the end offsets and use
        `at_offsets`. -2 is the earliest. Partitions that are not listed are read from their beginning
        here; Kafka demands that all be listed. A point in time is looked up first (`file_position`).
        """
        if self.kind == "offsets":
            passed = F.lit(True)
            for topic, partitions in self.offsets.items():
                for partition, offset in partitions.items():
                    if offset == -1:
                        raise ValueError("a file log has no latest position (-1); use its end offsets")
                    here = (F.col("topic") == topic) & (F.col("partition") == partition)
                    passed = passed & (~here | (F.col("offset") >= offset))
            return passed
        if self.kind == "earliest":
            return F.lit(True)
        raise ValueError(f"a file log cannot start at {self.kind!r}; use at_offsets(end offsets)")


EARLIEST = StartPosition.earliest()
LATEST = StartPosition.latest()


def _kafka_options(cfg: LogConfig) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": cfg.bootstrap_servers,
        "subscribe": cfg.topic,
        "failOnDataLoss": str(cfg.fail_on_data_loss).lower(),
        **cfg.extra,
    }
    if cfg.min_partitions:
        # more Spark tasks than topic partitions, so that one fat partition is read by several tasks
        options["minPartitions"] = str(cfg.min_partitions)
    return options


def stream_options(cfg: LogConfig, start: StartPosition = EARLIEST) -> dict[str, str]:
    """Options of a streaming read."""
    if cfg.is_kafka:
        options = _kafka_options(cfg) | start.kafka_options("starting")
        if cfg.max_records_per_batch:
            options["maxOffsetsPerTrigger"] = str(cfg.max_records_per_batch)
        return options
    options = dict(cfg.extra)
    if cfg.max_files_per_batch:
        options["maxFilesPerTrigger"] = str(cfg.max_files_per_batch)
    return options


def batch_options(
    cfg: LogConfig, start: StartPosition = EARLIEST, end: StartPosition = LATEST
) -> dict[str, str]:
    """Options of a bounded read."""
    if cfg.is_kafka:
        return _kafka_options(cfg) | start.kafka_options("starting") | end.kafka_options("ending")
    return dict(cfg.extra)


def first_at(log: DataFrame, epoch_ms: int) -> DataFrame:
    """Per partition the first offset whose record is from that time or later, and the end; one row per
    partition. Later records count from there on, whatever their time."""
    reached = F.col("timestamp") >= F.timestamp_millis(F.lit(epoch_ms))
    return log.groupBy("topic", "partition").agg(
        F.min(F.when(reached, F.col("offset"))).alias("first"), (F.max("offset") + 1).alias("end")
    )


def file_position(log: DataFrame, position: StartPosition, index: DataFrame | None = None) -> StartPosition:
    """A point in time as offsets of a file log, as Kafka looks it up: the first offset of each partition at or
    after it, however the records' times are ordered; the end where there is none. Other positions stay as
    they are. `index` (`sources.time_index`) spares reading the times of the whole log.
    """
    if position.kind != "timestamp":
        return position
    if index is None:
        found = first_at(log, position.epoch_ms)
    else:
        found = first_by_index(log, index, position.epoch_ms)
    offsets: dict[str, dict[int, int]] = {}
    for row in found.collect():  # a row per partition
        start = row["first"] if row["first"] is not None else row["end"]
        offsets.setdefault(row["topic"], {})[row["partition"]] = start
    return StartPosition.at_offsets(offsets)


def read_log_stream(
    spark: SparkSession, cfg: LogConfig, start: StartPosition = EARLIEST, index: DataFrame | None = None
) -> DataFrame:
    """The log as an unbounded DataFrame. A start in time is looked up among the files there are now; partitions
    that appear later are read from their beginning."""
    reader = spark.readStream.format(cfg.format).options(**stream_options(cfg, start))
    if cfg.is_kafka:
        return reader.load()
    if start.kind == "timestamp":
        start = file_position(read_log_batch(spark, cfg), start, index)
    return reader.schema(LOG_RECORD).load(cfg.path).filter(start.reached())


def read_log_batch(
    spark: SparkSession,
    cfg: LogConfig,
    start: StartPosition = EARLIEST,
    end: StartPosition = LATEST,
    index: DataFrame | None = None,
) -> DataFrame:
    """The log from `start` up to, not including, `end`."""
    reader = spark.read.format(cfg.format).options(**batch_options(cfg, start, end))
    if cfg.is_kafka:
        return reader.load()
    whole = reader.schema(LOG_RECORD).load(cfg.path)
    records = whole.filter(file_position(whole, start, index).reached())
    end = file_position(whole, end, index)
    if end.kind == "offsets":
        for topic, partitions in end.offsets.items():
            for partition, offset in partitions.items():
                here = (F.col("topic") == topic) & (F.col("partition") == partition)
                records = records.filter(~here | (F.col("offset") < offset))
    return records


def end_offsets(log: DataFrame) -> DataFrame:
    """The next offset each partition would assign: one row per partition, combined map-side."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end"))


def tail_positions(ends: Iterable[Row], seek_back: int) -> StartPosition:
    """Where to start reading for the last `seek_back` offsets of every partition, from rows with topic,
    partition and end: of `end_offsets`, a stream's positions, or a table of committed offsets. On Kafka
    this seeks, and nothing before is read."""
    starts: dict[str, dict[int, int]] = {}
    for row in ends:
        starts.setdefault(row["topic"], {})[row["partition"]] = max(0, row["end"] - seek_back)
    return StartPosition.at_offsets(starts)


SeekBack = int | Mapping[tuple[str, int], int]


def tail_log(log: DataFrame, seek_back: SeekBack, ends: Sequence[Row] | None = None) -> DataFrame:
    """The last `seek_back` offsets of every partition, of the raw log; empty partitions have none to give.
    How far back may be given for each (topic, partition).

    The ends, one row per partition, are fixed first (from three narrow columns, unless they are given), and
    the tail reaches up to them: records and partitions that arrive later are not in it.
    """
    rows = list(ends) if ends is not None else end_offsets(log).collect()

    def back(row: Row) -> int:
        return seek_back if isinstance(seek_back, int) else seek_back[row["topic"], row["partition"]]

    return within(log, [(r["topic"], r["partition"], max(0, r["end"] - back(r)), r["end"]) for r in rows])


def seek_back_for(n: int) -> int:
    """How far back to look first for the n newest readings of one sensor: fixed values 3n, at least 30."""
    return max(3 * n, 30)
