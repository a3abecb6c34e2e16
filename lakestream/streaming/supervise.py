"""Running several queries together, and what they report about themselves."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lakestream.functions.folders import exists
from lakestream.operators.log_audit import offsets_from_json


def run_queries(
    spark: SparkSession, starters: Sequence[Callable[[], StreamingQuery]]
) -> list[StreamingQuery]:
    """Start queries and wait for all of them. If one fails, or the caller is interrupted, the others
    are stopped and the error is raised."""
    running: list[StreamingQuery] = []
    try:
        for start in starters:
            running.append(start())
        while any(q.isActive for q in running):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
            _raise_failure(running)
        _raise_failure(running)
    finally:
        for query in running:
            if query.isActive:
                query.stop()
    return running


def _raise_failure(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        failure = query.exception()
        if failure is not None:
            raise failure


@dataclass
class RunTotals:
    """Running totals of one query run."""

    name: str | None
    batches: int = 0
    messages: int = 0
    dropped_late: int = 0
    busy_ms: int = 0


class ProgressTotals(StreamingQueryListener):
    """Adds up what every query run reports, in a fixed amount of memory per run."""

    def __init__(self) -> None:
        self.runs: dict[str, RunTotals] = {}
        self.finished = 0

    def onQueryStarted(self, event) -> None:
        self.runs[str(event.runId)] = RunTotals(event.name)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run = self.runs.setdefault(str(progress.runId), RunTotals(progress.name))
        run.batches += 1
        run.messages += progress.numInputRows
        run.busy_ms += progress.batchDuration
        run.dropped_late += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.finished += 1

    def settle(self, runs: int, seconds: float = 30.0) -> None:
        """Reports arrive on their own thread, shortly after the query; wait until that many runs ended."""
        until = time.monotonic() + seconds
        while self.finished < runs and time.monotonic() < until:
            time.sleep(0.05)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (run_id, r.name, r.batches, r.messages, r.dropped_late, r.busy_ms)
            for run_id, r in self.runs.items()
        ]
        return spark.createDataFrame(
            rows,
            "run_id string, name string, batches bigint, messages bigint, "
            "dropped_late bigint, busy_ms bigint",
        )


def query_throughput(totals: DataFrame) -> DataFrame:
    """Messages, elapsed seconds and messages per second of each run; null for a run with no work."""
    seconds = F.col("busy_ms") / F.lit(1000.0)
    return totals.select(
        "run_id",
        "name",
        "batches",
        "messages",
        seconds.alias("elapsed_seconds"),
        F.try_divide(F.col("messages").cast("double"), seconds).alias("messages_per_second"),
    )


def late_rows(totals: DataFrame) -> DataFrame:
    """Rows each run dropped because their window was closed."""
    return totals.select("run_id", "name", F.col("dropped_late").alias("late_rows"))


def progress_rows(query: StreamingQuery) -> list[dict]:
    """The progress reports a query still remembers, as plain dictionaries."""
    return [json.loads(p.json) for p in query.recentProgress]


def stream_positions(spark: SparkSession, progress: dict) -> tuple[DataFrame, DataFrame]:
    """(ends, committed) of a running Kafka query, ready for `log_audit.lag_table`: the newest offsets
    its source knew and the ones it had read up to."""
    sources = progress["sources"]

    def documents(name: str) -> list[str]:
        found = [s.get(name) for s in sources if s.get(name)]
        return [d if isinstance(d, str) else json.dumps(d) for d in found]

    ends = offsets_from_json(spark, "end", *documents("latestOffset"))
    return ends, offsets_from_json(spark, "committed", *documents("endOffset"))


def committed_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a Kafka stream has committed, from its checkpoint folder: topic, partition and `committed`, ready for
    `log_audit.lag_table`; no rows before the first commit. The stream need not run."""
    if not exists(spark, f"{checkpoint}/commits"):
        return offsets_from_json(spark, "committed", "{}")
    names = spark.read.text(f"{checkpoint}/commits").select(F.expr("try_cast(_metadata.file_name AS int)").alias("n"))
    last = names.agg(F.max("n")).first()[0]
    if last is None:
        return offsets_from_json(spark, "committed", "{}")
    lines = spark.read.text(f"{checkpoint}/offsets/{last}", wholetext=True).first()[0].splitlines()
    # the format's version, the batch's metadata, then a line per source; of other sources than Kafka no JSON of topics
    found = [line for line in lines[2:] if line.startswith("{") and '"logOffset"' not in line]
    return offsets_from_json(spark, "committed", *found or ["{}"])


def window_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows that a stream of `operators.windows.window_stats` still holds, from its checkpoint: window_start,
    window_end and sensor, a row for each window that the watermark has not closed. The stream need not run; each
    partition of the state is read by a task."""
    state = spark.read.format("statestore").load(checkpoint)
    keys = state.select("key.*")
    window = next(f.name for f in keys.schema.fields if f.dataType.typeName() == "struct")
    sensor = next(c for c in keys.columns if c != window)
    return keys.select(
        F.col(f"`{window}`.start").alias("window_start"), F.col(f"`{window}`.end").alias("window_end"), F.col(f"`{sensor}`").alias("sensor")
    )
