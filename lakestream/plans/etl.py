"""Log to window statistics, streaming and batch, with one transformation for both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakestream.functions.payload import parse_readings
from lakestream.operators.quality import drop_malformed, flag_anomalies
from lakestream.operators.windows import LATENESS, WINDOW, window_stats
from lakestream.schemas import DEFAULT_RULES, READING_V1, SensorRules
from lakestream.sinks.batch import write_batch
from lakestream.sources.log import EARLIEST, LogConfig, StartPosition, read_log_batch, read_log_stream
from lakestream.streaming.supervise import run_queries
from lakestream.streaming.writers import STATS_TRIGGER, write_flagged, write_stream


def flagged_readings(
    log: DataFrame, rules: SensorRules = DEFAULT_RULES, schema: StructType = READING_V1
) -> DataFrame:
    """Log records to clean, flagged readings; the same for a batch and a stream."""
    return flag_anomalies(drop_malformed(parse_readings(log, schema)), rules)


def statistics(
    log: DataFrame,
    rules: SensorRules = DEFAULT_RULES,
    length: str = WINDOW,
    lateness: str = LATENESS,
) -> DataFrame:
    """Log records to window statistics; the watermark applies to streams only."""
    watermark = lateness if log.isStreaming else None
    return window_stats(flagged_readings(log, rules), length, watermark)


def run_etl(
    spark: SparkSession,
    cfg: LogConfig,
    root: str,
    rules: SensorRules = DEFAULT_RULES,
    keep_readings: bool = False,
    trigger: str | None = STATS_TRIGGER,
    start: StartPosition = EARLIEST,
) -> list[StreamingQuery]:
    """Closed windows to `root`/windows, and with `keep_readings` the flagged readings to
    `root`/readings. Checkpoints are under `root`/checkpoints. Blocks until the queries end."""
    log = read_log_stream(spark, cfg, start)
    starters = [
        lambda: write_stream(
            statistics(log, rules), f"{root}/windows", f"{root}/checkpoints/windows", trigger
        )
    ]
    if keep_readings:
        starters.append(
            lambda: write_flagged(
                flagged_readings(log, rules), f"{root}/readings", f"{root}/checkpoints/readings", trigger
            )
        )
    return run_queries(spark, starters)


def run_etl_batch(
    spark: SparkSession, cfg: LogConfig, path: str, rules: SensorRules = DEFAULT_RULES
) -> DataFrame:
    """The same statistics over everything the log holds now, replacing the earlier result."""
    write_batch(statistics(read_log_batch(spark, cfg), rules), path)
    return spark.read.parquet(path)
