"""Ranges of offsets of a log's partitions, one or a few per partition, as filters.

Up to `PUSHED_PARTITIONS` of them are a condition that reaches the scan, so that files and row groups outside are not
read; more are a join with a small table. What is returned does not depend on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.schemas import schema

PUSHED_PARTITIONS = 200
BOUNDS = schema(topic="string", partition="integer", start="long", end="long")

Bound = tuple[str, int, int, int]


def within(log: DataFrame, bounds: Sequence[Bound]) -> DataFrame:
    """Records of the listed ranges (topic, partition, first offset, end), one for each partition at most."""
    if len(bounds) <= PUSHED_PARTITIONS:
        inside = F.lit(False)
        for topic, partition, start, end in bounds:
            here = (F.col("topic") == topic) & (F.col("partition") == partition)
            inside = inside | (here & (F.col("offset") >= start) & (F.col("offset") < end))
        return log.filter(inside)
    fixed = log.sparkSession.createDataFrame(list(bounds), BOUNDS)
    inside = (F.col("offset") >= F.col("start")) & (F.col("offset") < F.col("end"))
    return log.join(F.broadcast(fixed), ["topic", "partition"]).filter(inside).select(log.columns)


def beyond(log: DataFrame, bounds: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Records from the given offsets on (topic, partition, first offset), and all of partitions not listed."""
    if len(bounds) <= PUSHED_PARTITIONS:
        for topic, partition, start in bounds:
            here = (F.col("topic") == topic) & (F.col("partition") == partition)
            log = log.filter(~here | (F.col("offset") >= start))
        return log
    known = log.sparkSession.createDataFrame(list(bounds), "topic string, partition int, _start long")
    joined = log.join(F.broadcast(known), ["topic", "partition"], "left")
    return joined.filter(F.coalesce(F.col("offset") >= F.col("_start"), F.lit(True))).select(log.columns)
