"""What the training-data operators share: reading tables, folds, settled intermediate results."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.session import scratch_root

#: Rows handed to a Python worker at once; texts are a few kilobytes on average and may be megabytes long.
ARROW_ROWS = 512


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, UTC, and a folder for checkpoints (the cluster's; its own in a local session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return spark


def settled(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the shared checkpoint folder, where it outlives a lost executor."""
    ready(df.sparkSession)
    return df.checkpoint(eager=True)


def fold(key: Column, folds: int) -> Column:
    """The fold of a row: CRC32 of its key as text, modulo `folds`. A null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and nothing else, so that further columns cannot clash with derived ones."""
    return df.select(*(df[f"`{n}`"] for n in names))


def batches(table: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `max_bytes` at most (a single longer row is a batch of its own)."""
    for batch in table:
        rows = batch.num_rows
        pieces = max(1, min(rows, -(-batch.nbytes // max_bytes)))
        step = max(1, -(-rows // pieces))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def where(documents: DataFrame, text_col: str, keep: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows whose text `keep` accepts, all columns as they are, without a shuffle."""
    at = documents.columns.index(text_col)

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
