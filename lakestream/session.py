"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from lakestream.functions.folders import delete_folder

SCRATCH_SETTING = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Date parts, hours and ISO texts are in UTC everywhere in this library, and of a key repeated in a
    JSON object the last one counts."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def _sibling(spark: SparkSession) -> SparkSession:
    """A session of the same application that starts with this one's settings."""
    session = spark.newSession()
    theirs = session.conf.getAll
    for name, value in spark.conf.getAll.items():
        if theirs.get(name) != value and session.conf.isModifiable(name):
            session.conf.set(name, value)
    return prepare(session)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for tables and stream checkpoints, as the cluster names it.

    Only a local session without the setting gets a folder of its own: on a cluster a folder of one
    machine would be invisible to the others, so that case is an error.
    """
    root = spark.conf.get(SCRATCH_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SCRATCH_SETTING} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set(SCRATCH_SETTING, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{scratch_root(spark)}/lakestream/{uuid.uuid4().hex}/{label}"


def streaming_session(
    spark: SparkSession, state_partitions: int | None = None, large_state: bool = False
) -> SparkSession:
    """A session of the same application for stateful streams.

    AQE cannot shrink a stateful shuffle, and its partition count is fixed by the first checkpoint, so it
    follows the cluster's cores instead of the batch default. Windows per sensor are little state, which
    the in-memory store serves fastest; `large_state`, for positions remembered by a deduplicating stream,
    keeps it in RocksDB off the heap.
    """
    session = _sibling(spark)
    session.conf.set(
        "spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism)
    )
    if large_state:
        store = "spark.sql.streaming.stateStore"
        session.conf.set(
            f"{store}.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        session.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")
    return session


def drop_scratch(spark: SparkSession) -> None:
    """Remove every table and checkpoint this library has written to the shared folder; when the results
    that read them have been used."""
    root = spark.conf.get(SCRATCH_SETTING, None)
    if root:
        delete_folder(spark, f"{root.rstrip('/')}/lakestream")


def text_partitions_session(spark: SparkSession) -> SparkSession:
    """A session that takes partition values as the text in the directory's name, so that a sensor `001`
    is not read as the number 1."""
    session = _sibling(spark)
    session.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return session


def listing_session(spark: SparkSession) -> SparkSession:
    """A session for queries that list files without reading them; partition values are text.

    Spark packs files into tasks by their size, so listing 100 TB would take a task per 128 MB although
    nothing is read; here the number of tasks follows the cluster's cores.
    """
    session = text_partitions_session(spark)
    tasks = 4 * spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.files.maxPartitionNum", str(tasks))
    return session
