"""The files of the lake: inventory, small files, directory sizes, pruning."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.functions.columns import human_bytes
from lakestream.session import listing_session

# More than this many files, smaller than this on average, are worth compacting.
SMALL_FILE_BYTES = 1024 * 1024
SMALL_FILE_COUNT = 10

_INVENTORY = "path string, length bigint"


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Data files under `root` with their size; file contents are not read, names starting with _ or .
    are skipped. No rows if the folder does not exist."""
    try:
        files = (
            listing_session(spark)
            .read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern)
            .load(root)
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return listing_session(spark).createDataFrame([], _INVENTORY)
    return files.select("path", "length")


def partition_files(
    spark: SparkSession, root: str, paths: bool = False, folders: Sequence[str] | None = None
) -> DataFrame:
    """Length and partition columns, as text, of every Parquet file of a Hive-partitioned zone, or of some `folders`
    inside it, from the listing; with its path if asked for."""
    reader = listing_session(spark).read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = reader.load(root) if folders is None else reader.option("basePath", root).load(list(folders))
    return files.drop("modificationTime", "content", *(() if paths else ("path",)))


def partition_values(spark: SparkSession, root: str, column: str) -> DataFrame:
    """The distinct values of a partition column that have files; none if the folder does not exist."""
    try:
        return partition_files(spark, root).select(F.col(column).cast("string")).distinct()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"`{column}` string")


def file_inventory(spark: SparkSession, zones: Mapping[str, str]) -> DataFrame:
    """Parquet and JSON files of several zones: zone, kind, path relative to the zone, length."""
    parts = None
    for zone, root in zones.items():
        # file:///data and file:/data are one folder, so only what follows the scheme is compared
        place = urlparse(root.rstrip("/"))
        base = f"{place.netloc}{place.path}/"
        inside = F.substr(F.col("path"), F.locate(base, F.col("path")) + len(base))
        kind = F.substring_index("path", ".", -1)
        files = list_files(spark, root, "*.{parquet,json}").select(
            F.lit(zone).alias("zone"), kind.alias("kind"), inside.alias("path"), "length"
        )
        parts = files if parts is None else parts.unionByName(files)
    return parts


def inventory_summary(inventory: DataFrame) -> DataFrame:
    """Count and sizes per zone and kind, and whether the files are many and small."""
    files, total = F.count(F.lit(1)), F.sum("length")
    mean = F.expr("sum(length) div count(1)")
    return inventory.groupBy("zone", "kind").agg(
        files.alias("files"),
        total.alias("total_bytes"),
        mean.alias("avg_bytes"),
        F.min("length").alias("min_bytes"),
        F.max("length").alias("max_bytes"),
        human_bytes(total).alias("total_text"),
        ((mean < SMALL_FILE_BYTES) & (files > SMALL_FILE_COUNT)).alias("small_files"),
    )


def small_file_zones(inventory: DataFrame) -> DataFrame:
    """Only the zones that need compaction."""
    return inventory_summary(inventory).filter("small_files")


def dir_rollup(inventory: DataFrame, max_depth: int = 4) -> DataFrame:
    """Files and bytes under every directory down to a depth; a file counts for all its ancestors."""
    folders = F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1)
    depth = F.least(F.size("_dirs"), F.lit(max_depth))
    prefixes = F.transform(
        F.sequence(F.lit(1), depth), lambda k: F.array_join(F.slice("_dirs", 1, k), "/")
    )
    return (
        inventory.withColumn("_dirs", folders)
        .filter(F.size("_dirs") > 0)
        .select("zone", "kind", "length", F.explode(prefixes).alias("directory"))
        .groupBy("zone", "kind", "directory")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("total_bytes"))
    )


def _scan_metrics(df: DataFrame) -> dict[str, int]:
    """Run the query into nowhere and read what its file scans opened."""
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    started = time.perf_counter()
    rows = counted.collect()[0]["n"]
    elapsed = time.perf_counter() - started
    plan = counted._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.finalPhysicalPlan()
    pending, files = [plan], 0
    while pending:
        node = pending.pop()
        if node.metrics().contains("numFiles"):
            files += int(node.metrics().apply("numFiles").value())
        children = node.children()
        pending.extend(children.apply(i) for i in range(children.size()))
        if "QueryStage" in node.nodeName():
            pending.append(node.plan())
    return {"rows": rows, "files": files, "seconds": elapsed}


def pruning_report(full: DataFrame, pruned: DataFrame) -> DataFrame:
    """What a filter on partition columns saves. `files` are those the scans opened; seconds depend on
    the machine and say little on a small lake."""
    a, b = _scan_metrics(full), _scan_metrics(pruned)
    plan = pruned._jdf.queryExecution().toString()
    row = (
        a["files"],
        b["files"],
        a["rows"],
        b["rows"],
        "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan,
        a["seconds"],
        b["seconds"],
        a["seconds"] / b["seconds"] if b["seconds"] else None,
    )
    return full.sparkSession.createDataFrame(
        [row],
        "full_files bigint, pruned_files bigint, full_rows bigint, pruned_rows bigint, "
        "partition_filter boolean, full_seconds double, pruned_seconds double, speedup double",
    )
