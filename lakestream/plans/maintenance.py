"""Compaction of a partitioned Parquet zone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakestream.functions.folders import NULL_FOLDER, delete_folder, mark_complete
from lakestream.functions.zorder import RANK_BITS, interleaved, quantile_bounds, with_ranks
from lakestream.operators.lake_audit import list_files, partition_files
from lakestream.operators.log_audit import fingerprint, fingerprint_columns, same_rows
from lakestream.schemas import CURATED_PARTITIONS
from lakestream.session import text_partitions_session
from lakestream.sources.batches import BATCH, layout, range_folder
from lakestream.sources.zones import zone_exists

TARGET_BYTES = 512 * 1024 * 1024


class RowsChanged(RuntimeError):
    """A rewrite did not preserve the rows."""


class ColumnsChanged(RuntimeError):
    """A target already holds rows with other columns than those to be written."""


def zone_as_written(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a zone with the columns of all its files, and partition values as the text they are."""
    return text_partitions_session(spark).read.option("mergeSchema", "true").parquet(path)


def _named(partitions: Sequence[str]) -> list[Column]:
    """Partition values that can be joined: the null partition by its directory's name."""
    return [F.coalesce(F.col(p).cast("string"), F.lit(NULL_FOLDER)).alias(f"_key_{p}") for p in partitions]


def planned_files(
    listed: DataFrame, partitions: Sequence[str], target_bytes: int, files_per_partition: int = 1
) -> DataFrame:
    """Per directory, how many files of the target size its data fills, and the number of the first, from
    the file listing alone: `_key_` columns, `_files`, `_first`."""
    keys = [f"_key_{p}" for p in partitions]
    filled = F.ceil(F.sum("length") / F.lit(target_bytes)).cast("int")
    plan = listed.groupBy(*_named(partitions)).agg(
        F.greatest(F.lit(files_per_partition), filled).alias("_files")
    )
    # a row per directory in one task: a million directories are some hundred megabytes, fewer than a listing takes
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return plan.withColumn("_first", F.coalesce(F.sum("_files").over(before), F.lit(0)))


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partitions: Sequence[str] = CURATED_PARTITIONS,
    files_per_partition: int = 1,
    target_bytes: int = TARGET_BYTES,
    where: Column | None = None,
    sort_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Rewrite a zone to a new folder with at most `files_per_partition` files per directory, and report
    on it. `where`, on partition columns, compacts a part of the zone, such as the last closed month: the
    target then holds of this part what the source holds, and of other parts what it held before.

    Columns that only some files have are kept, and partition values stay the text they are. A target with
    other columns is refused with ColumnsChanged; compact the whole zone then.

    A directory that would not fit its files at the target size gets as many as it fills, each written by a
    task of its own, so the largest directory never ends up in one task. Rows are spread by the file and
    position they were read from, which a repeated task reproduces. With `cluster_by` they are spread and sorted by
    the interleaved quantile ranks of several columns instead, so that filters on any of them skip files and row
    groups; `sort_by` serves the first of its columns only.
    """
    zone = zone_as_written(spark, source)
    if where is not None:
        zone = zone.filter(where)
        if zone_exists(spark, target):
            held = zone_as_written(spark, target)
            if set(held.dtypes) != set(zone.dtypes):
                raise ColumnsChanged(f"{target}: {sorted(set(held.dtypes) ^ set(zone.dtypes))}")
    listed = partition_files(spark, source)
    if where is not None:
        listed = listed.filter(where)
    plan = planned_files(listed, partitions, target_bytes, files_per_partition)
    placed = zone.select("*", _place())
    bounds = quantile_bounds(placed, cluster_by, F.col("_place")) if cluster_by else {}
    _rewrite(placed, plan, target, partitions, where is not None, sort_by, bounds)
    if where is not None:
        for folder in stale_folders(spark, source, target, partitions, where):
            delete_folder(spark, folder)
    return compaction_report(spark, source, target, where)


def _place() -> Column:
    """Where a row was read, as a number."""
    return F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_place")


def _rewrite(
    placed: DataFrame,
    plan: DataFrame,
    target: str,
    partitions: Sequence[str],
    keep_others: bool,
    sort_by: Sequence[str] = (),
    bounds: Mapping[str, list] | None = None,
    complete: bool = True,
) -> None:
    """Write rows with their `_place` into the files planned for their directories, a task for each file; with the
    `bounds` of some columns, clustered by them. Without `complete` the folder has no `_SUCCESS` afterwards."""
    columns = [F.col(f"`{c}`") for c in placed.columns if c != "_place"]
    total = plan.agg(F.sum("_files")).first()[0] or 1
    joined = placed.select("*", *_named(partitions)).join(plan, [f"_key_{p}" for p in partitions], "left")
    files = F.coalesce("_files", F.lit(1))
    number = F.pmod(F.col("_place"), files)
    order = [*partitions, *sort_by] if sort_by else []
    if bounds:
        joined, ranks = with_ranks(joined, bounds)
        joined = joined.withColumn("_z", interleaved([F.col(r) for r in ranks]))
        cells = 1 << (RANK_BITS * len(ranks))
        number = F.least(F.floor(F.col("_z") * files / F.lit(cells)), files - 1)
        order = [*partitions, "_z", *bounds]
    slot = F.coalesce("_first", F.lit(0)) + number
    spread = joined.withColumn("_slot", slot.cast("int")).repartitionById(int(total), "_slot")
    if order:
        spread = spread.sortWithinPartitions(*order)
    (
        spread.select(*columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if keep_others else "static")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(complete).lower())
        .partitionBy(*partitions)
        .option("compression", "snappy")
        .parquet(target)
    )


def stale_folders(
    spark: SparkSession, source: str, target: str, partitions: Sequence[str], where: Column
) -> list[str]:
    """Directories of the target that `where` covers and that the source no longer has."""
    keys = _named(partitions)
    names = [f"_key_{p}" for p in partitions]
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")
    held = partition_files(spark, target, paths=True).filter(where).select(*keys, folder).distinct()
    wanted = partition_files(spark, source).filter(where).select(*keys).distinct()
    return sorted(r.folder for r in held.join(wanted, names, "left_anti").collect())


def compaction_report(
    spark: SparkSession, source: str, target: str | None = None, where: Column | None = None
) -> DataFrame:
    """Files and bytes before and after; without a target, what there is to compact (a dry run)."""

    def lengths(root: str, side: str) -> DataFrame:
        files = list_files(spark, root) if where is None else partition_files(spark, root).filter(where)
        return files.select("length", F.lit(side).alias("side"))

    sides = {"before": source} if target is None else {"before": source, "after": target}
    files = reduce(DataFrame.unionByName, [lengths(root, side) for side, root in sides.items()])
    sums = []
    for side in sides:
        here = F.col("side") == side
        count = F.count_if(here)
        total = F.coalesce(F.sum(F.when(here, F.col("length"))), F.lit(0))
        sums += [
            count.alias(f"{side}_files"),
            total.alias(f"{side}_bytes"),
            F.floor(F.try_divide(total, count)).alias(f"{side}_avg"),
        ]
    report = files.agg(*sums)
    if target is None:
        return report
    kept = F.try_divide(F.col("after_files").cast("double"), F.col("before_files"))
    return report.withColumn("reduction_pct", F.round((F.lit(1.0) - kept) * 100, 1))


def verify_same_rows(
    left: DataFrame, right: DataFrame, exact: bool = False, where: Column | None = None
) -> int:
    """Raise unless both hold the same rows equally often, under `where` if given; returns how many. To be
    run before a compacted zone takes the place of the original."""
    if where is not None:
        left, right = left.filter(where), right.filter(where)
    if exact:
        same, records = same_rows(left, right, exact=True), None
    else:
        same, records = set(left.dtypes) == set(right.dtypes), 0
        if same:
            first, second = (_found(side.select(*columns_of(left))) for side in (left, right))
            same, records = first == second, second["records"]
    if not same:
        raise RowsChanged("the rewritten zone does not hold the same rows")
    return right.count() if records is None else records


def verify_compaction(
    spark: SparkSession, source: str, target: str, where: Column | None = None, exact: bool = False
) -> int:
    """`verify_same_rows` of two folders, with the columns of all files and partition values as text."""
    return verify_same_rows(zone_as_written(spark, source), zone_as_written(spark, target), exact, where)


def compact_batches(
    spark: SparkSession,
    curated: str,
    compacted: str,
    partitions: Sequence[str] = CURATED_PARTITIONS,
    files_per_partition: int = 1,
    target_bytes: int = TARGET_BYTES,
    merge_after: int = 8,
    cluster_by: Sequence[str] = (),
) -> tuple[int, int] | None:
    """Compact the closed batches of a zone fed in batches (`sources.batches`) into a range, and return the
    first and the last; None if there is nothing to do.

    The newest batch may still be repeated by its stream and stays as it is. Earlier ranges are left alone
    until there are `merge_after` of them; then they are merged with the new batches into one, so that a
    directory never has more files than ranges and open batches.

    The range is written without its `_SUCCESS`, so no reader takes it; its rows are compared with those that went
    in, observed while they were written; then it is marked complete. Whatever ends the job in between, readers
    go on with the batches, and the next run writes the range again. One that fails is removed. Only the folders
    concerned are listed and their footers read.
    """
    now = layout(spark, curated, compacted)
    closed = now.live[:-1] if now else ()
    if not closed:
        return None
    merged = now.ranges if len(now.ranges) >= merge_after else ()
    first = merged[0][0] if merged else now.covered + 1
    target = range_folder(compacted, first, closed[-1])
    reader = text_partitions_session(spark).read.option("mergeSchema", "true")
    listed, frames = [], []
    sources = [(curated, [f"{curated}/{BATCH}={b}" for b in closed])]
    sources += [(folder, [folder]) for folder in (range_folder(compacted, *old) for old in merged)]
    for base, folders in sources:
        files = partition_files(spark, base, folders=folders)
        if not files.isEmpty():
            frames.append(reader.option("basePath", base).parquet(*folders).select("*", _place()).drop(BATCH))
            listed.append(files.drop(BATCH))
    if not frames:
        return None  # batches without rows wait for one that has some

    def union(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.unionByName(b, allowMissingColumns=True)

    rows = reduce(union, frames)
    source = rows.drop("_place")
    bounds = quantile_bounds(rows, cluster_by, F.col("_place")) if cluster_by else {}
    seen = Observation("compacted")
    plan = planned_files(reduce(union, listed), partitions, target_bytes, files_per_partition)
    observed = rows.observe(seen, *fingerprint_columns(source))
    _rewrite(observed, plan, target, partitions, False, complete=False, bounds=bounds)
    written = zone_as_written(spark, target)
    if set(written.dtypes) != set(source.dtypes) or _found(written.select(*columns_of(source))) != seen.get:
        delete_folder(spark, target)
        raise RowsChanged(f"{target} does not hold the rows of its batches")
    mark_complete(spark, target)
    return first, closed[-1]


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def _found(df: DataFrame) -> dict:
    return fingerprint(df).first().asDict()


def expire_batches(spark: SparkSession, curated: str, compacted: str) -> list[str]:
    """Remove the batches and ranges that compacted ranges have replaced; returns their folders. To be run
    when no reader that began before the last compaction is left."""
    now = layout(spark, curated, compacted)
    gone = [f"{curated}/{BATCH}={b}" for b in now.old] if now else []
    gone += [range_folder(compacted, *r) for r in now.replaced] if now else []
    for folder in gone:
        delete_folder(spark, folder)
    return gone
