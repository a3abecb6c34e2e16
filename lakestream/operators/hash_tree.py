"""Comparing large tables by a tree of fingerprints.

The root's branches are the directories of a partitioned table, a directory's branches are buckets of its rows by
hash, a bucket's leaves are rows. Each branch is a count and two sums of row hashes, of one side less the other, so
equal branches are zero. Only branches that differ are descended into: the next level reads and shuffles
what lies below them. Equal tables cost one map-side aggregate, and a damaged row costs its directory once
and its bucket's rows. Equality is but for a collision of 64-bit hashes in both sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lakestream.operators.log_audit import multiset_diff, row_hashes
from lakestream.schemas import CURATED_PARTITIONS

#: Buckets of rows in a directory.
BUCKETS = 256
#: Up to so many differing branches are a condition that prunes directories; more are a join.
LISTED = 200


def _signed(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))


def differing_branches(left: DataFrame, right: DataFrame, branch: Sequence[str], of: Sequence[str]) -> DataFrame:
    """The branches in which the rows of `of` are not the same on both sides, with `surplus`, how many rows left has
    more. Sums are combined in every task before they are shuffled."""
    both = _signed(left, right)
    first, second = row_hashes(both.select(*[F.col(f"`{c}`") for c in of]))

    def total(value: Column) -> Column:
        return F.sum(value.cast("decimal(28,0)") * F.col("_side"))

    sums = both.groupBy(*[F.col(f"`{c}`") for c in branch]).agg(
        F.sum("_side").alias("surplus"), total(first).alias("_first"), total(second).alias("_second")
    )
    return sums.filter("surplus <> 0 OR _first <> 0 OR _second <> 0").drop("_first", "_second")


def _below(df: DataFrame, listed: list[Row], branches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` under the branches; `listed` are all of them if they are few."""
    if len(listed) <= LISTED:
        inside = F.lit(False)
        for row in listed:
            here = F.lit(True)
            for key in keys:
                own = F.col(f"`{key}`")
                here = here & (own.isNull() if row[key] is None else own == F.lit(row[key]))
            inside = inside | here
        return df.filter(inside)
    marks = branches.select(*[F.col(f"`{k}`").alias(f"_branch_{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & F.col(f"`{key}`").eqNullSafe(F.col(f"_branch_{i}"))
    return df.join(marks, same, "left_semi")


def hash_tree_diff(
    left: DataFrame,
    right: DataFrame,
    directories: Sequence[str] = CURATED_PARTITIONS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """`log_audit.multiset_diff`: rows that do not occur equally often on both sides, with `surplus`.

    Two levels are looked at before this returns: which directories differ, and in those which buckets. Both sides
    have the same columns; a directory that only one side has differs as a whole.
    """
    columns = left.columns
    right = right.select(*[F.col(f"`{c}`") for c in columns])
    first, _ = row_hashes(left)
    bucket = F.pmod(first, F.lit(buckets))
    sides = [left, right]
    for keys in (list(directories), [*directories, "_bucket"]):
        if "_bucket" in keys:
            sides = [side.withColumn("_bucket", bucket) for side in sides]
        branches = differing_branches(*sides, keys, columns)
        listed = branches.limit(LISTED + 1).collect()
        if not listed:
            return left.limit(0).withColumn("surplus", F.lit(0).cast("long"))
        sides = [_below(side, listed, branches, keys) for side in sides]
    return multiset_diff(*(side.drop("_bucket") for side in sides))
