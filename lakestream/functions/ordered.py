"""Order-dependent work over groups too large for one task.

A log partition may hold a third of all records, so `Window.partitionBy("partition")` would push a
third of the data through one task. Here the ordering column is cut into buckets of a fixed width: the
window runs inside (group, bucket), a summary of one row per bucket is accumulated along the group, and
the two are joined on (group, bucket), which the window has already partitioned the data by. Needs
non-null group columns and an integer ordering column with few repeats per value, such as a log offset
or a dense id; repeats are the caller's to aggregate first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# 131072 rows are a small task, and a billion of them are under ten thousand buckets to accumulate
BUCKET_WIDTH = 1 << 17


def with_bucket(df: DataFrame, order_by: str, width: int) -> DataFrame:
    return df.withColumn("_bucket", F.expr(f"`{order_by}` div {int(width)}"))


def carried_over(
    bucketed: DataFrame, groups: Sequence[str], summary: Column, combine: Column
) -> DataFrame:
    """Per (group, bucket) the `combine` of `_summary` over all earlier buckets of the group, and over
    the whole group."""
    group = W.partitionBy(*groups)
    earlier = group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return (
        bucketed.groupBy(*groups, "_bucket")
        .agg(summary.alias("_summary"))
        .select(
            *groups,
            "_bucket",
            combine.over(earlier).alias("_carry"),
            combine.over(group).alias("_whole"),
        )
    )


def number_rows(
    df: DataFrame,
    groups: Sequence[str],
    order_by: str,
    name: str = "offset",
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Consecutive numbers from 0 within each group, in the order of an integer column."""
    bucketed = with_bucket(df, order_by, width)
    carry = carried_over(bucketed, groups, F.count(F.lit(1)), F.sum("_summary"))
    within = W.partitionBy(*groups, "_bucket").orderBy(order_by)
    return (
        bucketed.withColumn("_rn", F.row_number().over(within).cast("bigint") - 1)
        .join(carry, [*groups, "_bucket"], "left")
        .withColumn(name, F.col("_rn") + F.coalesce(F.col("_carry"), F.lit(0)))
        .drop("_rn", "_carry", "_whole", "_bucket")
    )


def running_total(
    df: DataFrame,
    groups: Sequence[str],
    order_by: str,
    value: str,
    name: str,
    whole: str,
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """The sum of `value` over the group up to and including the row, and over the `whole` group."""
    bucketed = with_bucket(df, order_by, width)
    carry = carried_over(bucketed, groups, F.sum(value), F.sum("_summary"))
    within = (
        W.partitionBy(*groups, "_bucket").orderBy(order_by).rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        bucketed.withColumn("_local", F.sum(value).over(within))
        .join(carry, [*groups, "_bucket"], "left")
        .withColumn(name, F.col("_local") + F.coalesce(F.col("_carry"), F.lit(0)))
        .withColumnRenamed("_whole", whole)
        .drop("_local", "_carry", "_bucket")
    )


def running_max_before(
    df: DataFrame,
    groups: Sequence[str],
    order_by: str,
    value: str,
    name: str,
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """The largest `value` among the rows of the group that come strictly before; null for the first."""
    bucketed = with_bucket(df, order_by, width)
    carry = carried_over(bucketed, groups, F.max(value), F.max("_summary"))
    within = (
        W.partitionBy(*groups, "_bucket").orderBy(order_by).rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        bucketed.withColumn("_local", F.max(value).over(within))
        .join(carry, [*groups, "_bucket"], "left")
        .withColumn(name, F.greatest("_local", "_carry"))
        .drop("_local", "_carry", "_whole", "_bucket")
    )
