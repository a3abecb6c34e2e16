"""Clustering by several columns at once: the bits of their quantile ranks, interleaved (Z-order)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a column's rank, and values that its quantiles are taken from, about.
RANK_BITS, SAMPLED = 6, 20_000


def quantile_bounds(df: DataFrame, columns: Sequence[str], place: Column, bits: int = RANK_BITS) -> dict[str, list]:
    """For each column up to 2 ** bits - 1 ascending values that cut it into equal shares, from about `SAMPLED` rows
    drawn by the hash of `place`. They decide where rows lie, not which there are."""
    total = df.count()
    share = min(1.0, SAMPLED / max(1, total))
    drawn = F.pmod(F.xxhash64(place, F.lit("quantiles")), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = df.filter(drawn | F.lit(share >= 1)).select(*[F.col(f"`{c}`") for c in columns]).collect()
    bounds = {}
    for i, column in enumerate(columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        cuts = [values[len(values) * k // (1 << bits)] for k in range(1, 1 << bits)] if values else []
        bounds[column] = sorted(set(cuts))
    return bounds


def with_ranks(df: DataFrame, bounds: dict[str, list], bits: int = RANK_BITS) -> tuple[DataFrame, list[str]]:
    """`df` with a column for each of the bounds' columns that tells how many of the bounds its value reaches; null is
    0."""
    names = []
    for i, (column, values) in enumerate(bounds.items()):
        names.append(f"_rank_{i}")
        passed = F.size(F.filter(F.array(*[F.lit(v) for v in values]), lambda b: b <= F.col(f"`{column}`"))) if values else F.lit(0)
        df = df.withColumn(names[-1], F.when(F.col(f"`{column}`").isNull(), 0).otherwise(passed))
    return df, names


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """One number from the ranks, their highest bits first, taking turns."""
    value = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            value = F.shiftleft(value, 1) + F.shiftright(rank, bit).bitwiseAND(F.lit(1))
    return value
