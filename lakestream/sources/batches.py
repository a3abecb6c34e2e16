"""A curated zone that a stream feeds in numbered batches, and ranges of closed batches compacted.

`<curated>/ingest_batch=<n>/` is one micro-batch; writing it again replaces it. `<compacted>/batches=<a>-<b>/`
holds what the batches a to b hold, in few files, and counts once its `_SUCCESS` is there, which is put there last,
after its rows have been compared. A reader takes the ranges, and the batches after the last of them; so a range takes effect at once, nobody reads a folder while it
is rewritten, and the batches it replaces can be removed later.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakestream.functions.folders import COMPLETE, child_folders, exists
from lakestream.schemas import CURATED_ZONE
from lakestream.sources.zones import read_or_empty

BATCH = "ingest_batch"


@dataclass(frozen=True)
class Layout:
    """The ranges that are read, those that larger ones have replaced, and the batches after the ranges."""

    ranges: tuple[tuple[int, int], ...]
    replaced: tuple[tuple[int, int], ...]
    covered: int
    live: tuple[int, ...]
    old: tuple[int, ...]


def range_folder(compacted: str, first: int, last: int) -> str:
    return f"{compacted}/batches={first}-{last}"


def layout(spark: SparkSession, curated: str, compacted: str) -> Layout | None:
    """What there is; None if the zone was not fed in batches."""
    names = child_folders(spark, curated)
    batches = sorted(int(n.removeprefix(f"{BATCH}=")) for n in names if n.startswith(f"{BATCH}="))
    found = []
    for name in child_folders(spark, compacted):
        match = re.fullmatch(r"batches=(\d+)-(\d+)", name)
        if match and exists(spark, f"{compacted}/{name}/{COMPLETE}"):
            found.append((int(match[1]), int(match[2])))
    if not batches and not found:
        return None
    chosen, covered = [], -1
    for first, last in sorted(found, key=lambda r: (r[0], -r[1])):
        if first == covered + 1:
            chosen.append((first, last))
            covered = last
    replaced = tuple(sorted(set(found) - set(chosen)))
    live, old = (tuple(b for b in batches if (b > covered) == after) for after in (True, False))
    return Layout(tuple(chosen), replaced, covered, live, old)


def read_curated(
    spark: SparkSession, curated: str, compacted: str, schema: StructType = CURATED_ZONE
) -> DataFrame:
    """The curated zone, however it is laid out; no rows if there is none."""
    now = layout(spark, curated, compacted)
    if now is None:
        return read_or_empty(spark, curated, schema)
    reader = spark.read.schema(schema)
    frames = [reader.parquet(range_folder(compacted, *r)) for r in now.ranges]
    if now.live:
        folders = [f"{curated}/{BATCH}={b}" for b in now.live]
        frames.append(spark.read.schema(schema).option("basePath", curated).parquet(*folders).drop(BATCH))
    return reduce(DataFrame.unionByName, frames)
