"""Records placed in shards of nearly equal bytes through a fixed number of virtual slots.

A record hashes to one of some thousand slots and stays there for good. Bytes are added up per slot, and a
versioned map says which shard a slot belongs to. Balancing places slots, largest first, in the lightest shard;
rebalancing edits the map, moving few slots, and stores it as the next version. The map has one row per slot
whatever the input, so it is decided on the driver and broadcast.

Null texts have no bytes of their own and weigh 1 like empty ones. Records equal in id and text share a slot,
which is as heavy as all of them; a null id is a value like any other. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestream.llm.corpus import only, settled

SLOTS = 4096
SHARDS = 16
MAP_SCHEMA = "version int, virtual_slot int, shard int"


def virtual_slot(id_col: str, text_col: str, slots: int = SLOTS) -> Column:
    """The slot of a record; what it is called and says decides."""
    return F.pmod(F.xxhash64(id_col, text_col), F.lit(slots)).cast("int")


def sized(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS
) -> DataFrame:
    """One row per record: id, `size`, `text_crc32`, `virtual_slot`."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return only(documents, id_col, text_col).select(
        id_col,
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        virtual_slot(id_col, text_col, slots).alias("virtual_slot"),
    )


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes per slot; slots that have no records are left out."""
    rows = records.groupBy("virtual_slot").agg(F.sum("size").alias("size")).collect()
    return {r.virtual_slot: r["size"] for r in rows}


def balanced(loads: Mapping[int, int], slots: int = SLOTS, shards: int = SHARDS) -> list[int]:
    """The shard of every slot: slots by falling bytes, each to the shard that has least so far."""
    heap = [(0, shard) for shard in range(shards)]
    owner = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-loads.get(s, 0), s)):
        held, shard = heap[0]
        owner[slot] = shard
        heapq.heapreplace(heap, (held + loads.get(slot, 0), shard))
    return owner


def rebalanced(owner: list[int], loads: Mapping[int, int], shards: int, spread: float = 0.01) -> list[int]:
    """`owner` edited for `shards` shards (more or as many as now) until their bytes differ by about `spread`.

    Each edit gives the lightest shard the slot of the heaviest one that comes closest to half their
    difference without exceeding the difference, so every edit lowers it; all other slots stay.
    """
    owner = list(owner)
    held, slots_of = [0] * shards, [set() for _ in range(shards)]
    for slot, shard in enumerate(owner):
        held[shard] += loads.get(slot, 0)
        slots_of[shard].add(slot)
    mean = sum(held) / shards
    while True:
        heavy, light = max(range(shards), key=held.__getitem__), min(range(shards), key=held.__getitem__)
        gap = held[heavy] - held[light]
        moves = [s for s in slots_of[heavy] if 0 < loads.get(s, 0) < gap]
        if gap <= spread * mean or not moves:
            return owner
        slot = min(moves, key=lambda s: (abs(2 * loads[s] - gap), s))
        owner[slot] = light
        held[heavy] -= loads[slot]
        held[light] += loads[slot]
        slots_of[heavy].remove(slot)
        slots_of[light].add(slot)


def store_map(spark: SparkSession, owner: list[int], version: int, path: str) -> None:
    """Keep a version of the map in a folder of its own; earlier versions stay readable."""
    rows = [(version, slot, shard) for slot, shard in enumerate(owner)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(
        f"{path}/v{version:06d}"
    )


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{path}/v{version:06d}")


def placed(records: DataFrame, slot_map: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`records` with `shard` and `slot`, their place in the shard, counted from 0 without gaps.

    Records are numbered within their virtual slot; what the shard's earlier slots hold is added to that, so
    no shard passes through one task.
    """
    counts = records.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        slot_map.join(counts, "virtual_slot", "left")  # a row per virtual slot
        .select(
            "virtual_slot",
            "shard",
            F.col("version").alias("map_version"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
        )
    )
    within = Window.partitionBy("virtual_slot").orderBy(id_col, "text_crc32", "size")
    numbered = records.withColumn("number", F.row_number().over(within) - 1)
    joined = numbered.join(F.broadcast(starts), "virtual_slot")
    return joined.withColumn("slot", F.col("start") + F.col("number")).drop("start", "number")


def sharded(
    documents: DataFrame,
    map_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    slots: int = SLOTS,
    shards: int = SHARDS,
) -> DataFrame:
    """Every record with its place, by a first version of the map that is stored at `map_path`."""
    spark = documents.sparkSession
    records = settled(sized(documents, id_col, text_col, slots))
    store_map(spark, balanced(slot_bytes(records), slots, shards), 1, map_path)
    return placed(records, load_map(spark, map_path, 1), id_col)
