"""A Merkle manifest of a table: a digest per row, a tree per group, a tree over the groups, a proof per row.

Trees are evaluated by time-forward processing. A node's label is its level and its place; a queue ordered by label
holds the digests that are under way, and when a label comes up, the digests of all its children have arrived,
so the node can be computed and sent on to its parent's label. The reversed sweep takes labels from the highest to
the lowest and sends each node's proof suffix, the siblings from there up to the root, to its children; a leaf that
gets its suffix folds itself up to the root with it.

The queue is external: labels are cut into blocks of `LEVELS` levels, and between blocks digests and suffixes are
rows that Spark's shuffle delivers to the block of their label. Inside a block, of at most 2 ** `LEVELS` nodes at its
lowest level, a heap orders them. Each round handles one storey of blocks, so a tree of n leaves takes
log2(n) / `LEVELS` rounds each way, no task holds more than some blocks, and it does not matter how large one group
is. Rows are numbered in their group by a range partitioning and the counts of its partitions.

A digest is the lower-case hex SHA-256 of its inputs put together; digests go in as their hex text. A row's inputs are
its columns, each `-` for null, else its number of UTF-8 bytes, `:` and the value. While several nodes remain, each
two consecutive ones become their digest, a single last one too. A group of one row has the row's digest. The null
group comes first, the others in bytewise order, and their roots are the leaves of the upper tree.

Rows of a group ascend by id (null first), then by digest; repeated rows are leaves of their own, next to each other.
A row with a null id is never tampered with. Empty texts are not null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakestream.llm.corpus import batches, only, ready, settled

#: Levels of a block.
LEVELS = 8
#: Bytes of blocks that are swept at once; proofs take several times as many.
SWEPT_BYTES = 1 << 19

#: A proof is a chain of steps from below to above; a step is the sibling after its side, or neither.
Steps = tuple | None
LEFT, RIGHT, ALONE = "<", ">", "."


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int, levels: int = LEVELS) -> int:
    """Levels of a block above its lowest, in a tree of `n` nodes at that level."""
    return min(levels, (n - 1).bit_length())


def forward(leaves: Sequence[str], levels: int) -> dict[tuple[int, int], str]:
    """Digests by label, the leaves' at level 0."""
    done = {(0, i): leaf for i, leaf in enumerate(leaves)}
    queue = [(1, i // 2, i % 2, leaf) for i, leaf in enumerate(leaves)]
    heapq.heapify(queue)
    while queue[0][0] <= levels:
        label = queue[0][:2]
        children = []
        while queue and queue[0][:2] == label:
            children.append(heapq.heappop(queue)[3])
        done[label] = digest(children)
        level, place = label
        heapq.heappush(queue, (level + 1, place // 2, place % 2, done[label]))
    return done


def reverse(done: dict[tuple[int, int], str], levels: int, suffix: Steps) -> list[Steps]:
    """The proof of each leaf, given the suffix of the block's top."""
    queue = [(-levels, 0, suffix)]
    proofs = []
    while queue:
        above, place, suffix = heapq.heappop(queue)
        if not above:
            proofs.append(suffix)
            continue
        level = -above - 1
        left, right = done.get((level, 2 * place)), done.get((level, 2 * place + 1))
        steps = [(LEFT + left, 2 * place + 1)] if right else []
        steps.append((RIGHT + right if right else ALONE, 2 * place))
        for step, child in steps:
            heapq.heappush(queue, (-level, child, (step, suffix)))
    return proofs


def listed(steps: Steps) -> list[str]:
    out = []
    while steps:
        step, steps = steps
        out.append(step)
    return out


def chained(steps: Sequence[str]) -> Steps:
    out = None
    for step in reversed(steps):
        out = (step, out)
    return out


def folded(leaf: str, steps: Iterable[str]) -> str:
    """The root that a leaf and its proof lead to."""
    for step in steps:
        leaf = digest((step[1:], leaf) if step[0] == LEFT else (leaf, step[1:]))
    return leaf


# ---- leaves ----


def leaf_of(*columns: Column) -> Column:
    """A row's digest."""

    def field(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """`rows` with `pos`, the place in their group from 0, and `n`, the group's size."""
    order = [group, *order, "_tie"]
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())  # very many equal rows are not one range
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    placed = settled(placed.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    # a row for each partition and each group in it
    parts = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    along = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(along), F.lit(0))
    whole = F.sum("_rows").over(W.partitionBy(group))
    parts = parts.select(group, "_part", (F.col("_first") - before).alias("_shift"), whole.alias("n"))
    return placed.join(parts, [group, "_part"]).withColumn("pos", F.col("_at") - F.col("_shift")).drop("_part", "_at", "_shift")


# ---- sweeps ----


def blocked(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (tree, pos, n, digest and others) as one row per block, its nodes in order."""
    item = F.struct("pos", *[c for c in nodes.columns if c not in ("tree", "pos", "n")])
    block = F.shiftright("pos", levels).alias("block")
    return nodes.groupBy("tree", "n", block).agg(F.array_sort(F.collect_list(item)).alias("items"))


def climbed(blocks: DataFrame, levels: int) -> DataFrame:
    """The forward sweep through a storey: the nodes of the next."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            tops, left = [], []
            for n, items in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                up = height(n, levels)
                tops.append(forward([i["digest"] for i in items], up)[up, 0])
                left.append(-(-n // (1 << levels)))
            columns = [batch.column(0), batch.column(2), pa.array(left, pa.int64()), pa.array(tops, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "pos", "n", "digest"])

    return blocks.select("tree", "n", "block", "items").mapInArrow(run, "tree string, pos long, n long, digest string")


def storeys(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each storey from below, and the roots: tree and digest."""
    found = []
    while True:
        found.append(settled(blocked(nodes, levels)))
        nodes = settled(climbed(found[-1], levels))
        if (nodes.agg(F.max("n")).first()[0] or 1) <= 1:
            return found, nodes.select("tree", "digest")


Finish = Callable[[pa.RecordBatch], pa.RecordBatch]


def _swept(storey: DataFrame, down: DataFrame, levels: int, finish: Finish | None, schema: str | None) -> DataFrame:
    """The reversed sweep through a storey: a row per node, with the columns of its item, its `steps` and the further
    columns of `down`; or what `finish` makes of them."""
    more = [c for c in down.columns if c not in ("tree", "steps", "block")]
    joined = storey.join(down, ["tree", "block"]).select("tree", "n", "steps", "items", *more)

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table, SWEPT_BYTES):
            steps = []
            digests = batch.column("items").flatten().field("digest").to_pylist()
            ends = batch.column("items").value_lengths().to_pylist()
            at = 0
            for n, above, size in zip(batch.column("n").to_pylist(), batch.column("steps").to_pylist(), ends):
                up = height(n, levels)
                done = forward(digests[at : at + size], up)
                steps += map(listed, reverse(done, up, chained(above)))
                at += size
            whose = pc.list_parent_indices(batch.column("items"))
            items = batch.column("items").flatten()
            kind = items.type
            columns = {"tree": batch.column("tree").take(whose)}
            columns |= {kind.field(i).name: items.field(i) for i in range(kind.num_fields)}
            columns |= {"steps": pa.array(steps, pa.list_(pa.string()))} | {c: batch.column(c).take(whose) for c in more}
            out = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
            yield finish(out) if finish else out

    fields = list(joined.schema["items"].dataType.elementType.fields)
    kinds = [("tree", "string"), *((f.name, f.dataType.simpleString()) for f in fields), ("steps", "array<string>")]
    kinds += [(c, joined.schema[c].dataType.simpleString()) for c in more]
    return joined.mapInArrow(run, schema or ", ".join(f"`{name}` {kind}" for name, kind in kinds))


def proven(
    found: Sequence[DataFrame], down: DataFrame, levels: int, finish: Finish | None = None, schema: str | None = None
) -> DataFrame:
    """The reversed sweep: each leaf with its columns, its `steps` and the further columns of `down`, which has a row
    for each tree with the `steps` of its root; or what `finish` makes of that, of the given schema."""
    down = down.withColumn("block", F.lit(0).cast("long"))
    for storey in reversed(found[1:]):
        down = _swept(storey, down, levels, None, None).withColumnRenamed("pos", "block").drop("digest")
    return _swept(found[0], down, levels, finish, schema)


def manifest(
    rows: DataFrame,
    columns: Sequence[str],
    id_col: str = "doc_id",
    group_col: str = "lang",
    tampered: dict[str, Column] | None = None,
    levels: int = LEVELS,
    with_steps: bool = False,
) -> DataFrame:
    """One row per row: id, `leaf`, `subroot` of its group, `root` of the table, `proof_sha256`, `folded_root` (from the
    row with the columns of `tampered` in place of its own) and `verified`; with `steps`, its proof, if asked for."""
    ready(rows.sparkSession)
    source = only(rows, *dict.fromkeys([id_col, group_col, *columns]))
    own = {c: F.col(f"`{c}`") for c in columns}
    claimed = leaf_of(*(own | (tampered or {})).values())
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("-"))
    leaves = source.select(
        tree.alias("tree"), F.col(f"`{id_col}`").alias("id"), leaf_of(*own.values()).alias("digest"), claimed.alias("claimed")
    )
    found, subroots = storeys(numbered(leaves, "tree", ["id", "digest"]), levels)
    upper = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    above, root = storeys(numbered(upper, "tree", ["group"]), levels)
    start = root.select("tree", F.array().cast("array<string>").alias("steps"), F.col("digest").alias("root"))
    groups = settled(
        proven(above, start, levels).select(F.col("group").alias("tree"), "steps", "root", F.col("digest").alias("subroot"))
    )
    key = rows.schema[id_col].dataType.simpleString()
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"] + ["steps"] * with_steps

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        claims, proofs = batch.column("claimed").to_pylist(), batch.column("steps").to_pylist()
        ends = [folded(leaf, steps) for leaf, steps in zip(claims, proofs)]
        whole = [digest(step[1:] for step in steps) for steps in proofs]
        columns = [batch.column(c) for c in ("id", "digest", "subroot", "root")]
        columns += [pa.array(whole, pa.string()), pa.array(ends, pa.string())] + [batch.column("steps")] * with_steps
        return pa.RecordBatch.from_arrays(columns, names)

    kinds = f"id {key}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    out = proven(found, groups, levels, finish, kinds + ", steps array<string>" * with_steps)
    return out.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("id", id_col)
