"""Nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every vector is then indexed in the leaf that it descends to. A query
walks the tree through a priority queue of nodes by their centroid's distance, so leaves come in the order in
which they look promising. How many it visits is calibrated: for some vectors the true neighbours are found by
brute force over the whole index, and visits are widened until the leaves hold the wanted share of them. Empty
leaves are no visits, and a query goes on until its leaves hold as many candidates as it asks for.
Distances are computed in double precision on the original vectors.

A leaf's vectors, and the queries that visit it, meet in pieces of bounded size, so a leaf with a third of all
vectors is searched by as many tasks as its size asks for, and only the vectors of a leaf that very many queries
visit are copied for them. Of equal vectors only so many can be answers, those with the least ids; the others do
not travel, so a vector that a third of all rows have is as cheap as any other.

Vectors that are null, zero, of another length than most or hold null or non-finite components take no part, nor
do those without an id. Repeated rows are candidates of their own. A query is an id with a vector: rows that repeat
both are one query, rows that repeat the id with another vector are queries of their own, with a ranking each. Rows
with a query's id are never its neighbours. Ties go to the smaller id; with fewer candidates than asked for all are
returned. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestream.llm.corpus import only, ready, settled

#: Vectors the tree is fitted on, and those that calibrate it.
SAMPLE, CALIBRATION = 20_000, 200
#: Children of a node, rows of the index for each leaf, and leaves at most.
BRANCHES, LEAF_ROWS, MOST_LEAVES = 8, 1000, 4096
#: Share of the true neighbours that the visited leaves of the calibrating vectors must hold.
RECALL = 0.97
#: Vectors and queries that meet in one group.
PIECE_ROWS, BLOCK_QUERIES = 4096, 4096


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def distances(queries: np.ndarray, vectors: np.ndarray) -> Iterator[np.ndarray]:
    """Of each query in turn, its distances to all vectors, from the differences themselves."""
    for query in queries:
        yield np.sqrt(np.square(vectors - query).sum(axis=1))


# ---- tree ----


@dataclass
class Tree:
    """Centroids of all nodes, the children of inner ones, and the leaf number of the others."""

    centroids: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    leaves: int

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector descends to, by the nearest child at every node."""
        found, waiting = np.zeros(len(vectors), np.int64), [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if not self.children[node]:
                found[rows] = self.leaf[node]
                continue
            centres = self.centroids[self.children[node]]
            near = _nearest(vectors[rows], centres)
            for i, child in enumerate(self.children[node]):
                if (near == i).any():
                    waiting.append((child, rows[near == i]))
        return found

    def order(
        self, query: np.ndarray, visits: int, sizes: dict[int, int] | None = None, least: int = 0
    ) -> list[int]:
        """The first `visits` leaves, best bin first, and more until they hold `least` rows.

        With `sizes`, the rows of each leaf, those without rows are passed over.
        """
        queue, out, rows = [(0.0, 0)], [], 0
        while queue and (len(out) < visits or rows < least):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                size = 0 if sizes is None else sizes.get(self.leaf[node], 0)
                if size or sizes is None:
                    out.append(self.leaf[node])
                    rows += size
                continue
            gaps = np.square(self.centroids[kids] - query).sum(axis=1)
            for gap, child in zip(gaps.tolist(), kids):
                heapq.heappush(queue, (gap, child))
        return out


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (np.square(centres).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)


def k_means(vectors: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centres by Lloyd's rounds from well-spread starts; fewer than k if vectors coincide."""
    centres = vectors[rng.integers(len(vectors))][None]
    gap = np.square(vectors - centres[0]).sum(axis=1)
    while len(centres) < k and gap.sum() > 0:
        fresh = vectors[rng.choice(len(vectors), p=gap / gap.sum())]
        centres = np.vstack([centres, fresh])
        gap = np.minimum(gap, np.square(vectors - fresh).sum(axis=1))
    for _ in range(rounds):
        near = _nearest(vectors, centres)
        filled = np.unique(near)
        moved = np.stack([vectors[near == i].mean(axis=0) for i in filled])
        if moved.shape == centres.shape and np.allclose(moved, centres):
            break
        centres = moved
    return centres


def fit_tree(sample: np.ndarray, leaves: int, branches: int = BRANCHES, seed: int = 5) -> Tree:
    """The node with most vectors is split until there are `leaves` leaves, or none can be split."""
    rng = np.random.default_rng(seed)
    centroids, children = [sample.mean(axis=0)], [[]]
    queue, count = [(-len(sample), 0, np.arange(len(sample)))], 1
    while queue and count < leaves:
        _, node, rows = heapq.heappop(queue)
        if len(rows) < 2:
            continue
        centres = k_means(sample[rows], min(branches, leaves - count + 1), rng)
        if len(centres) < 2:
            continue
        near = _nearest(sample[rows], centres)
        for i, centre in enumerate(centres):
            children[node].append(len(centroids))
            centroids.append(centre)
            children.append([])
            own = rows[near == i]
            heapq.heappush(queue, (-len(own), len(centroids) - 1, own))
        count += len(centres) - 1
    leaf, n = [], 0
    for kids in children:
        leaf.append(-1 if kids else n)
        n += not kids
    return Tree(np.array(centroids), children, leaf, n)


# ---- Spark ----


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`id` and `vector` (doubles) of the rows that take part."""
    rows = only(table, id_col, vector_col).toDF("id", "vector").filter("id is not null and vector is not null")
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), "length").first()
    return rows.filter(F.size("vector") == (usual["length"] if usual else 0))


def drawn(rows: DataFrame, share: float, purpose: str) -> DataFrame:
    draw = F.pmod(F.xxhash64("id", F.lit(purpose)), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(draw < share)


def answering(rows: DataFrame, k: int) -> DataFrame:
    """The rows that can be among the `k` nearest of anything: of equal vectors the 2 k first by id, no more than k of
    an id, so that k are left whichever id asks. Every task cuts to these before the shuffle."""
    of_id = F.row_number().over(Window.partitionBy("vector", "id").orderBy(F.lit(0)))
    by_id = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    rows = rows.withColumn("_place", of_id).filter(F.col("_place") <= k).drop("_place")
    return rows.withColumn("_place", by_id).filter(F.col("_place") <= 2 * k).drop("_place")


@dataclass
class Index:
    """The tree, every vector that can be an answer with its leaf, how many vectors each leaf has, and the visits of a search."""

    tree: Tree
    rows: DataFrame
    sizes: dict[int, int]
    visits: int


def build(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, recall: float = RECALL
) -> Index | None:
    """Fit the tree, index every usable vector and calibrate; None if there is no usable vector."""
    spark = ready(table.sparkSession)
    rows = settled(answering(usable(table, id_col, vector_col), k))
    n = rows.count()
    if not n:
        return None
    sample = drawn(rows, 0.9 * SAMPLE / n, "tree").select("vector").collect()
    if not sample:
        sample = rows.select("vector").limit(1).collect()
    tree = fit_tree(np.array([r.vector for r in sample]), max(1, min(MOST_LEAVES, n // LEAF_ROWS + 1)))
    sent = spark.sparkContext.broadcast(tree)  # at most MOST_LEAVES leaves
    key = rows.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = sent.value.assign(matrix(batch.column(1))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["id", "vector", "leaf"])

    indexed = settled(rows.mapInArrow(assign, f"id {key}, vector array<double>, leaf long"))
    sizes = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}
    return Index(tree, indexed, sizes, calibrated(indexed, tree, sizes, n, k, recall))


def calibrated(indexed: DataFrame, tree: Tree, sizes: dict[int, int], n: int, k: int, recall: float) -> int:
    """The visits after which the calibrating vectors have met `recall` of their true neighbours."""
    spark = indexed.sparkSession
    chosen = drawn(indexed, CALIBRATION / n, "calibrate").select("id", "vector").collect()
    if not chosen:
        return tree.leaves
    ids, queries = [r.id for r in chosen], np.array([r.vector for r in chosen])
    sent = spark.sparkContext.broadcast((ids, queries))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = sent.value
        held = [np.zeros((0, 2)) for _ in ids]
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, leaf = matrix(batch.column(1)), batch.column(2).to_numpy()
            own = batch.column(0).to_pylist()
            for i, gaps in enumerate(distances(queries, vectors)):
                near = np.argsort(gaps, kind="stable")[: k + 1]
                near = [j for j in near.tolist() if own[j] != ids[i]][:k]
                both = np.vstack([held[i], np.column_stack([gaps[near], leaf[near]])])
                held[i] = both[np.argsort(both[:, 0], kind="stable")[:k]]
        query = np.repeat(np.arange(len(ids)), [len(h) for h in held])
        found = np.vstack(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(found[:, 0]), pa.array(found[:, 1].astype(np.int64))], ["query", "gap", "leaf"]
        )

    best = indexed.mapInArrow(nearest, "query long, gap double, leaf long")
    place = F.row_number().over(Window.partitionBy("query").orderBy("gap", "leaf"))
    truth = best.withColumn("place", place).filter(F.col("place") <= k).select("query", "leaf").collect()
    if not truth:
        return tree.leaves
    turns = [{leaf: t for t, leaf in enumerate(tree.order(q, tree.leaves, sizes), 1)} for q in queries]
    needed = sorted(turns[r.query][r.leaf] for r in truth)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """`query`, `rank`, `id`, `score`: the `k` nearest of the visited vectors but those with the query's id.

    `queries` has columns id and vector, as the index has; each different pair of them gets its ranking. `k` is at
    most that of the index.
    """
    spark = ready(queries.sparkSession)
    key = index.rows.schema["id"].dataType.simpleString()
    own_key = queries.schema["id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(index.tree)
    visits, sizes = index.visits, index.sizes

    def cut(counts: dict[int, int], most: int) -> Column:
        """Into how many parts a leaf is cut: a lookup among at most MOST_LEAVES entries."""
        large = {leaf: -(-n // most) for leaf, n in counts.items() if n > most}
        if not large:
            return F.lit(1)
        table = F.create_map(*(F.lit(x) for pair in large.items() for x in pair))
        return F.coalesce(F.try_element_at(table, F.col("leaf")), F.lit(1))

    def every(parts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), parts - 1))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders = []
            if batch.num_rows:
                wanted = batch.column(2).to_pylist()
                orders = [sent.value.order(q, visits, sizes, n) for q, n in zip(matrix(batch.column(1)), wanted)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(orders, pa.list_(pa.int64()))], ["query", "vector", "leaves"]
            )

    # Rows with the query's id are no candidates, wherever they lie.
    own_rows = index.rows.join(queries.select("id").distinct(), "id", "left_semi").groupBy("id").count()
    wanted = queries.select("id", "vector").distinct().join(own_rows, "id", "left")
    wanted = wanted.select("id", "vector", (F.coalesce("count", F.lit(0)) + k).alias("wanted"))
    walked = wanted.mapInArrow(walk, f"query {own_key}, vector array<double>, leaves array<long>")
    walked = settled(walked.withColumn("mark", F.xxhash64("query", "vector")))
    seekers = walked.select("query", "mark", "vector", F.explode("leaves").alias("leaf"))
    visitors = {r.leaf: r["count"] for r in seekers.groupBy("leaf").count().collect()}
    pieces, blocks = cut(sizes, PIECE_ROWS), cut(visitors, BLOCK_QUERIES)
    seekers = seekers.withColumn("piece", every(pieces)).withColumn("block", F.pmod("mark", blocks).cast("int"))
    # Rows are dealt among the pieces of their leaf whatever their values, since equal ids may be many.
    piece = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), pieces).cast("int")
    rows = index.rows.withColumn("piece", piece).withColumn("block", every(blocks))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        query, marks, ids, gaps = [], [], [], []
        if left.num_rows and right.num_rows:
            names = right.column("id").to_numpy()
            vectors = matrix(right.column("vector"))
            asking = zip(left.column("query").to_pylist(), left.column("mark").to_pylist())
            for (own, mark), found in zip(asking, distances(matrix(left.column("vector")), vectors)):
                near = np.flatnonzero(names != own)
                if len(near) > k:
                    edge = np.partition(found[near], k - 1)[k - 1]
                    near = near[found[near] <= edge]
                near = near[np.lexsort((names[near], found[near]))[:k]]
                query += [own] * len(near)
                marks += [mark] * len(near)
                ids += names[near].tolist()
                gaps += found[near].tolist()
        return pa.table(
            {
                "query": pa.array(query, left.schema.field("query").type),
                "mark": pa.array(marks, pa.int64()),
                "id": pa.array(ids, right.schema.field("id").type),
                "score": pa.array(gaps, pa.float64()),
            }
        )

    together = ["leaf", "piece", "block"]
    met = seekers.groupBy(*together).cogroup(rows.groupBy(*together))
    met = met.applyInArrow(meet, f"query {own_key}, mark long, id {key}, score double")
    rank = F.row_number().over(Window.partitionBy("query", "mark").orderBy("score", "id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "rank", "id", "score")


def neighbours(
    table: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
) -> DataFrame:
    """The nearest neighbours of the rows that `is_query` (an expression on `id`) picks, among all rows."""
    index = build(table, id_col, vector_col, k)
    asking = usable(table, id_col, vector_col).filter(is_query)
    if index is None:
        key = table.schema[id_col].dataType.simpleString()
        return table.sparkSession.createDataFrame([], f"query {key}, rank int, id {key}, score double")
    return search(index, asking, k)
