"""Groups of documents by the exact Jaccard similarity of their word shingles.

Two documents are linked if their sets of shingles have a similarity of `SIMILARITY` or more, whole sets compared hash
by hash; links make components. Equal sets are one node. Links are found in three steps, each of which only has to
connect what the ones before have not:

1. The Gray-order index of `simhash` proposes sets whose fingerprints (of these shingles) differ in a few bits.
2. A set has `BANDS` MinHash keys, each made of the least values under `ROWS` permutations; sets of similarity s share a
   key with probability 1 - (1 - s ** ROWS) ** BANDS, which is 99.9 % at 0.8 and more above. Of the sets that share a key
   each is proposed with the least of them. Proposals are compared exactly.
3. Keys whose sets still lie in several components are open. The sets of an open key meet in a task and each is
   compared with all that are in other components by then; a linked one leaves. Nothing but edges that join components
   goes out. So a large group of near copies costs a comparison with its centre for each, and for those not linked
   to it, the probes, one with each of the rest; no pairs are written.

A key of more shingles than fit a task (`HELD`) is cut: its probes go to all pieces of the rest, if they are few. If they
are many, which is what a long passage in otherwise different texts makes, its sets are dealt again by their other
keys as well, up to `DEALT` times: most similar sets share one of those too, others scatter.

4. What all sets of keys with many probes still owe each other is found by their rare shingles, with no chance in it.
In an order that is the same for all, similar sets share one of the first size - SIMILARITY * size + 1 of each; the order
puts the rarer first, so common passages stay out. Sets in several components that share such a shingle are compared in
pairs, or, if more than `PAIRED` share it, in groups as above; there, what is large and has many probes is compared
piece by piece with piece.

What travels: keys and names of all sets, compressed texts of those only that share a key, once for each proposal and
each open key. Which texts those are is known from a broadcast of at most `CELLS` numbers, as is which shingles are rare:
these are counted by cells.

Words are separated by ASCII white space and A-Z are lower-cased; fewer words than a shingle are one. Null, empty
and blank texts have the empty set, which is similar to itself only. Equal sets are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestream.llm import simhash
from lakestream.llm.components import connected
from lakestream.llm.corpus import batches, only, ready, settled

SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 6
SEED = 7
#: Shingles whose values under all permutations are held at once, and whose bits are counted at once.
PERMUTED, COUNTED = 2048, 1 << 15
#: Shingles of the sets that meet in a task, and rounds in which the sets of larger keys are dealt again.
HELD, DEALT = 1_000_000, 2
#: Sets that share a rare shingle and are compared in pairs, at most.
PAIRED = 64
#: Numbers that are broadcast, at most, to tell which texts are wanted.
CELLS = 1 << 18

_rng = np.random.default_rng(SEED)
FLIPPED = _rng.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)
FACTORS = _rng.integers(0, 1 << 31, (BANDS * ROWS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(text: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct hashes of a text's shingles, in order."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, "<u8")
    if len(found) < words:
        joined = [b" ".join(found)]
    else:
        joined = map(b" ".join, zip(*(found[i:] for i in range(words))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined), dtype="<u8"))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band; the number of the band is part of it."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), PERMUTED):
        values = (low[at : at + PERMUTED] ^ FLIPPED) * FACTORS
        np.minimum(least, values.min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(rows)], np.uint64).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The Jaccard similarity of two sets without repeats; two empty ones are alike."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) + len(b) else 1.0


def name_of(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).astype(np.int64))


def bits_of(hashes: np.ndarray) -> int:
    """The fingerprint of a set: the bits set in more than half its hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = hashes[at : at + COUNTED]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def marked(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: `id`, `node` (the name of its set), `size`, `bits` (its fingerprint) and `keys`."""
    key = documents.schema[id_col].dataType.simpleString()

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            sets = [shingles(t or b"") for t in batch.column(1).to_pylist()]
            keys = [band_keys(s) if len(s) else [] for s in sets]
            columns = [
                batch.column(0),
                pa.array([name_of(s) for s in sets], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([bits_of(s) for s in sets], pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "node", "size", "bits", "keys"])

    source = only(documents, id_col, text_col).withColumn(text_col, F.col(text_col).cast("binary"))
    return source.mapInArrow(run, f"id {key}, node long, size long, bits long, keys array<long>")


def squeezed(texts: DataFrame) -> DataFrame:
    """`node` and `packed`, the compressed text, of a table of `node` and `text` (binary)."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches(table):
            found = [squeeze(t or b"") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "packed"])

    return texts.select("node", "text").mapInArrow(run, "node long, packed binary")


def opened(packed: bytes) -> np.ndarray:
    return shingles(zstandard.ZstdDecompressor().decompress(packed))


def verified(pairs: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """The pairs `a`, `b` whose sets, among those `held`, have a similarity of `least` or more."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            known: dict[int, np.ndarray] = {}
            keep = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                for node, packed in zip(row[:2], row[2:]):
                    if node not in known:
                        known[node] = opened(packed)
                keep.append(similarity(known[row[0]], known[row[1]]) >= least)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(held.toDF("a", "left"), "a")
    both = left.join(held.toDF("b", "right"), "b").select("a", "b", "left", "right")
    return both.mapInArrow(run, "a long, b long")


# ---- open keys ----


def joining(sets: list[np.ndarray], roots: list[int], least: float) -> Iterator[tuple[int, int]]:
    """Places of similar sets that join components, given the component of each set; all that is in the largest
    component is not compared with itself."""
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(np.append(0, sizes[:-1]))
    own = np.unique(np.array(roots), return_inverse=True)[1]
    largest = np.bincount(own).argmax()
    held = np.zeros(codes.max() + 1, bool)
    for i in np.flatnonzero(own != largest).tolist():
        others = (own != own[i]) & (np.minimum(sizes, sizes[i]) / np.maximum(sizes, sizes[i]) >= least)
        if not others.any():
            continue
        mine = codes[starts[i] : starts[i] + sizes[i]]
        held[mine] = True
        shared = np.add.reduceat(held[codes], starts, dtype=np.int64)
        held[mine] = False
        for j in np.flatnonzero(others & (shared / (sizes[i] + sizes - shared) >= least)).tolist():
            if own[j] != own[i]:
                yield i, j
                own[own == own[j]] = own[i]


def joined_groups(members: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """Edges `a`, `b` that join components inside the groups of `members`: `group`, `node`, `root`."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges() -> pa.RecordBatch:
            pairs = [(nodes[i], nodes[j]) for i, j in joining(sets, roots, least)] if len(set(roots)) > 1 else []
            columns = [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        now, nodes, roots, sets = None, [], [], []
        for batch in batches(table):
            for group, node, root, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if group != now:
                    yield edges()
                    now, nodes, roots, sets = group, [], [], []
                nodes.append(node)
                roots.append(root)
                sets.append(opened(packed))
        yield edges()

    texts = members.join(held, "node").select("group", "node", "root", "packed")
    return texts.repartition("group").sortWithinPartitions("group", "node").mapInArrow(run, "a long, b long")


def _met(members: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """Groups, `group`, `node` and `root`, in which the members (`key`, `node`, `size`, `root`) of open keys meet, and the
    members of large keys with many probes, each with a `place` in one of `pieces` pieces; None if there are none."""
    parts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("held"))
    keys = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("roots"), F.sum("held").alias("held"), F.max(F.struct("held", "root")).alias("main")
    )
    # settled before the join, so that AQE can split a hot key
    keys = settled(
        keys.filter("roots > 1").select(
            "key", "held", F.col("main.root").alias("main"), (F.col("held") - F.col("main.held")).alias("probes")
        )
    )
    rows = members.join(keys, "key").withColumn("probe", F.col("root") != F.col("main"))
    whole = F.col("held") <= most
    few = ~whole & (F.col("probes") <= most)
    found = rows.filter(whole).select(_group(F.lit(-1), F.lit(-1)), "node", "root")
    pieces = F.ceil(F.col("held") / F.lit(most)).cast("int")
    place = F.pmod(F.xxhash64("node", F.lit(SEED)), pieces).cast("int")
    every = F.sequence(F.lit(0), pieces - 1)
    cut = rows.filter(few).withColumn("piece", F.explode(F.when(F.col("probe"), every).otherwise(F.array(place))))
    found = found.unionByName(cut.select(_group(F.col("piece"), F.lit(-1)), "node", "root"))
    if keys.filter(~whole & ~few).isEmpty():
        return found, None
    many = rows.filter(~whole & ~few).select("key", "node", "size", "root", place.alias("place"), pieces.alias("pieces"))
    return found, many


def _group(*parts: Column) -> Column:
    return F.xxhash64("key", *parts).alias("group")


def open_groups(members: DataFrame, nodes: DataFrame, most: int, rounds: int = DEALT) -> DataFrame:
    """Groups in which the members (`key`, `node`, `size`, `root`) of open keys meet: `group`, `node`, `root`.

    `nodes` has the `keys` of each node, by which members of large keys with many probes are dealt again. Those who
    share no other key do not meet by that, so all these members are also named without a group, for `rare_links`.
    """
    found, many = _met(members, most)
    if many is None:
        return found
    found = found.unionByName(many.select(F.lit(None).cast("long").alias("group"), "node", "root"))
    if not rounds:
        return found
    others = many.join(nodes.select("node", "keys"), "node")
    again = others.withColumn("other", F.explode("keys")).filter("other <> key")
    both = F.xxhash64(F.least("key", "other"), F.greatest("key", "other"))
    again = settled(again.select(both.alias("key"), "node", "size", "root").distinct())
    return found.unionByName(open_groups(again, nodes, most, rounds - 1))


# ---- rare shingles ----


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


def cell_counts(texts: DataFrame) -> np.ndarray:
    """How many shingles of the sets in `packed` are in each cell."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for batch in batches(table):
            for packed in batch.column(0).to_pylist():
                np.add.at(counts, _cells(opened(packed)), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["cell", "n"])

    found = texts.select("packed").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = found.toArrow()  # at most `CELLS` rows
    counts = np.zeros(CELLS, np.int64)
    counts[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return counts


def first_shingles(hashes: np.ndarray, counts: np.ndarray, least: float) -> np.ndarray:
    """The first shingles of a set, those in rarer cells before others: two sets of a similarity of `least` or more
    share at least `least` times the size of either, and so one of these."""
    shared = int(np.ceil(least * len(hashes) - 1e-6))
    return hashes[np.lexsort((hashes, counts[_cells(hashes)]))[: len(hashes) - shared + 1]]


def _rare_members(texts: DataFrame, counts: np.ndarray, least: float) -> DataFrame:
    """`key`, one of the first shingles of a set, with its `node`, `size` and `root`."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table, 1 << 20):
            keys = [first_shingles(opened(packed), counts, least) for packed in batch.column(3).to_pylist()]
            at = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            rows = batch.select([0, 1, 2]).take(pa.array(at))
            columns = [pa.array(np.concatenate(keys).view(np.int64)), *rows.columns]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "size", "root"])

    chosen = texts.select("node", "size", "root", "packed")
    return chosen.mapInArrow(run, "key long, node long, size long, root long")


def rare_links(rest: DataFrame, held: DataFrame, least: float, most: int) -> DataFrame:
    """Edges `a`, `b` that join components of `rest` (`node`, `size`, `root`): all its links are in the components then."""
    texts = rest.join(held, "node")
    rare = settled(_rare_members(texts, cell_counts(texts), least))
    keys = rare.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    members = settled(rare.join(settled(keys.filter("low <> high").select("key", "n")), "key"))

    few = members.filter(F.col("n") <= PAIRED)
    left = few.select("key", F.col("node").alias("a"), F.col("root").alias("of_a"), F.col("size").alias("size_a"))
    right = few.select("key", F.col("node").alias("b"), F.col("root").alias("of_b"), F.col("size").alias("size_b"))
    alike = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * F.lit(least) - F.lit(1e-6)
    pairs = left.join(right, "key").filter((F.col("a") < F.col("b")) & (F.col("of_a") != F.col("of_b")) & alike)
    edges = verified(settled(pairs.select("a", "b").distinct()), held, least)

    found, many = _met(members.filter(F.col("n") > PAIRED).drop("n"), most)
    if many is not None:
        crossed = many.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        pair = _group(F.least("place", "with"), F.greatest("place", "with"))
        found = found.unionByName(crossed.select(pair, "node", "root"))
    return edges.unionByName(joined_groups(found, held, least))


def _near_fingerprints(nodes: DataFrame) -> DataFrame:
    """Pairs `a`, `b` of nodes whose fingerprints are equal or linked: each with the least of its fingerprint, and
    that with the one it is linked to."""
    prints = settled(nodes.filter("size > 0").groupBy("bits").agg(F.min("node").alias("first")))
    alike = nodes.filter("size > 0").join(prints, "bits").select(F.col("first").alias("a"), F.col("node").alias("b"))
    ends = simhash.links(prints.select("bits"))
    near = ends.join(prints.toDF("a", "one"), "a").join(prints.toDF("b", "two"), "b")
    return alike.unionByName(near.select(F.col("one").alias("a"), F.col("two").alias("b"))).filter("a <> b")


def _wanted_texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """`node` and `text` of the rows named in `wanted` (`node`, `least`). Other texts stay where they are read, but for
    those that share a cell with one: a cell is one of `CELLS` remainders of the row's hash."""
    cell = F.pmod(F.xxhash64("least"), F.lit(CELLS))
    cells = wanted.select(cell.alias("cell")).distinct()
    near = documents.withColumn("cell", cell).join(F.broadcast(cells), "cell", "left_semi").drop("cell")
    # rows equal in id and text are one text
    return near.dropDuplicates(["least"]).join(wanted, "least").select("node", "text")


def groups(
    documents: DataFrame, id_col: str, text_col: str, least: float = SIMILARITY, most: int = HELD
) -> DataFrame:
    """One row per document: its id and `component_id`, the least id of its group. Rows equal in id have equal
    texts."""
    ready(documents.sparkSession)
    rows = settled(marked(documents, id_col, text_col))
    first = [F.first(c).alias(c) for c in ("size", "bits", "keys")]
    nodes = settled(rows.groupBy("node").agg(F.min("id").alias("least"), *first))
    dealt = nodes.select("node", "size", F.explode("keys").alias("key"))
    # Keys of one set only lead nowhere; the others' least members are settled, so that AQE can split a hot key.
    shared = settled(
        dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("centre")).filter("n > 1").drop("n")
    )
    members = settled(dealt.join(shared, "key"))
    proposed = members.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b"))
    proposed = settled(proposed.unionByName(_near_fingerprints(nodes)).distinct())
    both = proposed.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = settled(both.join(nodes.select("node", "least"), "node"))
    texts = only(documents, id_col, text_col).toDF("least", "text").withColumn("text", F.col("text").cast("binary"))
    held = settled(squeezed(_wanted_texts(texts, wanted)))

    edges = settled(verified(proposed, held, least))
    placed = settled(_rooted(members.select("key", "node", "size"), connected(edges)))
    meeting = open_groups(placed, nodes, most)
    edges = edges.unionByName(settled(joined_groups(meeting.filter("group is not null"), held, least)))
    rest = settled(meeting.filter("group is null").select("node").distinct())
    if not rest.isEmpty():
        rest = settled(_rooted(rest.join(nodes.select("node", "size"), "node"), connected(edges)))
        edges = edges.unionByName(settled(rare_links(rest, held, least, most)))
    found = settled(_rooted(nodes.select("node", "least"), connected(edges)))
    ids = settled(found.groupBy("root").agg(F.min("least").alias("component_id")))
    named = found.join(ids, "root").select("node", "component_id")
    return rows.select("id", "node").join(named, "node").select(F.col("id").alias(id_col), "component_id")


def _rooted(table: DataFrame, roots: DataFrame) -> DataFrame:
    """`table` with `root`, the least node that its node is connected with."""
    return table.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
