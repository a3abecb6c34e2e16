"""Near-duplicate documents by 64-bit SimHash fingerprints and a Gray-order hierarchical index.

A bit of a fingerprint is set if it is set in more than half the hashes of the document's word shingles.
Fingerprints that differ in at most three bits are linked, and documents whose fingerprints are connected by
links form a group.

Finding links: of four blocks of 16 bits, two linked fingerprints agree on one at least, so every distinct
fingerprint is dealt to four groups, one for each block. A group that would be large is dealt again by the 12
bit quarters of its other 48 bits, of which one must agree as well; nothing is left out either way. Within a
group fingerprints are sorted by Gray rank, which brings similar ones together, and a hierarchy is laid over
runs of them: a node holds the bits that all its fingerprints share, without those its parent holds already. A
search goes down with the differences accumulated so far and drops a node, with everything below, once they
exceed the radius. It also drops a node whose fingerprints all belong to the searching one's component, so a
group of near copies costs no quadratic work and emits a spanning forest instead of all its pairs.

Null and empty texts have fingerprint zero, which is linked like any other. Repeated rows and equal texts share
a fingerprint and are indexed once. Rows with a null id are fingerprinted and take their group's id; a group
of null ids only has a null id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestream.llm.components import connected
from lakestream.llm.corpus import batches, only, ready, settled

RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
#: A group of more fingerprints than this is dealt again by the rest of their bits.
LARGE_GROUP = 50_000
#: Rows of groups, 20 bytes each, that a task holds at once, unless one group has more.
HELD_ROWS = 500_000
#: Children of a node, and fingerprints of a leaf.
FAN_OUT = 16
#: Fingerprints that search at once, from few to many, and the links found at once that halve their number.
SEARCHING = (16, 1024)
MANY_LINKS = 1 << 17
#: Shingles whose bits are counted at once.
COUNTED = 1 << 15

ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Words are separated by ASCII white space and A-Z are lower-cased; fewer words than a shingle are one."""
    words = text.lower().split()
    if not words:
        return 0
    shingles = max(1, len(words) - shingle_words + 1)
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, shingles, COUNTED):
        run = words[at : min(at + COUNTED, shingles) + shingle_words - 1]
        if shingles == 1:
            run = [b" ".join(run)]
        else:
            run = map(b" ".join, zip(*(run[i:] for i in range(shingle_words))))
        hashes = np.array([digest(s, SEED) for s in run], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > shingles, bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """One row per document: its id and `bits`, the fingerprint as a signed long."""
    ready(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            found = [fingerprint(t or b"", shingle_words) for t in batch.column(1).to_pylist()]
            bits = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["id", "bits"])

    source = only(documents, id_col, text_col).withColumn(text_col, F.col(text_col).cast("binary"))
    return source.mapInArrow(run, f"id {key}, bits long").withColumnRenamed("id", id_col)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the order in which neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Forest:
    """Components of the fingerprints of a task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        for i, j in zip(left.tolist(), right.tolist()):
            i, j = self.root(i), self.root(j)
            if i != j:
                self.parent[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return self.parent
            self.parent = up


class GrayIndex:
    """The hierarchy over fingerprints in Gray order; level 0 are the fingerprints themselves."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        pattern, mask = codes, np.full(len(codes), ONES)
        full = [(pattern, mask)]
        while len(pattern) > 1:
            starts = np.arange(0, len(pattern), FAN_OUT)
            shared = np.bitwise_and.reduceat(mask, starts)
            first = np.repeat(pattern[starts], np.diff(np.append(starts, len(pattern))))
            shared &= ~np.bitwise_or.reduceat(first ^ pattern, starts)
            pattern, mask = pattern[starts] & shared, shared
            full.append((pattern, mask))
        self.levels = []
        for depth, (pattern, mask) in enumerate(full):
            held = np.zeros(len(mask), np.uint64)
            if depth + 1 < len(full):
                held = np.repeat(full[depth + 1][1], FAN_OUT)[: len(mask)]
            own = mask & ~held
            self.levels.append((pattern & own, own))

    def uniform(self, component: np.ndarray) -> list[np.ndarray]:
        """Of each node, the component of everything below it, or -1 if there are several."""
        levels = [component]
        for _ in self.levels[1:]:
            below = levels[-1]
            starts = np.arange(0, len(below), FAN_OUT)
            low, high = np.minimum.reduceat(below, starts), np.maximum.reduceat(below, starts)
            levels.append(np.where(low == high, low, -1))
        return levels

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of linked fingerprints that connect components, for some of them at a time.

        The receiver sends back the components as they are then.
        """
        n = len(self.codes)
        near = np.flatnonzero(np.bitwise_count(self.codes[:-1] ^ self.codes[1:]) <= radius)
        component = yield near, near + 1
        at, width = 0, SEARCHING[0]
        while at < n:
            seekers = np.arange(at, min(n, at + width))
            at += width
            uniform = self.uniform(component)
            node, who = np.zeros(len(seekers), np.int64), seekers
            differ = np.zeros(len(seekers), np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                pattern, own = self.levels[depth]
                differ = differ + np.bitwise_count((self.codes[who] & own[node]) ^ pattern[node])
                last = (node + 1) * FAN_OUT**depth
                keep = (differ <= radius) & (last > who) & (uniform[depth][node] != component[who])
                node, who, differ = node[keep], who[keep], differ[keep]
                if not depth or not len(node):
                    break
                node = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                who, differ = np.repeat(who, FAN_OUT), np.repeat(differ, FAN_OUT)
                inside = node < len(self.levels[depth - 1][0])
                node, who, differ = node[inside], who[inside], differ[inside]
            width = max(SEARCHING[0], width // 2) if len(node) > MANY_LINKS else min(SEARCHING[1], 2 * width)
            if len(node):
                component = yield who, node


def linked(codes: np.ndarray, groups: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (larger code's root first) that span the components which links within groups make.

    `groups` holds a group number for each row and is sorted; a code may stand in several groups. Codes are
    compared as unsigned numbers.
    """
    names, row = np.unique(codes, return_inverse=True)
    forest = Forest(len(names))
    starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    sizes = np.diff(np.append(starts, len(groups)))
    order = np.lexsort((gray_rank(codes), groups))
    codes, row = codes[order], row[order]
    # A group no larger than a leaf is one: its fingerprints are compared directly, all groups at once.
    leaf = np.repeat(sizes <= FAN_OUT, sizes)
    for step in range(1, FAN_OUT):
        left = np.flatnonzero(leaf[:-step] & (groups[:-step] == groups[step:]))
        if not len(left):
            break
        near = left[np.bitwise_count(codes[left] ^ codes[left + step]) <= radius]
        forest.link(row[near], row[near + step])
    for start, size in zip(starts[sizes > FAN_OUT], sizes[sizes > FAN_OUT]):
        own = row[start : start + size]
        search = GrayIndex(codes[start : start + size]).links(radius)
        try:
            left, right = next(search)
            while True:
                forest.link(own[left], own[right])
                left, right = search.send(forest.roots()[own])
        except StopIteration:
            pass
    root = forest.roots()
    moved = np.flatnonzero(root != np.arange(len(root)))
    return names[moved], names[root[moved]]


def dealt(bits: DataFrame, large_group: int) -> DataFrame:
    """Each fingerprint once for every group it belongs to: `bits`, `block`, `part` and its `quarter`."""
    def block(b: int) -> Column:
        """The block's number and value, and the other 48 bits: those above it moved down onto those below."""
        value = F.shiftrightunsigned("bits", 16 * b).bitwiseAND(F.lit(0xFFFF)).cast("int")
        rest = F.col("bits").bitwiseAND(F.lit((1 << 16 * b) - 1).cast("long"))
        if b < 3:
            above = F.shiftrightunsigned("bits", 16 * b + 16)
            rest = rest.bitwiseOR(F.shiftleft(above, 16 * b))
        return F.struct(F.lit(b).alias("block"), value.alias("part"), rest.alias("rest"))

    blocks = bits.select("bits", F.inline(F.array(*(block(b) for b in range(4)))))
    # At most 4 x 65536 groups exist, whatever the input.
    large = blocks.groupBy("block", "part").count().filter(F.col("count") > large_group)
    large = large.select("block", "part", F.lit(True).alias("large"))
    quarters = F.array(
        *(F.shiftrightunsigned("rest", 12 * q).bitwiseAND(F.lit(0xFFF)) + 4096 * q for q in range(4))
    )
    whole = F.array(F.lit(-1).cast("long"))
    marked = blocks.join(F.broadcast(large), ["block", "part"], "left")
    return marked.select(
        "bits", "block", "part", F.explode(F.when(F.col("large"), quarters).otherwise(whole)).alias("quarter")
    )


def links(bits: DataFrame, radius: int = RADIUS, large_group: int = LARGE_GROUP) -> DataFrame:
    """Edges `a`, `b` between distinct fingerprints that span the components of all links."""
    if not 0 <= radius <= 3:
        raise ValueError("four blocks find differences of at most 3 bits")
    keys = ["block", "part", "quarter"]

    def edges(rows: pa.Table) -> pa.RecordBatch:
        columns = [rows.column(k).to_numpy() for k in keys]
        changed = np.zeros(rows.num_rows, bool)
        for column in columns:
            changed[1:] |= column[1:] != column[:-1]
        a, b = linked(rows.column("bits").to_numpy().view(np.uint64), np.cumsum(changed), radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups come one after another; whole ones are searched as soon as `HELD_ROWS` rows are there."""
        held, rows, most = [], 0, HELD_ROWS
        for batch in table:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < most:
                continue
            whole = pa.Table.from_batches(held).combine_chunks()
            last = np.ones(rows, bool)
            for key in keys:
                column = whole.column(key).to_numpy()
                last &= column == column[-1]
            begin = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if begin:
                yield edges(whole.slice(0, begin).combine_chunks())
            held = whole.slice(begin).combine_chunks().to_batches()
            rows -= begin
            most = max(HELD_ROWS, 2 * rows)
        if rows:
            yield edges(pa.Table.from_batches(held).combine_chunks())

    spread = dealt(bits, large_group).repartition(*keys).sortWithinPartitions(*keys)
    return spread.mapInArrow(run, "a long, b long")


def groups(marked: DataFrame, id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """`marked` (an id and `bits`) with `component_id`, the least id of the row's group."""
    bits = settled(marked.groupBy("bits").agg(F.min(id_col).alias("least")))
    roots = connected(links(bits.select("bits"), radius))
    placed = bits.join(roots.withColumnRenamed("node", "bits"), "bits", "left")
    placed = settled(placed.select("bits", "least", F.coalesce("root", "bits").alias("root")))
    ids = settled(placed.groupBy("root").agg(F.min("least").alias("component_id")))
    return marked.join(placed.join(ids, "root").select("bits", "component_id"), "bits")


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """One row per document: id, `fingerprint` in hex and `component_id`."""
    marked = settled(fingerprints(documents, id_col, text_col, shingle_words))
    found = groups(marked, id_col, radius)
    return found.select(id_col, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
