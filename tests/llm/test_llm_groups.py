"""Near duplicates, components, shards and neighbours against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakestream.llm import ann, components, sharding, simhash


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(codes, radius=3):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i + 1, len(codes)):
            if (int(codes[i]) ^ int(codes[j])).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


@pytest.mark.parametrize("seed", range(8))
def test_gray_index_finds_the_components(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, size=rng.integers(1, 6), dtype=np.uint64)
    codes = base[rng.integers(0, len(base), 400)]
    for _ in range(int(rng.integers(0, 12))):
        codes = codes ^ (np.uint64(1) << rng.integers(0, int(rng.integers(2, 65)), 400).astype(np.uint64))
    codes = np.unique(codes)
    a, b = simhash.linked(codes, np.zeros(len(codes), int))
    names = {int(c): i for i, c in enumerate(codes)}
    edges = {names[int(x)]: names[int(y)] for x, y in zip(a, b)}

    def top(i):
        while i in edges:
            i = edges[i]
        return i

    assert [top(i) for i in range(len(codes))] == slow_groups(codes)


def test_gray_ranks_are_an_order_of_single_steps():
    codes = np.arange(1 << 10, dtype=np.uint64)
    ordered = codes[np.argsort(simhash.gray_rank(codes))]
    assert set(np.bitwise_count(ordered[1:] ^ ordered[:-1]).tolist()) == {1}


def test_dealing_again_loses_no_link(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(6)]
    codes = set()
    for _ in range(300):
        code = rng.choice(base)
        for _ in range(rng.randint(0, 4)):
            code ^= 1 << rng.randrange(64)
        codes.add(code)
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    bits = spark.createDataFrame([(c,) for c in signed], "bits long")
    expected = slow_groups(codes)
    for large in (5, 50_000):
        roots = {r.node: r.root for r in components.connected(simhash.links(bits, large_group=large)).collect()}
        group = [roots.get(c, c) for c in signed]
        assert len(set(zip(group, expected))) == len(set(group)) == len(set(expected))


def test_groups_are_searched_as_they_come(spark, monkeypatch):
    """With room for few rows the components are the same, also where one group has more."""
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(3)]
    codes = sorted({rng.choice(base) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(400)})
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    bits = spark.createDataFrame([(c,) for c in signed], "bits long")
    monkeypatch.setattr(simhash, "HELD_ROWS", 7)
    roots = {r.node: r.root for r in components.connected(simhash.links(bits)).collect()}
    group, expected = [roots.get(c, c) for c in signed], slow_groups(codes)
    assert len(set(zip(group, expected))) == len(set(group)) == len(set(expected))


def test_near_duplicates_of_odd_documents(odd, empty):
    found = simhash.near_duplicates(odd)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    rows = found.collect()
    docs = odd.collect()
    prints = [slow_fingerprint(r.text) for r in docs]
    roots = slow_groups(prints)
    expected = []
    for i, r in enumerate(docs):
        ids = [d.doc_id for d, root in zip(docs, roots) if root == roots[i] and d.doc_id is not None]
        expected.append((r.doc_id, f"{prints[i]:016x}", min(ids, default=None)))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(0, i) for i in range(1, 200)] + [(300, i) for i in range(100, 120)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(5, 5)],
        "none": [],
    }[shape]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(i):
        while root.get(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    nodes = {n for e in edges for n in e}
    assert got == {n: find(n) for n in nodes if find(n) != n}


# ---- shards ----


def test_shards_of_odd_documents(spark, odd, empty, tmp_path):
    rows = sharding.sharded(odd, str(tmp_path / "map")).collect()
    assert len(rows) == odd.count()
    places = {}
    for r in rows:
        places.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    sizes = {r.doc_id: r["size"] for r in rows}
    assert sizes[1] == sizes[2] == 1 and sizes[7] == 4
    assert sharding.sharded(empty, str(tmp_path / "other")).count() == 0
    assert sharding.load_map(spark, str(tmp_path / "map"), 1).count() == sharding.SLOTS


def test_shards_are_even():
    rng = random.Random(1)
    loads = {s: int(rng.paretovariate(1.5) * 1000) for s in range(4096)}
    owner = sharding.balanced(loads)
    held = [sum(loads[s] for s in range(4096) if owner[s] == shard) for shard in range(16)]
    assert max(held) - min(held) <= max(min(loads.values()), 0.001 * sum(held) / 16)


def test_rebalancing_moves_few_slots(spark, tmp_path):
    rng = random.Random(3)
    loads = {s: rng.randint(500, 1500) for s in range(4096)}
    owner = sharding.balanced(loads)
    grown = sharding.rebalanced(owner, loads, 17)
    moved = sum(a != b for a, b in zip(owner, grown))
    held = [sum(loads[s] for s in range(4096) if grown[s] == shard) for shard in range(17)]
    assert max(held) - min(held) <= 0.01 * sum(held) / 17
    assert moved < 1.3 * 4096 / 17 and all(b == 16 for a, b in zip(owner, grown) if a != b)
    path = str(tmp_path / "maps")
    sharding.store_map(spark, owner, 1, path)
    sharding.store_map(spark, grown, 2, path)
    with pytest.raises(Exception):
        sharding.store_map(spark, grown, 2, path)
    assert [r.shard for r in sharding.load_map(spark, path, 2).orderBy("virtual_slot").collect()] == grown
    assert sharding.rebalanced(grown, loads, 17) == grown


# ---- neighbours ----

VECTORS = "vec_id long, embedding array<float>, label int, id string, vector string, leaf int, query int, score double"


def vector_table(spark, rows):
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame([(i, v, 0, "x", "x", 1, 1, 0.0) for i, v in rows], VECTORS)


def slow_neighbours(rows, query_ids, k=10):
    rows = [
        (i, np.array(v, dtype=np.float32).astype(float))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 4
    ]
    out = {}
    for q, own in rows:
        if q in query_ids:
            near = sorted((float(np.sqrt(np.square(v - own).sum())), i) for i, v in rows if i != q)[:k]
            out[q] = [(i, d) for d, i in near]
    return out


def test_neighbours_leave_out_unusable_vectors(spark):
    rng = np.random.default_rng(0)
    nan, inf = float("nan"), float("inf")
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, None), (103, []), (104, [0.0] * 4), (105, [nan, 1, 1, 1])]
    rows += [(106, [inf, 1, 1, 1]), (107, [None, 1.0, 1.0, 1.0]), (108, [1.0, 2.0]), (None, rows[1][1])]
    table = vector_table(spark, rows)
    found = {}
    for r in ann.neighbours(table, F.col("id") % 20 == 0).orderBy("query", "rank").collect():
        found.setdefault(r.query, []).append((r.id, r.score))
        assert r.rank == len(found[r.query])
    assert found == slow_neighbours(rows, {0, 20, 40, 100})


def test_few_and_no_candidates(spark):
    rows = [(0, [1.0, 0, 0, 0]), (1, [0, 1.0, 0, 0]), (2, [0, 0, 1.0, 0])]
    found = ann.neighbours(vector_table(spark, rows), F.col("id") == 0).collect()
    assert [(r.rank, r.id) for r in sorted(found)] == [(1, 1), (2, 2)]
    assert ann.neighbours(vector_table(spark, []), F.col("id") == 0).count() == 0
    assert ann.neighbours(vector_table(spark, [(0, None)]), F.col("id") == 0).count() == 0
    assert ann.neighbours(vector_table(spark, rows[:1]), F.col("id") == 0).count() == 0


def test_recall_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 60)
    monkeypatch.setattr(ann, "PIECE_ROWS", 50)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 4))
    rows = [(i, (centres[i % 12] + 0.4 * rng.normal(size=4)).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(1500 + i, rows[3][1]) for i in range(700)]  # a third of all rows are one vector
    truth = slow_neighbours(rows, {i for i, _ in rows if i % 100 == 0})
    found = {}
    for r in ann.neighbours(vector_table(spark, rows), F.col("id") % 100 == 0).orderBy("query", "rank").collect():
        found.setdefault(r.query, []).append((r.id, r.score))
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in t}) for q, t in truth.items())
    assert hits >= 0.9 * sum(map(len, truth.values()))
    exact = dict(rows)
    for q, near in found.items():
        for i, score in near:
            a, b = (np.array(exact[x], np.float32).astype(float) for x in (q, i))
            assert score == float(np.sqrt(np.square(b - a).sum()))


def test_best_bin_first_reaches_every_leaf():
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(500, 3))
    tree = ann.fit_tree(sample, 40)
    assert tree.leaves == 40
    assert sorted(tree.order(sample[0], 99)) == list(range(40))
    assert tree.order(sample[0], 5) == tree.order(sample[0], 40)[:5]
    assert set(tree.assign(sample).tolist()) == set(range(40))
    assert ann.fit_tree(np.ones((50, 3)), 8).leaves == 1
