"""The Merkle manifest against plain recursion."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lakestream.llm import manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def slow_digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_leaf(values):
    texts = [None if v is None else str(v) for v in values]
    return slow_digest(*("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def slow_tree(leaves):
    """The root, and of each leaf the siblings (left of it?, digest) from below."""
    paths, places, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for leaf, place in enumerate(places):
            if place ^ 1 < len(level):
                paths[leaf].append((place % 2 == 1, level[place ^ 1]))
            else:
                paths[leaf].append(None)
        places = [p // 2 for p in places]
        level = [slow_digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def slow_manifest(rows, claimed):
    by_lang = {}
    for row, claim in zip(rows, claimed):
        by_lang.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, slow_leaf(row), slow_leaf(claim), row[0]))
    langs = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: slow_tree([r[2] for r in sorted(by_lang[lang])]) for lang in langs}
    root, above = slow_tree([trees[lang][0] for lang in langs])
    out = []
    for lang, upper in zip(langs, above):
        subroot, paths = trees[lang]
        for (_, _, leaf, claim, doc_id), path in zip(sorted(by_lang[lang]), paths):
            steps = [s for s in path + upper]
            for step in steps:
                claim = slow_digest(claim) if step is None else slow_digest(*((step[1], claim) if step[0] else (claim, step[1])))
            proof = slow_digest(*(s[1] for s in steps if s))
            out.append((doc_id, leaf, subroot, root, proof, claim, claim == root))
    return sorted(map(str, out))


def found(table, **settings):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = manifest.manifest(table, COLUMNS, **settings).select(columns).collect()
    return sorted(str(tuple(r)) for r in rows)


def test_trees_of_several_storeys(spark, monkeypatch):
    """Groups of 1, 2, 3, 16, 17, 64, 65 and 300 rows in blocks of four leaves, a fifth of the rows tampered with."""
    rng = random.Random(1)
    rows = []
    for lang, n in zip([None, "", "a", "ab", "é", "z", "zz", "-"], [300, 1, 2, 3, 16, 17, 64, 65]):
        rows += [(rng.randrange(10**6), rng.choice(["s", None]), lang, rng.randrange(9), f"t{i}ü") for i in range(n)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    tampered = {"n_chars": F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    claimed = [(r[0], r[1], r[2], r[3] + (r[0] % 5 == 0), r[4]) for r in rows]
    got = found(table, tampered=tampered, levels=2)
    assert got == slow_manifest(rows, claimed)
    assert sum("False" in r for r in got) == sum(r[0] % 5 == 0 for r in rows)
    monkeypatch.setattr(manifest, "SWEPT_BYTES", 1000)
    assert found(table, tampered=tampered) == got
    proofs = manifest.manifest(table, COLUMNS, levels=3, with_steps=True).collect()
    assert all(manifest.folded(r.leaf, r.steps) == r.root == r.folded_root for r in proofs) and len(proofs) == len(rows)


def test_odd_documents(odd, empty):
    """Repeated rows, null ids and languages."""
    rows = [tuple(r[c] for c in COLUMNS) for r in odd.collect()]
    assert found(odd) == slow_manifest(rows, rows)
    assert manifest.manifest(empty, COLUMNS).count() == 0


def test_many_equal_rows_are_dealt(spark):
    """They are no single range, and their places are all different."""
    same = spark.range(5000).select(F.lit("g").alias("tree"), F.lit(1).alias("id"), F.lit("d").alias("digest"))
    rows = manifest.numbered(same.repartition(4), "tree", ["id", "digest"])
    assert sorted(r.pos for r in rows.collect()) == list(range(5000))
    assert rows.select("n").distinct().collect()[0].n == 5000


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 31])
def test_sweeps(n):
    leaves = [slow_digest(str(i)) for i in range(n)]
    up = manifest.height(n)
    done = manifest.forward(leaves, up)
    root, paths = slow_tree(leaves)
    assert done[up, 0] == root
    for leaf, steps, path in zip(leaves, manifest.reverse(done, up, None), paths):
        listed = manifest.listed(steps)
        assert [None if s == "." else (s[0] == "<", s[1:]) for s in listed] == path
        assert manifest.folded(leaf, listed) == root
        assert manifest.listed(manifest.chained(listed)) == listed
