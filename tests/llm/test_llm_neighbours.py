"""Neighbours of vectors in sparse places."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from lakestream.llm import ann


def test_every_query_gets_as_many_rows_as_it_asks_for(spark, monkeypatch):
    """Three tight clusters push the visits towards one; vectors far from all lie in leaves of their own."""
    monkeypatch.setattr(ann, "LEAF_ROWS", 100)
    rng = np.random.default_rng(6)
    rows = [(i, (np.eye(4)[i % 3] + 1e-3 * rng.normal(size=4)).tolist()) for i in range(1500)]
    rows += [(1500 + i, (100 * rng.normal(size=4)).tolist()) for i in range(12)]
    rows += [(1500, [0.5, 0.5, 0.5, 0.5])] * 15  # more rows with a query's id
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").dropDuplicates()
    table = table.union(spark.createDataFrame(rows[-5:], table.schema))
    queries = {*range(0, 1500, 300), *range(1501, 1512)}
    found = ann.neighbours(table, F.col("id").isin(*queries))
    counts = {r["query"]: r["count"] for r in found.groupBy("query").count().collect()}
    assert counts == dict.fromkeys(queries, 10)


def test_empty_leaves_are_no_visits():
    sample = np.random.default_rng(2).normal(size=(500, 3))
    tree = ann.fit_tree(sample, 40)
    every = tree.order(sample[0], 40)
    sizes = {leaf: 4 for leaf in every[2:]}
    assert tree.order(sample[0], 2, sizes) == every[2:4]
    assert tree.order(sample[0], 1, sizes, 11) == every[2:5]
    assert tree.order(sample[0], 1, sizes, 1000) == every[2:]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def slow_ranking(rows, own_id, own, k=10):
    near = sorted((float(np.sqrt(np.square(np.array(v) - np.array(own)).sum())), i) for i, v in rows if i != own_id)
    return [(i, d) for d, i in near[:k]]


def test_repeated_queries_have_rankings_of_their_own(spark):
    """The same row three times is one query; the same id with other vectors is one for each; and each is complete,
    repeats among the neighbours included."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(80)]
    rows += [rows[0]] * 2 + [(20, rng.normal(size=3).tolist()) for _ in range(2)] + [rows[41]] * 15
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.neighbours(table, F.col("id") % 20 == 0).collect()
    asked = {(i, tuple(v)) for i, v in rows if i % 20 == 0}
    expected = sorted((i, slow_ranking(rows, i, v)) for i, v in asked)
    by_query = {}
    for r in sorted(found, key=lambda r: (r["query"], r["rank"], r.score)):
        by_query.setdefault(r["query"], []).append((r.id, r.score))
    assert len(found) == 10 * len(asked) == 10 * 6
    for query in (0, 40, 60):
        assert [(query, by_query[query])] == [e for e in expected if e[0] == query]
    assert sorted(by_query[20]) == sorted(p for q, ranking in expected if q == 20 for p in ranking)


def test_equal_vectors_keep_the_rows_that_can_answer(spark):
    rows = [(i % 400, [1.0, 0.0]) for i in range(3000)] + [(7, [1.0, 0.0])] * 300 + [(500, [0.0, 1.0])]
    table = spark.createDataFrame(rows, "id long, vector array<double>")
    kept = [(r.id, tuple(r.vector)) for r in ann.answering(table, 5).collect()]
    ids = sorted(i for i, v in kept if v == (1.0, 0.0))
    assert ids == [0] * 5 + [1] * 5 and (500, (0.0, 1.0)) in kept
    for own in (0, 1, 7, 300):
        left = sorted(i for i, _ in kept if i != own)[:5]
        assert left == sorted(i for i, v in rows if i != own)[:5]


def test_index_rows_are_not_copied_for_queries(spark, monkeypatch):
    """Four times the queries, the same rows of the index in the search; more only of a leaf that they crowd."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(2000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "LEAF_ROWS", 100)
    index = ann.build(table)
    for step in (100, 25):
        found = ann.search(index, index.rows.filter(F.col("id") % step == 0).select("id", "vector"))
        assert found.count() == 10 * (2000 // step)
        assert "element_at" not in plan_of(found)  # neither pieces nor blocks: each row of the index once
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 10)
    crowded = ann.search(index, index.rows.filter(F.col("id") % 10 == 0).select("id", "vector"))
    assert "element_at" in plan_of(crowded)
    plain = {(r["query"], r["rank"]): r.id for r in crowded.collect()}
    assert len(plain) == 2000
    for query in (0, 990, 1990):
        truth = [i for i, _ in slow_ranking(rows, query, rows[query][1])]
        assert len(set(truth) & {plain[query, n] for n in range(1, 11)}) >= 8
