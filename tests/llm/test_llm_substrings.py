"""Passages removed by super-k-mers, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from lakestream.llm import substrings
from lakestream.llm.words import RunHashes, least_of, words_of


def slow_kept(rows, window=13):
    """(id, words, removed, kept) of each row."""
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - window + 1):
            if i is not None and first[tuple(words[at : at + window])] < i:
                gone |= set(range(at, at + window))
        kept = b" ".join(w for n, w in enumerate(words) if n not in gone).decode()
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=repr)


def found(table, **settings):
    return sorted(map(tuple, substrings.without_repeats(table, **settings).collect()), key=repr)


def made_rows(seed, n=120):
    """Documents with shared passages, copies, lines that many have, repeats of their own, few distinct words."""
    rng = random.Random(seed)
    passages = [[f"p{k}w{i}" for i in range(rng.randint(10, 40))] for k in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.6 else [f"x{rng.randrange(400)}" for _ in range(rng.randrange(30))]
            words += ["ha"] * rng.choice([0, 0, 3, 20, 60])
        rows.append((rng.randrange(10 * n), rng.choice(["\n", " ", " \t "]).join(words)))
    return rows + rows[:10] + [(10 * n + i, rows[3][1]) for i in range(40)]


def unique_ids(rows):
    return [r for i, r in enumerate(rows) if r[0] not in {x for x, _ in rows[:i]}]


@pytest.mark.parametrize("large", [1_500_000, 40])
def test_made_documents(spark, large):
    """Also with buckets that are too large, which go window by window, and rows that share an id."""
    for seed, unique in ((1, True), (2, False)):
        rows = unique_ids(made_rows(seed)) if unique else made_rows(seed)
        table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = found(table, bucket_bytes=2000, large_bucket=large)
        assert got == slow_kept(rows) and sum(r[2] for r in got) > 1000


def test_combining_between_steps_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HASHED_BYTES", 500)
    monkeypatch.setattr(substrings, "COMBINED_BYTES", 1500)
    monkeypatch.setattr(substrings, "PIECE_WORDS", 20)
    rows = unique_ids(made_rows(3, 60))
    packer = substrings.Packer(8, 13, 2)
    columns = [substrings.pa.array([r[0] for r in rows]), substrings.pa.array([r[1].encode() for r in rows])]
    batch = substrings.pa.RecordBatch.from_arrays(columns, ["id", "text"])
    steps = list(packer.combined(iter([batch])))
    assert len(steps) > 3
    marks, whole = [], {}
    for step in steps:
        for bucket, combined in step.items():
            marks += combined.marks
            held = whole.setdefault(bucket, substrings.Combined())
            for string, (key, places) in combined.held.items():
                held.add(string, key, places, string.count(b" ") + 2 - 13)
    for held in whole.values():
        marks += held.marks + list(substrings.marks_of(held.held, 13))
    by_id = {}
    for key, _, start, n in marks:
        by_id.setdefault(key, []).append((start, n))
    got = []
    for i, text in rows:
        n, kept = substrings.kept_words(text.encode(), by_id.get(i, ()))
        got.append((i, n, n - len(kept), b" ".join(kept).decode()))
    assert sorted(got, key=repr) == slow_kept(rows)


def test_odd_documents(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd) == slow_kept(rows)
    assert substrings.without_repeats(empty).count() == 0


def test_text_ids(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [("b", passage + " tail"), ("é", "lead " + passage), ("a", passage)]
    assert found(spark.createDataFrame(rows, "doc_id string, text string")) == slow_kept(rows)


def test_a_hash_that_windows_share_does_not_join_them(monkeypatch):
    """Windows are compared by their words: with hashes all alike the result is the same."""
    rows = unique_ids(made_rows(4, 30))
    strings = {}
    for i, text in rows:
        words = text.split()
        for at in range(0, len(words) - 12):
            held = strings.setdefault(" ".join(words[at : at + 13]).encode(), (i, []))
            if i < held[0]:
                strings[" ".join(words[at : at + 13]).encode()] = (i, [])
    strings = {k: (key, [(0, 0)]) for k, (key, _) in strings.items()}
    longer = {b" ".join([k, b"end"]): (key + 10_000, [(0, 0)]) for k, (key, _) in strings.items()}
    expected = sorted(substrings.marks_of(strings | longer, 13))
    assert len(expected) >= len(strings)
    monkeypatch.setattr(RunHashes, "of", lambda self, a, b: np.zeros(len(a), np.uint64))
    assert sorted(substrings.marks_of(strings | longer, 13)) == expected


def test_words_and_their_hashes():
    texts = [b"", b" \t", b"a bb  ccc\x0b\x1c dddd ", b"bb", b"\x00 " + "é漢".encode(), b"x" * 40 + b" bb"]
    words = words_of(texts)
    spelled = [words.data[a:b] for a, b in zip(words.starts, words.ends)]
    assert spelled == [w for t in texts for w in t.split()]
    assert words.text.tolist() == [i for i, t in enumerate(texts) for _ in t.split()]
    assert len({h for h, s in zip(words.hashes.tolist(), spelled) if s == b"bb"}) == 1
    assert len(set(words.hashes.tolist())) == len(set(spelled))
    values = np.random.default_rng(1).integers(0, 50, 60).astype(np.uint64)
    for width in (1, 2, 3, 7, 8, 12, 60):
        assert least_of(values, width).tolist() == [min(values[i : i + width]) for i in range(61 - width)]
    hashes = RunHashes(np.tile(values[:7], 5)).of(np.array([0, 7, 14, 1]), np.array([4, 11, 18, 5]))
    assert len(set(hashes[:3].tolist())) == 1 and hashes[3] != hashes[0]


def test_rows_are_hashed_as_spark_does(spark):
    texts = ["", "a", "né漢 " * 50, "x" * 3000]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in table.selectExpr("xxhash64(text)").collect()]
    assert got == [substrings.row_hash(t.encode()) for t in texts]
