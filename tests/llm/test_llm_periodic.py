"""Periodic runs against brute force."""

from __future__ import annotations

import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lakestream.llm import periodic
from lakestream.llm.queries import planted_repetition


def slow_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                root = words[i : i + q]
                if not any(root[: q - d] == root[d:] and q % d == 0 for d in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_text(rng):
    """Words with repetitions in repetitions, cut off, damaged, side by side."""

    def stretch(depth):
        size = rng.choice([1, 1, 2, 3, 5, 8, 16, 17, 33, 40])
        unit = [rng.randrange(4) for _ in range(size)] if depth == 0 or rng.random() < 0.5 else stretch(depth - 1)
        out = unit * rng.randint(1, 7)
        out = out[: len(out) - rng.randrange(len(unit))] or out
        if rng.random() < 0.2:
            out = list(out)
            out[rng.randrange(len(out))] = 9
        return out[:900]

    words = []
    for _ in range(rng.randint(1, 4)):
        words += stretch(rng.randint(0, 2)) + [rng.randrange(6) for _ in range(rng.randrange(6))]
    return words[:1500]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_made_texts(seed):
    rng = random.Random(seed)
    texts = [made_text(rng) for _ in range(25)] + [[], [0], [1] * 5, [1] * 6, [1] * 400]
    got = periodic.runs_of([np.array(t, np.int64) for t in texts])
    for text, runs in zip(texts, got):
        assert runs == slow_runs(text)


def test_very_repetitive_texts_take_few_proposals():
    """A long period of short runs, Fibonacci words, and 50,000 equal words: found, and not by trying all pairs."""
    a, b = [0], [0, 1]
    while len(b) < 20_000:
        a, b = b, b + a
    nested = ([0] * 300 + [1]) * 40
    rng = random.Random(1)
    long = [rng.randrange(50) for _ in range(5000)] * 4
    texts = [b, nested, [3] * 50_000, long + long[:77]]
    sizes = [np.array(t, np.int64) for t in texts]
    got = periodic.runs_of(sizes)
    assert got[2] == [(0, 50_000, 1)] and got[3] == [(0, 20_077, 5000)]
    assert (0, 301 * 40, 301) in got[1] and len(got[1]) == 41
    short = b[:1500]
    assert periodic.runs_of([np.array(short)])[0] == slow_runs(short)


def test_strongest_run_and_ties():
    assert periodic.strongest([]) is None
    assert periodic.strongest([(0, 8, 2), (3, 6, 1), (20, 6, 1), (30, 12, 2)]) == (3, 6, 1)
    runs = [(5, 9_007_199_254_740_993, 2_251_799_813_685_249), (7, 9_007_199_254_740_992, 2_251_799_813_685_248)]
    assert periodic.strongest(runs) == max(runs, key=lambda r: Fraction(r[1], r[2]))


def test_repetitions_of_odd_documents(spark, odd, empty):
    rows = periodic.repetitions(odd, planted=planted_repetition).collect()
    docs = odd.collect()
    assert len(rows) == len(docs)
    expected = []
    for d in docs:
        words = (d.text or "").encode().split()
        taken = planted_repetition(d.doc_id, len(words))
        words = words if taken is None else [words[i] for i in taken]
        runs = slow_runs(words) if len(words) < 2000 else None
        if runs is not None:
            cut = {i for s, n, q in runs for i in range(s + q, s + n)}
            kept = b" ".join(w for i, w in enumerate(words) if i not in cut).decode()
            best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
            milli = best[0] is not None and 1000 * best[1] // best[2]
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
            expected.append((d.doc_id, len(runs), *best, None if milli is False else milli, lines, kept))
    got = [tuple(r) for r in rows if r.doc_id != 6]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert periodic.repetitions(empty).count() == 0


def test_planted_places():
    for doc_id in range(300):
        h = zlib.crc32(str(doc_id).encode())
        taken = planted_repetition(doc_id, 100)
        if h % 10:
            assert taken is None
            continue
        g = h // 10
        a, p = g % 100, 1 + (100 - g % 100) // (3 + g % 8)
        assert taken.tolist() == [i if i < a else a + (i - a) % p for i in range(100)]
    assert planted_repetition(None, 50) is None and planted_repetition(7, 0) is None
