"""Periodic runs of words: stretches that repeat themselves at least four times, found by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), of at least
max(6, 4 * q) words, that neither neighbour extends with period q. Every run of a text is found, in about n log n
steps however repetitive the text is:

Periods up to `DIRECT` are found by direct scans: for each lag, maximal stretches of words equal to those a lag
further on. Longer periods belong to a scale: scale W (8, 16, 32, ...) finds periods above 2 W up to 4 W. Each position
has the hash of the W words from there, and each window of W positions selects its least, the leftmost of equal
ones. What a window selects depends on its words alone, so inside a run selected positions come again a period
later, and pairs of selected positions with one hash, more than 2 W and up to 4 W apart, propose their distance as a
period. A proposal is dropped unless the blocks of that length before, at, after and one further after the position
have one hash; the others are extended word by word, left and right, and kept if long enough and if their period is
the smallest.

Positions that lie a period or more inside a run with a period up to W / 2, W words in it included, select
nothing. So equal selected positions of scale W are more than W / 3 apart and a proposal has few partners, and yet each
run of a longer period keeps a position to select: two runs overlap by less than their periods together, so such
stretches leave gaps, and one that filled a whole period of the longer run would be that run.

Words are stretches of bytes other than ASCII white space. Null, empty and blank texts have no words, no run and
null columns of the longest run. Repeated rows give a row each; null ids are ids like any other; further columns are
ignored. A text is held whole in memory, at about a hundred bytes a word.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm.corpus import batches, only, ready
from lakestream.llm.words import RunHashes, mixed

DIRECT, FIRST_SCALE = 16, 8
LEAST_WORDS, LEAST_REPEATS = 6, 4
BATCH_BYTES = 2 << 20
#: Words compared at once at first, when a proposal is extended.
STRIDE = 64
NOTHING = np.uint64(0xFFFFFFFFFFFFFFFF)

Run = tuple[int, int, int]


def least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_REPEATS * period)


def primes_of(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] * (n > 1)


def smallest(codes: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch with this period has no smaller one; such a one would divide it."""
    root = codes[start : start + period]
    return not any(np.array_equal(root[: period - d], root[d:]) for d in (period // r for r in primes_of(period)))


def direct_runs(codes: np.ndarray, period: int) -> Iterator[Run]:
    """Runs of a short period in texts that are separated by a code of its own each."""
    same = np.zeros(max(0, len(codes) - period) + 2, np.int8)
    same[1:-1] = codes[period:] == codes[:-period] if len(codes) > period else 0
    turns = np.diff(same)
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    long = ends - starts >= least_length(period) - period
    for start, end in zip(starts[long].tolist(), ends[long].tolist()):
        if smallest(codes, start, period):
            yield start, end - start + period, period


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Of each `width` consecutive values the place of the least, the leftmost of equal ones."""
    at, done = np.arange(len(values)), 1
    while done < width:
        step = min(done, width - done)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        done += step
    return at


def equal_words(codes: np.ndarray, at: int, period: int, stop: int, way: int) -> int:
    """How many words from `at` on, to the right or the left, equal those a period further on, before `stop`."""
    count, stride = 0, STRIDE
    while True:
        size = min(stride, (stop - at - count) if way > 0 else (at - count - stop + 1))
        if size <= 0:
            return count
        low = at + count if way > 0 else at - count - size + 1
        differ = np.flatnonzero(codes[low : low + size] != codes[low + period : low + period + size])
        if len(differ):
            return count + (int(differ[0]) if way > 0 else size - 1 - int(differ[-1]))
        count += size
        stride *= 2


def proposals(
    codes: np.ndarray, text: np.ndarray, borders: np.ndarray, blocked: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions and periods that minimizers of a scale propose. `text` numbers the text of each word, `borders`
    holds where texts begin, and the end; `blocked` marks positions that select nothing."""
    n = len(codes) - width + 1
    hashes = RunHashes(mixed(codes.astype(np.uint64) + np.uint64(1)))
    ahead = np.arange(n)
    values = mixed(hashes.of(ahead, ahead + width))
    values[blocked[:n] | (text[:n] != text[width - 1 :])] = NOTHING
    chosen = np.unique(leftmost_least(values, width)) if n >= width else ahead[:0]
    chosen = chosen[values[chosen] != NOTHING]
    chosen = chosen[np.argsort(values[chosen], kind="stable")]
    places, periods = [], []
    for step in itertools.count(1):
        a, b = chosen[:-step], chosen[step:]
        near = (values[a] == values[b]) & (text[a] == text[b]) & (b - a <= 4 * width)
        if not near.any():
            break
        wanted = near & (b - a > 2 * width)
        places.append(a[wanted])
        periods.append((b - a)[wanted])
    at = np.concatenate(places or [ahead[:0]])
    period = np.concatenate(periods or [ahead[:0]])
    inside = (at - period >= borders[text[at]]) & (at + 2 * period <= borders[text[at] + 1])
    at, period = at[inside], period[inside]
    blocks = [hashes.of(at + k * period, at + (k + 1) * period) for k in (-1, 0, 1)]
    same = (blocks[0] == blocks[1]) & (blocks[1] == blocks[2])
    return at[same], period[same]


def runs_of(texts: Sequence[np.ndarray]) -> list[list[Run]]:
    """The runs of each text, given as codes of its words (not negative), by start, then period."""
    found: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    parts = [p for i, t in enumerate(texts) for p in (t, np.array([-1 - i]))]
    codes = np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64)
    begins = np.cumsum(np.append(0, sizes + 1))
    for period in range(1, DIRECT + 1):
        for start, length, _ in direct_runs(codes, period):
            i = int(np.searchsorted(begins, start, side="right")) - 1
            found[i].append((start - int(begins[i]), length, period))
    width = FIRST_SCALE
    while True:
        names = np.flatnonzero(sizes > 2 * LEAST_REPEATS * width)
        if not len(names):
            break
        codes = np.concatenate([texts[i] for i in names])
        borders = np.cumsum(np.append(0, sizes[names]))
        text = np.repeat(np.arange(len(names)), sizes[names])
        zones = np.zeros(len(codes) + 1, np.int32)
        for k, i in enumerate(names.tolist()):
            for start, length, period in found[i]:
                if 2 * period <= width and length - width >= period:
                    zones[borders[k] + start + period] += 1
                    zones[borders[k] + start + length - width + 1] -= 1
        held: dict[tuple[int, int], list[tuple[int, int]]] = {}
        at, periods = proposals(codes, text, borders, np.cumsum(zones[:-1]) > 0, width)
        for place, period in sorted(zip(at.tolist(), periods.tolist())):
            k = int(text[place])
            known = held.setdefault((k, period), [])
            if any(a <= place < b for a, b in known):
                continue
            low, high = int(borders[k]), int(borders[k + 1])
            right = equal_words(codes, place, period, high - period, 1)
            left = equal_words(codes, place - 1, period, low, -1)
            start, length = place - left, left + right + period
            known.append((start, start + left + right))
            if length >= least_length(period) and smallest(codes, start, period):
                found[names[k]].append((start - low, length, period))
        width *= 2
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def strongest(runs: Sequence[Run]) -> Run | None:
    """The run with the greatest length for its period; of equal ones the first, then that of least period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def left_out(n: int, runs: Sequence[Run]) -> np.ndarray:
    """Which of `n` words a run contains after its first period."""
    turns = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        turns[start + period] += 1
        turns[start + length] -= 1
    return np.cumsum(turns[:-1]) > 0


#: What a planted repetition makes of a text's words: their number and the id give the places to take them from.
Planted = Callable[[object, int], np.ndarray | None]


def repetitions(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: Planted | None = None
) -> DataFrame:
    """One row per document: id, `n_runs`; `start`, `length`, `period` and `exponent_milli` of its strongest run;
    `runs`, all of them as lines; `collapsed`, its words without those that a run repeats."""
    ready(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table, BATCH_BYTES):
            words = [(t or b"").split() for t in batch.column(1).to_pylist()]
            for i, key_value in enumerate(batch.column(0).to_pylist() if planted else ()):
                taken = planted(key_value, len(words[i]))
                if taken is not None:
                    words[i] = [words[i][j] for j in taken.tolist()]
            flat = pa.array(itertools.chain.from_iterable(words), pa.binary())
            codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
            found = runs_of(np.split(codes, np.cumsum([len(w) for w in words])[:-1]))
            best = [strongest(runs) for runs in found]
            texts = []
            for own, runs in zip(words, found):
                texts.append(b" ".join(itertools.compress(own, (~left_out(len(own), runs)).tolist()) if runs else own))
            lines = ["".join(f"{s},{n},{q}\n" for s, n, q in runs) for runs in found]
            columns = [
                batch.column(0),
                pa.array([len(runs) for runs in found], pa.int64()),
                *(pa.array([b and b[k] for b in best], pa.int64()) for k in range(3)),
                pa.array([b and 1000 * b[1] // b[2] for b in best], pa.int64()),
                pa.array(lines, pa.string()),
                pa.array(texts, pa.binary()),
            ]
            names = ["id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"]
            yield pa.RecordBatch.from_arrays(columns, names)

    source = only(documents, id_col, text_col).toDF("id", "text").withColumn("text", F.col("text").cast("binary"))
    longs = "n_runs long, start long, length long, period long, exponent_milli long"
    out = source.mapInArrow(run, f"id {key}, {longs}, runs string, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string")).withColumnRenamed("id", id_col)
