"""Removal of passages that a document with a smaller id has as well, by super-k-mers.

A window is `WINDOW` consecutive words. Its minimiser is the least hash among its runs of `MINIMISER` words, so
neighbouring windows mostly share it. Consecutive windows of a document with one minimiser travel as one packed
string, their words joined by blanks, to the bucket of the minimiser; equal windows have equal minimisers and
meet there. A bucket sorts the windows of its strings, by hash and among equal hashes by their words, so every
group of equal windows is exact; the windows that do not belong to the least id of their group are marked, and
marks go back to their documents.

Before anything is shuffled, equal strings of a task are combined: only those of the least id travel, the others
are marked at once. So a passage or a document with very many copies sends a string per task. Buckets are as many
as the corpus needs for each to fit in memory; those of a very frequent minimiser, which would not, are counted
first and go another way: window by window through a combined minimum and a join that AQE can split.

Words are stretches of bytes other than ASCII white space, unchanged. Windows are judged on the input, not on what
is left. Null, empty and blank texts have no words; a text of fewer words than a window keeps them all. Long texts
are packed piece by piece. Repeated rows are rows of one id: neither is smaller, and each gives its row. Rows that
share an id but not the text are told apart by a 64-bit hash of it. A null id is neither smaller nor larger than
another: such rows keep all their words and remove none. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm.corpus import batches, only, ready, settled
from lakestream.llm.words import RunHashes, Words, least_of, mixed, words_of

WINDOW, MINIMISER = 13, 2
#: Bytes of text whose words are hashed at once, and whose strings are combined before they travel.
HASHED_BYTES, COMBINED_BYTES = 1 << 20, 8 << 20
#: Words of a long text that are packed at once.
PIECE_WORDS = 100_000
#: Bytes of text for each bucket; the strings have about three times as many.
BUCKET_BYTES = 1 << 21
#: Numbers that are broadcast, at most, to tell which documents lose words.
CELLS = 1 << 18
#: Strings of large buckets that are spelled out at once.
SPELLED = 2000
#: A bucket of more windows than this goes window by window.
LARGE_BUCKET = 1_500_000

Entry = tuple[object, list[tuple[int, int]]]
Mark = tuple[object, int, int, int]


def pieces(text: bytes, window: int) -> Iterator[tuple[int, bytes]]:
    """The number of the first word, and the text; long ones in pieces that have all windows between them."""
    if len(text) <= HASHED_BYTES:
        yield 0, text
        return
    words = text.split()
    for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS):
        yield at, b" ".join(words[at : at + PIECE_WORDS + window - 1])


def window_starts(words: Words, window: int) -> np.ndarray:
    """Numbers of the words at which a window starts."""
    n = len(words.starts) - window + 1
    return np.flatnonzero(words.text[:n] == words.text[window - 1 :]) if n > 0 else np.zeros(0, np.int64)


def runs(words: Words, window: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers: the first word, the number of windows and the minimiser."""
    starts = window_starts(words, window)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    ahead = np.arange(len(words.starts) - minimiser + 1)
    grams = mixed(RunHashes(words.hashes).of(ahead, ahead + minimiser))
    least = least_of(grams, window - minimiser + 1)[starts]
    new = np.append(True, (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1))
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))), least[first]


class Combined:
    """Strings with the least id that has them and where; what larger ids have is marked."""

    def __init__(self) -> None:
        self.held: dict[bytes, Entry] = {}
        self.marks: list[Mark] = []

    def add(self, string: bytes, key: object, places: list[tuple[int, int]], windows: int) -> None:
        entry = self.held.get(string)
        if entry is None:
            self.held[string] = (key, places)
        elif entry[0] == key:
            entry[1].extend(places)
        elif entry[0] < key:
            self.marks += [(key, row, start, windows) for row, start in places]
        else:
            self.marks += [(entry[0], row, start, windows) for row, start in entry[1]]
            self.held[string] = (key, places)


def marks_of(strings: dict[bytes, Entry], window: int) -> Iterator[Mark]:
    """Windows of a bucket that a smaller id has too."""
    texts, entries = list(strings), list(strings.values())
    ranks = {key: i for i, key in enumerate(sorted({e[0] for e in entries}))}
    rank = np.array([ranks[e[0]] for e in entries], np.int64)
    words = words_of(texts)
    at = window_starts(words, window)
    hashes = RunHashes(words.hashes).of(at, at + window)
    order = np.argsort(hashes, kind="stable")
    at, hashes = at[order], hashes[order]
    owner = rank[words.text[at]]
    new = np.append(True, hashes[1:] != hashes[:-1])[: len(at)]
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(at)))
    low = np.minimum.reduceat(owner, first) if len(first) else owner
    high = np.maximum.reduceat(owner, first) if len(first) else owner
    found = []
    begin, stop, data = words.starts, words.ends, words.data
    for f, size in zip(first[low < high].tolist(), sizes[low < high].tolist()):
        rows = at[f : f + size].tolist()
        spelled = [data[begin[i] : stop[i + window - 1]] for i in rows]
        owners = owner[f : f + size].tolist()
        least: dict[bytes, int] = {}
        for string, who in zip(spelled, owners):
            least[string] = min(who, least.get(string, who))
        found += [i for i, string, who in zip(rows, spelled, owners) if who > least[string]]
    if not found:
        return
    found = np.sort(np.array(found))
    breaks = np.append(True, (np.diff(found) != 1) | (np.diff(words.text[found]) != 0))
    first = np.flatnonzero(breaks)
    base = np.searchsorted(words.text, np.arange(len(texts)))
    for i, size in zip(found[first].tolist(), np.diff(np.append(first, len(found))).tolist()):
        text = int(words.text[i])
        key, places = entries[text]
        for row, start in places:
            yield key, row, start + i - int(base[text]), size


class Packer:
    """What a task does with its documents."""

    def __init__(self, buckets: int, window: int, minimiser: int):
        self.buckets, self.window, self.minimiser = buckets, window, minimiser

    def hashed(self, table: Iterable[pa.RecordBatch]) -> Iterator[tuple[Words, list[tuple[object, int, int]]]]:
        """Words of some texts, and of each the id, the hash of its row and the number of its first word."""
        texts: list[bytes] = []
        rows: list[tuple[object, int, int]] = []
        size = 0
        for batch in batches(table):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key is None or not text:
                    continue
                row = row_hash(text)
                for at, piece in pieces(text, self.window):
                    texts.append(piece)
                    rows.append((key, row, at))
                    size += len(piece)
                    if size >= HASHED_BYTES:
                        yield words_of(texts), rows
                        texts, rows, size = [], [], 0
        if texts:
            yield words_of(texts), rows

    def bucket(self, least: np.ndarray) -> np.ndarray:
        return (mixed(least + np.uint64(1)) % np.uint64(self.buckets)).astype(np.int64)

    def sizes(self, table: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows for each bucket, those of equal strings of a task's step once."""
        total = np.zeros(self.buckets, np.int64)
        for words, _ in self.hashed(table):
            first, windows, least = runs(words, self.window, self.minimiser)
            strings = RunHashes(words.hashes).of(first, first + windows + self.window - 1)
            _, once = np.unique(strings, return_index=True)
            total += np.bincount(self.bucket(least[once]), windows[once], self.buckets).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "windows"])

    def combined(self, table: Iterable[pa.RecordBatch]) -> Iterator[dict[int, Combined]]:
        """By bucket, the strings of some of the documents."""
        out: dict[int, Combined] = defaultdict(Combined)
        size = 0
        for words, rows in self.hashed(table):
            first, windows, least = runs(words, self.window, self.minimiser)
            text = words.text[first]
            base = np.searchsorted(words.text, np.arange(len(rows)))
            begin, stop = words.starts[first], words.ends[first + windows + self.window - 2]
            columns = [x.tolist() for x in (self.bucket(least), begin, stop, text, first - base[text], windows)]
            data = words.data
            for bucket, a, b, t, start, n in zip(*columns):
                key, row, at = rows[t]
                out[bucket].add(data[a:b], key, [(row, at + start)], n)
            size += len(data)
            if size >= COMBINED_BYTES:
                yield out
                out, size = defaultdict(Combined), 0
        if out:
            yield out


def row_hash(text: bytes) -> int:
    """Spark's `xxhash64` of a text."""
    return int(np.uint64(xxhash.xxh64_intdigest(text, 42)).astype(np.int64))


def marks(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    minimiser: int = MINIMISER,
    bucket_bytes: int = BUCKET_BYTES,
    large_bucket: int = LARGE_BUCKET,
) -> DataFrame:
    """Stretches of windows to remove: `id`, `row` (a hash of the text), `start` (word number), `windows`."""
    ready(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()
    source = only(documents, id_col, text_col).withColumn(text_col, F.col(text_col).cast("binary"))
    volume = source.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    packer = Packer(max(16, -(-volume // bucket_bytes)), window, minimiser)
    sized = source.mapInArrow(packer.sizes, "bucket long, windows long").groupBy("bucket").agg(F.sum("windows").alias("n"))
    # at most a bucket for each `large_bucket` windows of the corpus
    large = frozenset(r.bucket for r in sized.filter(F.col("n") > large_bucket).collect())

    names = ["bucket", "strings", "sizes", "ids", "rows", "starts", "mark_ids", "mark_rows", "mark_starts", "mark_windows"]
    schema = (
        f"bucket long, strings binary, sizes array<int>, ids array<{key}>, rows array<long>, starts array<long>, "
        f"mark_ids array<{key}>, mark_rows array<long>, mark_starts array<long>, mark_windows array<long>"
    )

    def pack(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each bucket; of a large one, only what is already marked."""
        squeeze = zstandard.ZstdCompressor(level=3).compress
        first, table = _opened(table)
        for found in packer.combined(table):
            for bucket, combined in found.items():
                held = {} if bucket in large else combined.held
                places = [p for e in held.values() for p in e[1]]
                marked = list(zip(*combined.marks)) or [[]] * 4
                values = [
                    *(bucket, squeeze(b"\n".join(held)), [len(e[1]) for e in held.values()], [e[0] for e in held.values()]),
                    *([p[0] for p in places], [p[1] for p in places], *map(list, marked)),
                ]
                ids, longs = pa.list_(first), pa.list_(pa.int64())
                types = [pa.int64(), pa.binary(), pa.list_(pa.int32()), ids, longs, longs, ids, longs, longs, longs]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    def count(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The marks of each bucket; its rows come one after another."""
        expand = zstandard.ZstdDecompressor().decompress
        first, table = _opened(table)
        now, held = None, Combined()
        for batch in batches(table):
            for r in batch.to_pylist():
                if r["bucket"] != now:
                    yield _marks(held.marks + list(marks_of(held.held, window)), first)
                    now, held = r["bucket"], Combined()
                held.marks += zip(r["mark_ids"], r["mark_rows"], r["mark_starts"], r["mark_windows"])
                at = 0
                for string, n, owner in zip(expand(r["strings"]).split(b"\n"), r["sizes"], r["ids"]):
                    places = list(zip(r["rows"][at : at + n], r["starts"][at : at + n]))
                    held.add(string, owner, places, string.count(b" ") + 2 - window)
                    at += n
        yield _marks(held.marks + list(marks_of(held.held, window)), first)

    def spell(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows of large buckets."""
        first, table = _opened(table)
        for found in packer.combined(table):
            for bucket in large & found.keys():
                for some in _some(found[bucket].held.items(), SPELLED):
                    rows = [
                        (b" ".join(spelled[i : i + window]), key, row, start + i)
                        for spelled, (key, places) in ((string.split(b" "), entry) for string, entry in some)
                        for i in range(len(spelled) - window + 1)
                        for row, start in places
                    ]
                    types = [pa.binary(), first, pa.int64(), pa.int64()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays(columns, ["words", "id", "row", "start"])

    packed = source.mapInArrow(pack, schema).repartition("bucket").sortWithinPartitions("bucket")
    out = packed.mapInArrow(count, f"id {key}, row long, start long, windows long")
    if large:
        windows = source.mapInArrow(spell, f"words binary, id {key}, row long, start long")
        # the minimum is combined before its shuffle and settled before the join, so that AQE can split the join
        least = settled(windows.groupBy("words").agg(F.min("id").alias("least")))
        later = windows.join(least, "words").filter(F.col("id") > F.col("least"))
        out = out.unionByName(later.select("id", "row", "start", F.lit(1).cast("long").alias("windows")))
    return out


def _opened(table: Iterator[pa.RecordBatch]) -> tuple[pa.DataType | None, Iterator[pa.RecordBatch]]:
    """The type of ids, which stand in the first column or in one of that name, and the same batches."""
    first = next(table, None)
    if first is None:
        return pa.int64(), iter(())
    field = first.schema.field("ids" if "ids" in first.schema.names else 0)
    return getattr(field.type, "value_type", field.type), itertools.chain([first], table)


def _some(items: Iterable, n: int) -> Iterator[list]:
    items = iter(items)
    while some := list(itertools.islice(items, n)):
        yield some


def _marks(rows: list[Mark], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    types = [kind, pa.int64(), pa.int64(), pa.int64()]
    arrays = [pa.array(c, t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, ["id", "row", "start", "windows"])


def kept_words(text: bytes, stretches: Iterable[tuple[int, int]], window: int = WINDOW) -> tuple[int, list[bytes]]:
    """How many words a text has, and those outside all windows of the stretches (first word, windows)."""
    words = text.split()
    cover = np.zeros(len(words) + 1, np.int64)
    for start, n in stretches:
        cover[start] += 1
        cover[start + n + window - 1] -= 1
    keep = np.cumsum(cover[:-1]) == 0
    return len(words), list(itertools.compress(words, keep.tolist()))


def without_repeats(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, **settings
) -> DataFrame:
    """One row per document: id, `n_words`, `n_removed`, and `kept`, its remaining words joined by blanks. Only
    documents that share one of `CELLS` cells with one that loses words are shuffled."""
    ready(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()
    found = marks(documents, id_col, text_col, window, **settings)
    # a row per document that loses words; no more stretches than it has words
    found = settled(found.groupBy("id", "row").agg(F.collect_list(F.struct("start", "windows")).alias("stretches")))
    source = only(documents, id_col, text_col).toDF("id", "text")
    cell = F.pmod(F.xxhash64("id", "row"), F.lit(CELLS))
    rows = source.withColumn("row", F.xxhash64("text")).withColumn("cell", cell)
    cells = F.broadcast(found.select(cell.alias("cell")).distinct())

    def remove(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            out = []
            for text, stretches in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out.append(kept_words(text or b"", [(s["start"], s["windows"]) for s in stretches or ()], window))
            n, kept = [n for n, _ in out], [k for _, k in out]
            columns = [
                batch.column(0),
                pa.array(n, pa.int64()),
                pa.array([m - len(k) for m, k in zip(n, kept)], pa.int64()),
                pa.array([b" ".join(k) for k in kept], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept"])

    clear = rows.join(cells, "cell", "left_anti").withColumn("stretches", F.lit(None).cast(found.schema["stretches"].dataType))
    rest = rows.join(cells, "cell", "left_semi").join(found, ["id", "row"], "left")
    joined = clear.select("id", "text", "stretches").unionByName(rest.select("id", "text", "stretches"))
    joined = joined.withColumn("text", F.col("text").cast("binary"))
    out = joined.mapInArrow(remove, f"id {key}, n_words long, n_removed long, kept binary")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))
