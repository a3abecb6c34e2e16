"""Documents packed into token sequences of one length with little padding: best-fit decreasing.

A document is its token ids and a closing id. One longer than a window is first cut into full windows; what is
left over is a piece shorter than a window. Pieces are taken longest first, and a segment tree over remaining
capacities finds the tightest open window that still holds one. Tokenization and cutting need one pass and no
shuffle; the pieces, a few numbers each, are then dealt evenly into runs of bounded length, and each run is
packed by itself. A run ends with a few windows that are not full, so padding does not depend on how many
runs there are.

Null and empty texts are the closing id alone. Repeated rows are packed once each. Other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakestream.llm.bpe import byte_symbols
from lakestream.llm.corpus import batches, only, ready, settled

WINDOW = 1024
CLOSING_ID = 0
#: Pieces packed together; a run's memory and its last, unfilled windows are bounded by it. And tasks at most.
RUN_PIECES, MOST_TASKS = 20_000, 50_000
#: The published word pattern of byte-level vocabularies of this kind (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts with characters from here on go to the library that owns the file: its Unicode version decides.
RARE_LETTERS = "ɐ"


class ByteLevel:
    """Ids of a byte-level vocabulary file, by the faster of two libraries that agree on it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.own = Tokenizer.from_file(path)

    def ids(self, text: str) -> np.ndarray:
        if text.isascii() or max(text) < RARE_LETTERS:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
            except Exception as failed:  # its pattern engine gives up on very long runs of white space
                if "stack" not in str(failed).lower() and "backtrack" not in str(failed).lower():
                    raise
        return np.array(self.own.encode(text, add_special_tokens=False).ids, dtype="<u4")


@functools.lru_cache(maxsize=2)
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


def pieces(
    documents: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    closing_id: int = CLOSING_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, `start`, `length`, `ids_crc32`, `doc_tokens`, and on request `ids`."""
    ready(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()
    columns = f"id {key}, start long, length long, ids_crc32 long, doc_tokens long"
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = byte_level(path)
        closing = np.array([closing_id], dtype="<u4")
        for batch in batches(table, 4 << 20):
            row, start, length, crc, total, cuts = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.concatenate([level.ids(text or ""), closing])
                for at in range(0, len(ids), window):
                    cut = ids[at : at + window]
                    row.append(i)
                    start.append(at)
                    length.append(len(cut))
                    crc.append(zlib.crc32(cut.tobytes()))
                    total.append(len(ids))
                    if with_ids:
                        cuts.append(cut.astype("int32"))
            numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            more = [pa.array(cuts, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *numbers, *more], names)

    out = only(documents, id_col, text_col).mapInArrow(run, columns + ", ids array<int>" * with_ids)
    return out.withColumnRenamed("id", id_col)


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree whose nodes tell whether any is below."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def _mark(self, capacity: int) -> None:
        node = self.leaves + capacity
        self.any[node] = bool(self.at[capacity])
        while node > 1:
            node >>= 1
            state = self.any[2 * node] or self.any[2 * node + 1]
            if self.any[node] == state:
                return
            self.any[node] = state

    def add(self, sequence: int, capacity: int) -> None:
        self.at[capacity].append(sequence)
        if len(self.at[capacity]) == 1:
            self._mark(capacity)

    def take(self, length: int) -> tuple[int, int] | None:
        """The window with the least capacity that is at least `length`, taken out; None if there is none."""
        node = self.leaves + length
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        sequence = self.at[capacity].pop()
        if not self.at[capacity]:
            self._mark(capacity)
        return sequence, capacity


def best_fit(lengths: Sequence[int], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each piece its sequence and its offset there, and how many sequences there are."""
    lengths = np.asarray(lengths, dtype=np.int64)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_windows, count = OpenWindows(window), 0
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        found = open_windows.take(length) if length < window else None
        if found is None:
            found, count = (count, window), count + 1
        sequence[piece], capacity = found
        offset[piece] = window - capacity
        if capacity > length:
            open_windows.add(found[0], capacity - length)
    return sequence, offset, count


def pack(
    cut: DataFrame,
    window: int = WINDOW,
    run_pieces: int = RUN_PIECES,
    length_col: str = "length",
    total: int | None = None,
) -> DataFrame:
    """The pieces with `sequence_id` and `offset`. Offsets in a sequence leave no gap from 0.

    Runs have about `run_pieces` pieces. There is a task for each, up to `MOST_TASKS`; one of more packs them run by
    run. Sequence ids are unique, and
    ascending within a task. Without `total`, the number of pieces, the pieces are settled first to count
    them: right for pieces without ids, which are a few numbers each.
    """
    spark = ready(cut.sparkSession)
    if total is None:
        cut = settled(cut)
        total = cut.count()
    tasks = min(max(1, -(-total // run_pieces)), MOST_TASKS)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    where = cut.columns.index(length_col)

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, rows = TaskContext.get().partitionId() << 40, [], 0

        def packed() -> pa.Table:
            nonlocal base
            whole = pa.Table.from_batches(held)
            sequence, offset, count = best_fit(whole.column(where).to_numpy(), window)
            whole = whole.append_column("sequence_id", pa.array(sequence + base))
            base += count
            return whole.append_column("offset", pa.array(offset))

        for batch in table:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 2 * run_pieces:
                yield from packed().to_batches()
                held, rows = [], 0
        if rows:
            yield from packed().to_batches()

    spark.conf.set("spark.sql.execution.sortBeforeRepartition", "true")
    dealt = cut.repartition(tasks)
    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame, window: int = WINDOW, padding_id: int = CLOSING_ID) -> DataFrame:
    """One row per sequence from pieces with `ids`: `ids` padded to the window, and how many are not padding."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    padding = F.array_repeat(F.lit(padding_id), F.lit(window) - F.size("ids"))
    return joined.select(
        "sequence_id", F.size("ids").cast("long").alias("n_tokens"), F.concat("ids", padding).alias("ids")
    )
