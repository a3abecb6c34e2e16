"""Byte-pair encoding of whole texts with a public vocabulary, and decoding.

A word's symbols form a doubly linked list; a priority queue holds the merge ranks of adjacent pairs, lowest
rank and leftmost place first, and entries whose symbols have changed meanwhile are skipped. Decoding
concatenates vocabulary strings. The vocabulary file's own normalizer (NFC, white space to blanks, lower case)
and word pattern are followed, so ids equal those of the `tokenizers` library. Words recur, so each Python
worker remembers the results of recent words; a word that is not remembered is merged anew.

Null texts count as empty and give no ids. Repeated rows are encoded alike; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakestream.llm.corpus import batches, only, ready

#: Entries of a generation of remembered words or stretches; four generations are some 200 MB a worker.
REMEMBERED_WORDS = 250_000
#: Characters of a word or stretch that is remembered, at most.
REMEMBERED_SIZE = 64
#: Letters from here on are split by the library's own patterns: they know the same Unicode version as its ids.
RARE_LETTERS = "\u0250"
#: Separators that str.split honours and the vocabulary's pattern does not.
INFORMATION_SEPARATORS = regex.compile(r"[\x1c-\x1f]")
WHITE_SPACE = regex.compile(r"[\s--[\x1c-\x1f]]+", regex.V1)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


class Recent(dict):
    """A mapping filled on demand that keeps what was asked for recently.

    Two generations of at most `limit` entries each: an entry that is asked for again moves to the young one,
    and when that is full the old one goes. Keys of more than `REMEMBERED_SIZE` characters are made anew each time,
    so the bytes held are bounded too.
    """

    def __init__(self, make: Callable[[str], str], limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> str:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > REMEMBERED_SIZE:
            return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordBpe:
    """Encoder and decoder of a vocabulary whose words end with a marked symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in vocabulary.items()} | {i: s for s, i in self.special.items()}
        self.written = {str(i): s for i, s in self.strings.items()}
        end = model["end_of_word_suffix"]
        self.inner = [vocabulary[s] for s in byte_symbols()]
        self.last = [vocabulary[s + end] for s in byte_symbols()]
        self.pairs = [(vocabulary[left], vocabulary[right]) for left, right in model["merges"]]
        self.merged = [vocabulary[left + right] for left, right in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(self.pairs)}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.apart = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")")
        self.bytes_of = {s: b for b, s in enumerate(byte_symbols())}
        self.library = Tokenizer.from_file(path)
        self.words = Recent(lambda word: " ".join(map(str, self.merge(word.encode()))), REMEMBERED_WORDS)
        self.chunks = Recent(self.encode_chunk, REMEMBERED_WORDS)

    def merge(self, data: bytes) -> list[int]:
        """The ids of one word. An entry of the queue is a rank and a place, packed into one number."""
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        n = len(symbols)
        rank_of, pairs, width = self.ranks.get, self.pairs, n.bit_length()
        place = (1 << width) - 1
        queue = [
            rank << width | i
            for i, rank in enumerate(map(rank_of, zip(symbols, symbols[1:])))
            if rank is not None
        ]
        if not queue:
            return symbols
        heapq.heapify(queue)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heapq.heappop(queue)
            i, rank = entry & place, entry >> width
            j = following[i]
            if j >= n or (symbols[i], symbols[j]) != pairs[rank]:
                continue  # one of the two symbols has been merged since
            symbols[i], symbols[j] = self.merged[rank], -1
            k, h = following[j], before[i]
            following[i] = k
            if k < n:
                before[k] = i
                if (rank := rank_of((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(queue, rank << width | i)
            if h >= 0 and (rank := rank_of((symbols[h], symbols[i]))) is not None:
                heapq.heappush(queue, rank << width | h)
        return [s for s in symbols if s >= 0]

    def split(self, part: str) -> list[str]:
        """The words of a stretch without white space and special strings."""
        if part.isascii():
            return self.pattern.findall(part.lower())
        if max(part) < RARE_LETTERS:
            return self.pattern.findall(unicodedata.normalize("NFC", part).lower())
        plain = self.library.normalizer.normalize_str(part)
        found = self.library.pre_tokenizer.pre_tokenize_str(plain)
        return [bytes(self.bytes_of[c] for c in word).decode() for word, _ in found]

    def encode_chunk(self, chunk: str) -> str:
        """The ids, in decimal, of a stretch of text without white space."""
        if "<|" not in chunk:
            return " ".join(map(self.words.__getitem__, self.split(chunk)))
        ids = []
        for part in filter(None, self.apart.split(chunk)):
            if part in self.special:
                ids.append(str(self.special[part]))
            else:
                ids += map(self.words.__getitem__, self.split(part))
        return " ".join(ids)

    def encode_line(self, text: str) -> str:
        """The ids of a text in decimal, with a blank between them."""
        chunks = WHITE_SPACE.split(text) if INFORMATION_SEPARATORS.search(text) else text.split()
        return " ".join(filter(None, map(self.chunks.__getitem__, filter(None, chunks))))

    def decode_line(self, line: str) -> str:
        return " ".join(map(self.written.__getitem__, line.split())) if line else ""

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encode_line(text).split()))

    def decode(self, ids: Sequence[int]) -> str:
        """Vocabulary strings with a blank between them; ids outside the vocabulary give nothing."""
        return " ".join(self.strings[i] for i in ids if i in self.strings)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def encode(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, `ids` and the `decoded` text."""
    ready(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches(table):
            ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
            decoded = pa.array([bpe.decode(i) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), decoded], ["id", "ids", "decoded"]
            )

    out = only(documents, id_col, text_col).mapInArrow(run, f"id {key}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)


def digests(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: `n_tokens`, and SHA-256 of its ids and of its decoded text.

    The same encoder as `encode`, but ids stay in decimal and never leave the task.
    """
    ready(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches(table):
            counts, ids_sha, decoded_sha = [], [], []
            for text in batch.column(1).to_pylist():
                line = bpe.encode_line(text or "")
                counts.append(line.count(" ") + 1 if line else 0)
                ids_sha.append(hashlib.sha256(line.encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(bpe.decode_line(line).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    out = only(documents, id_col, text_col).mapInArrow(
        run, f"id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per document: its id and the `text` that its ids stand for (null ids: empty)."""
    ready(encoded.sparkSession)
    key = encoded.schema[id_col].dataType.simpleString()

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches(table):
            texts = [bpe.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    source = only(encoded, id_col, ids_col).withColumn(ids_col, F.col(ids_col).cast("array<int>"))
    return source.mapInArrow(run, f"id {key}, text string").withColumnRenamed("id", id_col)
