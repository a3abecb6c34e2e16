"""Byte-pair encoding and packing against the library that owns the vocabulary files."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakestream.llm import bpe, packing

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = (
    "a b Z İ Σ ς 's 'T \t \x1c \x1f \x85   　 ́ é ß ñ 1 ٣ ² <|endoftext|> <|startoftext|> <| 😀 漢字 \n ... ! ﬁ "
    "Ⅷ \x00 가 ᄀ ᅡ ǅ Ա ֋ the thing"
).split(" ") + [" ", "  ", "\n\n"]


def jumbles(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(n)]


def test_encoder_agrees_with_the_library():
    own, library = bpe.WordBpe(WORD), Tokenizer.from_file(WORD)
    for text in jumbles(1500, 1):
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, repr(text)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
        assert own.decode_line(own.encode_line(text)) == own.decode(ids)


def test_long_word_and_forgetting():
    own, library = bpe.WordBpe(WORD), Tokenizer.from_file(WORD)
    word = "abcabd" * 3000
    assert own.encode(word) == library.encode(word, add_special_tokens=False).ids
    few = bpe.Recent(str.upper, 2)
    assert [few[c] for c in "abcabcaa"] == list("ABCABCAA")
    assert len(few) <= 2 and len(few.old) <= 2


def test_digests_of_odd_documents(odd, empty):
    library = Tokenizer.from_file(WORD)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for r in odd.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    found = [tuple(r) for r in bpe.digests(odd, WORD).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert bpe.digests(empty, WORD).count() == 0


def test_round_trip_through_tables(odd):
    encoded = bpe.encode(odd, WORD)
    again = bpe.decode(encoded, WORD)
    assert sorted((str(r.doc_id), r.decoded) for r in encoded.collect()) == sorted(
        (str(r.doc_id), r.text) for r in again.collect()
    )


def test_byte_level_ids_agree_with_the_library():
    level, library = packing.byte_level(BYTE), Tokenizer.from_file(BYTE)
    for text in [*jumbles(1500, 2), " " * 50_000, "x" * 5000]:
        assert level.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:80])


def naive_best_fit(lengths, window):
    left, where = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(c, s) for s, c in enumerate(left) if c >= lengths[i]]
        if not fits:
            left.append(window)
            fits = [(window, len(left) - 1)]
        tightest = min(c for c, _ in fits)
        s = [s for c, s in fits if c == tightest][-1]
        where[i] = s
        left[s] -= lengths[i]
    return left


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([1, 7, 64, 100])
    lengths = [rng.randint(1, window) for _ in range(rng.randint(0, 300))]
    sequence, offset, count = packing.best_fit(lengths, window)
    used = [[] for _ in range(count)]
    for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths):
        used[s].append((o, n))
    for parts in used:
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= window
    assert sorted(window - sum(n for _, n in p) for p in used) == sorted(naive_best_fit(lengths, window))


def test_packing_odd_documents(odd, empty):
    library = Tokenizer.from_file(BYTE)
    cut = packing.pieces(odd, BYTE, with_ids=True)
    rows = packing.pack(cut).collect()
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length <= 1024
    whole = {}
    for r in odd.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        whole.setdefault(r.doc_id, []).append(ids)
    for doc_id, texts in whole.items():
        parts = [r for r in rows if r.doc_id == doc_id]
        assert sum(r.length for r in parts) == sum(map(len, texts))
        if len(texts) == 1:
            assert sum((list(r.ids) for r in sorted(parts, key=lambda r: r.start)), []) == texts[0]
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        ends = [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert packing.pack(packing.pieces(empty, BYTE)).count() == 0
    padded = packing.sequences(packing.pack(packing.pieces(odd, BYTE, with_ids=True))).collect()
    assert {len(r.ids) for r in padded} == {1024} and sum(r.n_tokens for r in padded) == sum(r.length for r in rows)


def test_runs_of_bounded_length(odd):
    packed = packing.pack(packing.pieces(odd, BYTE), run_pieces=5).collect()
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(packed)


def test_long_words_are_not_remembered():
    recent = bpe.Recent(str.upper, 10)
    for word in ("a" * 64, "b" * 65, "c" * 10_000):
        assert recent[word] == word.upper()
    assert set(recent) == {"a" * 64}


def test_tasks_are_bounded(spark, monkeypatch):
    """Runs are packed one after another where there would be more of them than tasks."""
    monkeypatch.setattr(packing, "MOST_TASKS", 2)
    rows = spark.range(900).selectExpr("id AS doc_id", "0L AS start", "1 + id * 37 % 1024 AS length")
    packed = packing.pack(rows, run_pieces=100)
    assert packed.rdd.getNumPartitions() <= 2
    found = packed.groupBy("sequence_id").agg({"length": "sum", "offset": "max"}).collect()
    assert all(r["sum(length)"] <= 1024 for r in found) and sum(r["sum(length)"] for r in found) == sum(1 + i * 37 % 1024 for i in range(900))
    assert sum(r["sum(length)"] for r in found) / (1024 * len(found)) > 0.9
