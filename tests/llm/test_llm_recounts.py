"""Whole results of the trained and placing operators against plain loops over the same rows."""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pytest

from lakestream.llm import langid, sharding, toxicity


def made_texts(seed, n=60):
    rng = random.Random(seed)
    parts = "you idiot not never scum said kill killing the a quiet river stinkt is er no! . ; ? don't “ old idiots".split()
    texts = [" ".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(n)]
    return [*texts, None, "", " \n", "Ünï cødé 42", "idiot " * 3000]


# ---- toxicity ----


def slow_score(text, model):
    """The score of a text, clause by clause and word by word, without the machines."""
    lists = {w: s for s, words in (("T", toxicity.THREATS), ("G", toxicity.TARGETS), ("N", toxicity.NEGATIONS), ("R", toxicity.REPORTS)) for w in words.split()}
    totals = []
    for clause in re.split(r"[.!?;:\n\r]+", (text or "").lower()):
        clause = re.sub(r"[\"“”„«»]", " said ", re.sub(r"n['’]t\b", " not", clause))
        reach, reported, insults, threats, target = 0, False, 0.0, 0.0, False
        for word in re.findall(r"[^\W\d_]+", clause):
            kind = lists.get(word)
            if kind == "N":
                reach = toxicity.NEGATION_REACH
                continue
            known = [v for stem, v in model.stems.items() if stem == word + "$" or (4 <= len(stem) <= toxicity.LONGEST_STEM and word.startswith(stem))]
            weight = max(known, default=0.0) * (toxicity.NEGATED if reach else 1) * (toxicity.REPORTED if reported else 1)
            if kind == "T":
                threats += toxicity.THREAT_WEIGHT * (toxicity.NEGATED if reach else 1) * (toxicity.REPORTED if reported else 1)
            elif kind == "G":
                target = True
            elif kind == "R":
                reported = True
            else:
                insults += weight
            reach = max(0, reach - 1)
        totals.append(max(insults, insults * toxicity.TARGETED + threats if target else 0.0))
    totals = [t for t in totals if t > 0]
    z = model.bias + model.weights[0] * math.log1p(sum(totals)) + model.weights[1] * math.log1p(max(totals, default=0))
    return 1 / (1 + math.exp(-z))


def test_scores_of_documents(spark):
    model = toxicity.Model({"idio": 6.0, "scum$": 5.0, "stin": 1.5}, -4.0, (1.1, 0.7))
    texts = made_texts(1)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        expected = slow_score(text, model)
        assert rows[i].score == pytest.approx(expected) and rows[i].predicted == int(expected >= 0.5)
    assert 0 < sum(r.predicted for r in rows.values()) < len(texts)


# ---- language ----


def slow_layer(data, inputs, recurrent):
    """States of one gated layer over the bytes of a word, unit by unit."""
    size = recurrent.shape[0]
    hidden, states = [0.0] * size, []
    for byte in data:
        back = [sum(hidden[k] * recurrent[k][j] for k in range(size)) for j in range(3 * size)]
        keep = [1 / (1 + math.exp(-(inputs[byte][j] + back[j]))) for j in range(size)]
        reset = [1 / (1 + math.exp(-(inputs[byte][size + j] + back[size + j]))) for j in range(size)]
        new = [math.tanh(inputs[byte][2 * size + j] + reset[j] * back[2 * size + j]) for j in range(size)]
        hidden = [keep[j] * hidden[j] + (1 - keep[j]) * new[j] for j in range(size)]
        states.append(hidden)
    return states


def slow_language(text, network):
    """The mean probability of each language over all positions of the words of a text."""
    weights = [w.astype(float).tolist() for w in network.weights]
    arrays = [np.array(w) for w in weights]
    total, positions = [0.0] * len(network.languages), 0
    for word in langid.letter_runs(text or ""):
        ahead = slow_layer(word, weights[0], arrays[1])
        behind = slow_layer(word[::-1], weights[2], arrays[3])[::-1]
        for a, b in zip(ahead, behind):
            scores = [weights[5][k] + sum(s * weights[4][j][k] for j, s in enumerate(a + b)) for k in range(len(total))]
            top = max(scores)
            shares = [math.exp(s - top) for s in scores]
            total = [t + s / sum(shares) for t, s in zip(total, shares)]
            positions += 1
    return [t / positions for t in total] if positions else None


def test_probabilities_of_documents(spark):
    network = langid.Network.fresh(["aa", "bb", "cc"], hidden=4, seed=3)
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["kato", "schön", "olé", "x", "42", "Ñandú!", "a" * 30], k=rng.randint(1, 9))) for _ in range(25)]
    texts += [None, "", "12 !?", "漢字かな"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in langid.identify(table, network).collect()}
    for i, text in enumerate(texts):
        expected = slow_language(text, network)
        if expected is None:
            assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
        else:
            best = max(range(3), key=expected.__getitem__)
            assert rows[i].lang_pred == network.languages[best] and rows[i].score == pytest.approx(expected[best], abs=1e-4)
    assert len({r.lang_pred for r in rows.values()}) >= 3


# ---- shards ----


def test_every_record_is_placed(spark, odd, tmp_path):
    """Sizes, checksums, slots without gaps, and shards as a plain placing of the virtual slots gives them."""
    texts = made_texts(4, 400)
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7])] * 3 + [(None, "no id"), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    slots = 64
    placed = sharding.sharded(table, str(tmp_path / "map"), slots=slots, shards=5).collect()
    raw = [("" if t is None else t).encode() for _, t in rows]
    expected = sorted((str(i), len(b) + 1, zlib.crc32(b)) for (i, _), b in zip(rows, raw))
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in placed) == expected
    loads = [0] * slots
    for r in placed:
        loads[r.virtual_slot] += r["size"]
    held, owner = [0] * 5, {}
    for slot in sorted(range(slots), key=lambda s: (-loads[s], s)):
        shard = min(range(5), key=lambda s: (held[s], s))
        owner[slot], held[shard] = shard, held[shard] + loads[slot]
    assert all(r.shard == owner[r.virtual_slot] for r in placed)
    for shard in range(5):
        assert sorted(r.slot for r in placed if r.shard == shard) == list(range(sum(r.shard == shard for r in placed)))
    assert max(held) - min(held) <= max(loads)
    same = {(r.doc_id, r.text_crc32): r.virtual_slot for r in placed}
    assert all(same[r.doc_id, r.text_crc32] == r.virtual_slot for r in placed)
