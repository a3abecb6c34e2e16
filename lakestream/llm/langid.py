"""Language of whole texts by a bidirectional gated recurrent network over bytes.

A text's letter runs, lower-cased and in UTF-8, are read byte by byte from both ends by two gated recurrent
layers; at every position the network gives a probability for each language, and a document's probabilities
are their mean over all its positions. The network is trained in numpy by backpropagation through time on
words of labelled documents. Words recur, so a worker keeps the summed probabilities of recent words in one
table and runs the network over words it does not hold, many at a time.

Training sees at most `SAMPLE_DOCUMENTS` documents of each language and `SAMPLE_WORDS` words from anywhere in
each; the steps are as many at every input size. Documents without a language, or kept for testing, are not
learned from. Null texts and texts without a letter are `und` with score 0. With no labelled document at all
every text is `und`. Repeated rows get equal answers; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestream.llm.corpus import batches, only, ready, where

SAMPLE_DOCUMENTS = 600
SAMPLE_WORDS = 150
HIDDEN = 16
STEPS, WORDS_PER_STEP, RATE = 500, 512, 0.02
#: A letter run longer than this is read in parts.
LONGEST_RUN = 48
#: Words the network reads at once, and the words and bytes of a worker's table of words.
READ_AT_ONCE = 4096
TABLE_WORDS, TABLE_BYTES = 500_000, 32 << 20
#: A document is recognised if the mean probability of its language reaches this.
LEAST_SHARE = 0.35
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def letter_runs(text: str) -> list[bytes]:
    """The letter runs of a text in UTF-8, none longer than LONGEST_RUN bytes."""
    found = LETTERS.findall(text.lower())
    if not text.isascii():  # digits of other kinds, such as a raised two, are no letters by themselves
        found = [w for w in found if w.isalpha() or any(map(str.isalpha, w))]
    runs = [w.encode("utf-8", "replace") for w in found]
    if any(len(w) > LONGEST_RUN for w in runs):
        runs = [w[i : i + LONGEST_RUN] for w in runs for i in range(0, len(w), LONGEST_RUN)]
    return runs


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Words:
    """Words as a matrix of bytes, longest first, so that the words still being read are the first rows."""

    def __init__(self, words: list[bytes]):
        lengths = np.array([len(w) for w in words])
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        width = int(self.lengths[0]) if len(words) else 0
        flat = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in self.order), np.uint8)
        self.forward = flat.reshape(len(words), width)
        steps = np.arange(width)
        #: The step at which the layer that reads from the end has read a position.
        self.mirror = np.maximum(self.lengths[:, None] - 1 - steps, 0)
        self.backward = np.take_along_axis(self.forward, self.mirror, axis=1)
        self.active = (self.lengths[:, None] > steps).sum(axis=0)


class Layer:
    """A gated recurrent layer whose input weights are rows looked up by byte."""

    def __init__(self, inputs: np.ndarray, recurrent: np.ndarray):
        self.inputs, self.recurrent = inputs, recurrent

    def read(self, symbols: np.ndarray, active: np.ndarray, remember: bool = False):
        """Hidden states by word and step; with what the way back needs, if asked to remember."""
        size = self.recurrent.shape[0]
        hidden = np.zeros((len(symbols), size), np.float32)
        states, trace = np.zeros((len(symbols), len(active), size), np.float32), []
        for step, n in enumerate(active.tolist()):
            before = hidden[:n]
            given, back = self.inputs[symbols[:n, step]], before @ self.recurrent
            gates = sigmoid(given[:, : 2 * size] + back[:, : 2 * size])
            keep, reset = gates[:, :size], gates[:, size:]
            new = np.tanh(given[:, 2 * size :] + reset * back[:, 2 * size :])
            after = new + keep * (before - new)
            if remember:
                trace.append((before.copy(), keep, reset, new, back[:, 2 * size :]))
            hidden[:n] = after
            states[:n, step] = after
        return states, trace

    def back(self, symbols: np.ndarray, active: np.ndarray, trace: list, wanted: np.ndarray):
        """Gradients of the input rows and recurrent weights from those of the hidden states."""
        size = self.recurrent.shape[0]
        d_inputs, d_recurrent = np.zeros_like(self.inputs), np.zeros_like(self.recurrent)
        d_hidden = np.zeros((len(symbols), size), np.float32)
        for step in range(len(active) - 1, -1, -1):
            n = int(active[step])
            before, keep, reset, new, back = trace[step]
            d = d_hidden[:n] + wanted[:n, step]
            d_new = d * (1 - keep) * (1 - new * new)
            d_keep = d * (before - new) * keep * (1 - keep)
            d_reset = d_new * back * reset * (1 - reset)
            np.add.at(d_inputs, symbols[:n, step], np.concatenate([d_keep, d_reset, d_new], axis=1))
            through = np.concatenate([d_keep, d_reset, d_new * reset], axis=1)
            d_recurrent += before.T @ through
            d_hidden[:n] = d * keep + through @ self.recurrent.T
        return d_inputs, d_recurrent


@dataclass
class Network:
    languages: list[str]
    weights: list[np.ndarray]  # inputs and recurrent weights of both layers, output weights, output bias

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape):
            return rng.normal(0, shape[0] ** -0.5 if shape[0] < 256 else 0.3, shape).astype(np.float32)

        layers = [w for _ in range(2) for w in (normal(256, 3 * hidden), normal(hidden, 3 * hidden))]
        return cls(languages, [*layers, normal(2 * hidden, len(languages)), np.zeros(len(languages), np.float32)])

    def _positions(self, words: Words, remember: bool = False):
        one, two = Layer(*self.weights[0:2]), Layer(*self.weights[2:4])
        ahead, trace_one = one.read(words.forward, words.active, remember)
        behind, trace_two = two.read(words.backward, words.active, remember)
        behind = np.take_along_axis(behind, words.mirror[:, :, None], axis=1)
        states = np.concatenate([ahead, behind], axis=2)
        scores = states @ self.weights[4] + self.weights[5]
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return states, scores / scores.sum(axis=2, keepdims=True), (one, trace_one, two, trace_two)

    def sums(self, runs: list[bytes]) -> np.ndarray:
        """Of each word, the probabilities of every language summed over its positions."""
        out = np.zeros((len(runs), len(self.languages)), np.float32)
        by_length = sorted(range(len(runs)), key=lambda i: len(runs[i]))
        for at in range(0, len(runs), READ_AT_ONCE):
            chosen = by_length[at : at + READ_AT_ONCE]
            words = Words([runs[i] for i in chosen])
            _, shares, _ = self._positions(words)
            inside = np.arange(shares.shape[1]) < words.lengths[:, None]
            out[np.array(chosen)[words.order]] = (shares * inside[:, :, None]).sum(axis=1)
        return out

    def gradients(self, runs: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
        """Of the cross-entropy averaged over all positions, through time."""
        words = Words(runs)
        states, shares, (one, trace_one, two, trace_two) = self._positions(words, remember=True)
        inside = (np.arange(shares.shape[1]) < words.lengths[:, None])[:, :, None]
        error = shares.copy()
        error[np.arange(len(runs)), :, labels[words.order]] -= 1
        error *= inside / words.lengths.sum()
        d_states = error @ self.weights[4].T
        size = d_states.shape[2] // 2
        d_behind = np.take_along_axis(d_states[:, :, size:] * inside, words.mirror[:, :, None], axis=1) * inside
        d_one = one.back(words.forward, words.active, trace_one, d_states[:, :, :size])
        d_two = two.back(words.backward, words.active, trace_two, d_behind)
        d_out = np.tensordot(states, error, axes=([0, 1], [0, 1]))
        return [*d_one, *d_two, d_out, error.sum(axis=(0, 1))]

    def train(self, runs: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> Network:
        """Adam steps over random words, as many of each language."""
        rng = np.random.default_rng(seed)
        pools = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        pools = [p for p in pools if len(p)]
        each = max(1, WORDS_PER_STEP // max(1, len(pools)))
        first, second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        for step in range(1, steps + 1):
            chosen = np.concatenate([rng.choice(p, each) for p in pools])
            rate = RATE * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for i, d in enumerate(self.gradients([runs[j] for j in chosen], labels[chosen])):
                first[i] = 0.9 * first[i] + 0.1 * d
                second[i] = 0.99 * second[i] + 0.01 * d * d
                scale = np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8
                self.weights[i] = self.weights[i] - rate * (first[i] / (1 - 0.9**step)) / scale
        return self


class Reader:
    """A network with the sums of recent words, in a table of bounded size."""

    def __init__(self, network: Network):
        self.network = network
        self.width = len(network.languages)
        self.capacity = max(10_000, min(TABLE_WORDS, TABLE_BYTES // (4 * self.width)))
        self.place: dict[bytes, int] = {}
        self.table = np.zeros((self.capacity, self.width), np.float32)

    def shares(self, texts: list[str | None]) -> np.ndarray:
        """Mean probabilities of each text; zeros where it has no letter."""
        runs = [letter_runs(t) if t else [] for t in texts]
        flat = [w for r in runs for w in r]
        means = np.zeros((len(texts), self.width))
        if not flat:
            return means
        missing = list({w for w in flat if w not in self.place})
        if len(self.place) + len(missing) > self.capacity:
            self.place, missing = {}, list(set(flat))
        if len(missing) > self.capacity:  # more words than the table holds: by themselves, without it
            names = {w: i for i, w in enumerate(missing)}
            sums = self.network.sums(missing)[[names[w] for w in flat]]
        else:
            start = len(self.place)
            if missing:
                self.table[start : start + len(missing)] = self.network.sums(missing)
                self.place.update(zip(missing, range(start, start + len(missing))))
            sums = self.table[np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))]
        filled = np.array([bool(r) for r in runs])
        counts = np.array([len(r) for r in runs])[filled]
        starts = np.cumsum(counts) - counts
        total = np.add.reduceat(sums.astype(np.float64), starts, axis=0)
        means[filled] = total / total.sum(axis=1, keepdims=True)
        return means


#: The worker's reader of the network it used last.
_reader: list[Reader] = []


def reader(network: Network) -> Reader:
    if not _reader or _reader[0].network is not network:
        _reader[:] = [Reader(network)]
    return _reader[0]


def training_words(
    documents: DataFrame,
    eligible: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> list[tuple[str, list[bytes]]]:
    """A language and words of each sampled document, drawn by hash from those that are eligible."""
    labelled = only(documents, id_col, text_col, lang_col).filter(eligible & F.col(lang_col).isNotNull())
    labelled = labelled.filter(F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().collect()}
    if not counts:
        return []
    share = F.create_map(*(F.lit(x) for k, n in sorted(counts.items()) for x in (k, SAMPLE_DOCUMENTS / n)))
    draw = F.pmod(F.xxhash64(id_col, F.lit("language")), F.lit(1 << 30)) / float(1 << 30)

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            lang, words = batch.column(0).to_pylist(), []
            for text in batch.column(1).to_pylist():
                runs = letter_runs(text)
                if len(runs) > SAMPLE_WORDS:
                    runs = random.Random(len(text)).sample(runs, SAMPLE_WORDS)
                words.append(runs)
            columns = [pa.array(lang, pa.string()), pa.array(words, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "words"])

    chosen = labelled.filter(draw < share[F.col(lang_col)]).select(lang_col, text_col)
    rows = chosen.mapInArrow(run, "lang string, words array<binary>").collect()
    return sorted((r.lang, [bytes(w) for w in r.words]) for r in rows)


def fit(
    documents: DataFrame,
    eligible: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Network | None:
    """A network trained on a bounded sample; None if no eligible document has a language and a letter."""
    ready(documents.sparkSession)
    sample = [(k, w) for k, words in training_words(documents, eligible, id_col, text_col, lang_col) for w in words]
    if not sample:
        return None
    languages = sorted({k for k, _ in sample})
    number = {k: i for i, k in enumerate(languages)}
    return Network.fresh(languages).train([w for _, w in sample], np.array([number[k] for k, _ in sample]))


def identify(
    documents: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, `lang_pred` and `score`, the mean probability of that language."""
    spark = ready(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()
    sent = spark.sparkContext.broadcast(network)  # a few kilobytes for each language

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table, 2 << 20):
            texts = batch.column(1).to_pylist()
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if sent.value is not None:
                shares = reader(sent.value).shares(texts)
                best = shares.argmax(axis=1)
                scores = shares.max(axis=1)
                names = sent.value.languages
                langs = [names[b] if s > 0 else UNKNOWN for b, s in zip(best, scores)]
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "lang_pred", "score"])

    out = only(documents, id_col, text_col).mapInArrow(run, f"id {key}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def recognised(
    documents: DataFrame, network: Network | None, least: float = LEAST_SHARE, text_col: str = "text"
) -> DataFrame:
    """The documents whose language has a mean probability of at least `least`; without a network, all."""
    sent = ready(documents.sparkSession).sparkContext.broadcast(network)

    def keep(texts: list[str | None]) -> list[bool]:
        if sent.value is None:
            return [True] * len(texts)
        return (reader(sent.value).shares(texts).max(axis=1) >= least).tolist()

    return where(documents, text_col, keep)
