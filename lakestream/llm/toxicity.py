"""Toxicity of whole texts by a weighted finite-state grammar over the words of a clause.

Lexical transducers turn words into symbols: insults with weights learned from labelled documents; threats,
targets, negations and signs of reported speech from short word lists. Three transducers rewrite a clause's
symbols and are composed into one machine: negation weakens the insults and threats that follow it closely,
reported speech those that come after it in the clause, and a target strengthens them (a threat counts only
with a target). The best path through the machine, by sums of weights, is the clause's score. A document's
score is logistic in what its matched clauses add up to and in the strongest of them; a word alone, apart from
its clause, has none.

Insults are learned as stems: beginnings of words, and whole words, that tell toxic documents from others
beyond chance. Learning uses at most `SAMPLE_TOXIC` toxic and `SAMPLE_CLEAN` other documents, drawn by hash,
with one document for each set of near copies; three quarters of them give the stems and the rest the logistic
weights. Null and empty texts match no clause and get the lowest score. Documents without a label are not
learned from, and with no label of either kind every score is 0. Repeated rows get equal scores; of several
labels of an id a toxic one counts; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestream.llm.bpe import Recent
from lakestream.llm.corpus import batches, only, ready, settled, where

SAMPLE_TOXIC, SAMPLE_CLEAN = 3000, 9000
SHORTEST_STEM, LONGEST_STEM = 4, 10
#: Documents that a stem must stand in, and the share of words remembered by a worker.
LEAST_DOCUMENTS = 3
REMEMBERED_WORDS = 250_000
#: Features counted in a task before they are handed on.
COUNTED_FEATURES = 300_000

WORDS = re.compile(r"[^\W\d_]+")
CLAUSES = re.compile(r"[.!?;:\n\r]+")
SHORT_NOT = re.compile(r"n['’]t\b")
QUOTES = re.compile(r"[\"“”„«»]")

# Word lists in English, German, French and Spanish.
THREATS = """
kill hurt destroy stab shoot strangle
töten umbringen erschießen verprügeln
tuer frapper étrangler
matar golpear disparar
"""
TARGETS = """
you your yours yourself he she they him them
dich dir euch ihr ihn
tu toi vous ils elles
tú usted ustedes ellos ellas
"""
NEGATIONS = """
not never no nobody
nicht kein keine niemals
pas jamais aucun
nunca jamás tampoco
"""
REPORTS = """
said says wrote quoted claimed alleged
sagte schrieb behauptete
dit écrit affirmé
dijo escribió afirmó
"""

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "O", "I", "T", "G", "N", "R"
THREAT_WEIGHT = 9.0
#: Words after a negation that it still reaches.
NEGATION_REACH = 3
#: What is left of a weight under negation and in reported speech, and what a target makes of it.
NEGATED, REPORTED, TARGETED = 0.2, 0.4, 1.25


# ---- transducers ----


@dataclass
class Transducer:
    """Arcs by state and symbol read: the symbol written, the factor on the symbol's weight, the next state."""

    start: object
    arcs: dict[tuple[object, str], list[tuple[str, float, object]]] = field(default_factory=dict)
    finals: set = field(default_factory=set)

    def add(self, state, read: str, write: str, factor: float, to) -> None:
        self.arcs.setdefault((state, read), []).append((write, factor, to))

    def compose(self, other: Transducer) -> Transducer:
        """The machine that hands what this one writes to the other; factors multiply."""
        out = Transducer((self.start, other.start))
        waiting, seen = [out.start], {out.start}
        symbols = {read for _, read in self.arcs}
        while waiting:
            state = waiting.pop()
            if state[0] in self.finals and state[1] in other.finals:
                out.finals.add(state)
            for read in symbols:
                for middle, one, to in self.arcs.get((state[0], read), ()):
                    for write, two, end in other.arcs.get((state[1], middle), ()):
                        out.add(state, read, write, one * two, (to, end))
                        if (to, end) not in seen:
                            seen.add((to, end))
                            waiting.append((to, end))
        return out

    def best(self, symbols: Iterable[tuple[str, float]]) -> float:
        """The largest sum of weighted symbols over all accepted paths; 0 if none is."""
        held = {self.start: 0.0}
        for symbol, weight in symbols:
            after: dict = {}
            for state, total in held.items():
                for _, factor, to in self.arcs.get((state, symbol), ()):
                    value = total + factor * weight
                    if value > after.get(to, -1.0):
                        after[to] = value
            held = after
        return max((v for s, v in held.items() if s in self.finals), default=0.0)


def negation() -> Transducer:
    machine = Transducer(0, finals=set(range(NEGATION_REACH + 1)))
    for left in range(NEGATION_REACH + 1):
        after = max(0, left - 1)
        for symbol in (OTHER, TARGET, REPORT):
            machine.add(left, symbol, symbol, 1.0, after)
        for symbol in (INSULT, THREAT):
            machine.add(left, symbol, symbol, NEGATED if left else 1.0, after)
        machine.add(left, NEGATION, OTHER, 1.0, NEGATION_REACH)
    return machine


def reported() -> Transducer:
    machine = Transducer(0, finals={0, 1})
    for state in (0, 1):
        for symbol in (OTHER, TARGET):
            machine.add(state, symbol, symbol, 1.0, state)
        for symbol in (INSULT, THREAT):
            machine.add(state, symbol, symbol, REPORTED if state else 1.0, state)
        machine.add(state, REPORT, OTHER, 1.0, 1)
    return machine


def targeted() -> Transducer:
    """Guesses at the start of a clause whether it has a target; the guess that it has is accepted only if so."""
    machine = Transducer("open", finals={"open", "none", "met"})
    for symbol, factor in ((OTHER, 0.0), (TARGET, 0.0), (INSULT, 1.0), (THREAT, 0.0)):
        machine.add("open", symbol, symbol, factor, "none")
        machine.add("none", symbol, symbol, factor, "none")
    for state in ("open", "unmet", "met"):
        to = "met" if state == "met" else "unmet"
        machine.add(state, OTHER, OTHER, 0.0, to)
        machine.add(state, TARGET, TARGET, 0.0, "met")
        machine.add(state, INSULT, INSULT, TARGETED, to)
        machine.add(state, THREAT, THREAT, 1.0, to)
    return machine


def grammar() -> Transducer:
    return negation().compose(reported()).compose(targeted())


# ---- lexicon ----


def features(word: str) -> list[str]:
    """The beginnings of a word that may be stems, and the word itself with its end marked."""
    return [word[:n] for n in range(SHORTEST_STEM, min(len(word), LONGEST_STEM) + 1)] + [word + "$"]


def word_set(text: str | None) -> set[str]:
    return {w for w in WORDS.findall((text or "").lower()) if len(w) >= SHORTEST_STEM}


def copy_mark(text: str | None) -> int:
    """Equal for most near copies: the least checksum over runs of five words."""
    words = (text or "").lower().encode().split()
    runs = zip(*(words[i:] for i in range(5))) if len(words) > 5 else [words]
    return min(zlib.crc32(b" ".join(r)) for r in runs)


@dataclass
class Model:
    stems: dict[str, float]
    bias: float
    weights: tuple[float, float]


class Scorer:
    """A model at work: symbols of words, clause scores, document scores."""

    def __init__(self, model: Model):
        self.model, self.grammar = model, grammar()
        self.lists = {}
        for symbol, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            self.lists |= dict.fromkeys(words.split(), symbol)
        self.weight = Recent(self._weight, REMEMBERED_WORDS)

    def _weight(self, word: str) -> float:
        if self.lists.get(word) == THREAT:
            return THREAT_WEIGHT
        stems = self.model.stems
        return max((stems[f] for f in features(word) if f in stems), default=0.0)

    def symbols(self, clause: str) -> list[tuple[str, float]]:
        out = []
        clause = QUOTES.sub(" said ", SHORT_NOT.sub(" not", clause))
        for word in WORDS.findall(clause):
            listed, weight = self.lists.get(word), self.weight[word]
            if listed:
                out.append((listed, weight))
            else:
                out.append((INSULT, weight) if weight else (OTHER, 0.0))
        return out

    def clauses(self, text: str | None) -> list[float]:
        """The scores of the clauses that the grammar matches."""
        low = (text or "").lower()
        if not any(map(self.weight.__getitem__, WORDS.findall(low))):
            return []
        found = []
        for clause in CLAUSES.split(low):
            symbols = self.symbols(clause)
            if any(s in (INSULT, THREAT) for s, _ in symbols):
                found.append(self.grammar.best(symbols))
        return [f for f in found if f > 0]

    def score(self, clauses: list[float]) -> float:
        z = self.model.bias + float(np.dot(self.model.weights, evidence(clauses)))
        return 1 / (1 + math.exp(-min(40.0, max(-40.0, z))))


def evidence(clauses: list[float]) -> tuple[float, float]:
    """What the matched clauses add up to, and the strongest, both in logarithms."""
    return math.log1p(sum(clauses)), math.log1p(max(clauses, default=0.0))


def chosen_stems(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Stems whose documents are toxic beyond chance, weighted by their smoothed log-odds.

    The likelihood ratio must exceed what the best of as many chance features would reach.
    """
    if not toxic:
        return {}
    names = list(toxic)
    t = np.array([toxic[f] for f in names], float)
    c = np.array([clean.get(f, 0) for f in names], float)
    share = n_toxic / (n_toxic + n_clean)
    own = t / (t + c)
    ratio = 2 * (t * np.log(own / share) + c * np.log(np.maximum(1 - own, 1e-12) / (1 - share)))
    odds = np.log((t + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_clean + 1))
    keep = (own > share) & (ratio > 2 * np.log(len(names))) & (odds > 1.5)
    return {names[i]: float(odds[i]) for i in np.flatnonzero(keep)}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights, the bias last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


# ---- Spark ----

_scorer: list[Scorer] = []


def scorer(model: Model) -> Scorer:
    if not _scorer or _scorer[0].model is not model:
        _scorer[:] = [Scorer(model)]
    return _scorer[0]


def counted(sample: DataFrame, keep: Callable[[str], bool] | None, least: int) -> Counter:
    """In how many of the documents each feature stands; only those kept, and in `least` at least."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["feature", "n"]
            )

        for batch in batches(table):
            for text in batch.column(0).to_pylist():
                found = {f for w in word_set(text) for f in features(w)}
                held.update(filter(keep, found) if keep else found)
                if len(held) > COUNTED_FEATURES:
                    yield out()
                    held.clear()
        yield out()

    sums = sample.mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    return Counter({r.feature: r.n for r in sums.filter(F.col("n") >= least).collect()})


def labelled_sample(
    documents: DataFrame, labels: DataFrame, eligible: Column, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """`text`, `toxic`, `part` (of 4) of the documents drawn, one for each set of near copies."""
    usable = F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
    known = only(labels, id_col, label_col).filter(eligible & usable)
    known = known.groupBy(id_col).agg((F.max(label_col) > 0).alias("toxic"))
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return documents.sparkSession.createDataFrame([], "text string, toxic boolean, part int")
    draw = F.pmod(F.xxhash64(id_col, F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    wanted = F.when(F.col("toxic"), SAMPLE_TOXIC / counts[True]).otherwise(SAMPLE_CLEAN / counts[False])
    drawn = known.filter(draw < wanted).toDF("key", "toxic")  # about SAMPLE_TOXIC + SAMPLE_CLEAN rows
    docs = only(documents, id_col, text_col).toDF("key", "text")

    def mark(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            marks = pa.array([copy_mark(t) for t in batch.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], ["text", "toxic", "mark"])

    joined = docs.join(F.broadcast(drawn), "key").select("text", "toxic")
    marked = joined.mapInArrow(mark, "text string, toxic boolean, mark long")
    one = marked.groupBy("mark", "toxic").agg(F.min("text").alias("text"))
    return settled(one.select("text", "toxic", F.pmod(F.xxhash64("mark"), F.lit(4)).cast("int").alias("part")))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    eligible: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model | None:
    """A model from labelled documents whose row in `labels` is eligible; None without both kinds."""
    spark = ready(documents.sparkSession)
    sample = labelled_sample(documents, labels, eligible, id_col, text_col, label_col)
    teach = sample.filter("part > 0")
    sizes = {r.toxic: r["count"] for r in teach.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    toxic = counted(teach.filter("toxic").select("text"), None, LEAST_DOCUMENTS)
    names = spark.sparkContext.broadcast(frozenset(toxic))  # features of at most SAMPLE_TOXIC documents
    clean = counted(teach.filter("not toxic").select("text"), lambda f: f in names.value, 1)
    model = Model(chosen_stems(toxic, clean, sizes[True], sizes[False]), 0.0, (0.0, 0.0))
    names.unpersist()
    sent = spark.sparkContext.broadcast(model)

    def weigh(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scorer(sent.value)
        for batch in batches(table):
            found = [evidence(own.clauses(t)) for t in batch.column(0).to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], ["total", "strongest", "toxic"])

    schema = "total double, strongest double, toxic boolean"
    rows = sample.filter("part = 0").select("text", "toxic").mapInArrow(weigh, schema).collect()
    rows = sorted((r.total, r.strongest, r.toxic) for r in rows)
    if len({r[2] for r in rows}) < 2:  # too few to calibrate: half the strongest stem decides
        return Model(model.stems, -2.0, (2.0, 0.0))
    one, two, bias = logistic(np.array([r[:2] for r in rows]), np.array([r[2] for r in rows], float))
    return Model(model.stems, float(bias), (float(one), float(two)))


def score(
    documents: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, `score`, `predicted` (1 from 0.5 on) and the number of matched `clauses`."""
    spark = ready(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()
    sent = spark.sparkContext.broadcast(model)  # the stems: bounded by the sample

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            scores, matched = [0.0] * batch.num_rows, [0] * batch.num_rows
            if sent.value is not None:
                own = scorer(sent.value)
                found = [own.clauses(t) for t in batch.column(1).to_pylist()]
                scores, matched = [own.score(f) for f in found], [len(f) for f in found]
            predicted = [int(s >= 0.5) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array(predicted, pa.int32()),
                    pa.array(matched, pa.int64()),
                ],
                ["id", "score", "predicted", "clauses"],
            )

    out = only(documents, id_col, text_col).mapInArrow(run, f"id {key}, score double, predicted int, clauses long")
    return out.withColumnRenamed("id", id_col)


def accepted(documents: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The documents that score below 0.5; without a model, all."""
    sent = ready(documents.sparkSession).sparkContext.broadcast(model)

    def keep(texts: list[str | None]) -> list[bool]:
        if sent.value is None:
            return [True] * len(texts)
        own = scorer(sent.value)
        return [own.score(own.clauses(t)) < 0.5 for t in texts]

    return where(documents, text_col, keep)
