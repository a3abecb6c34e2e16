"""Secrets in whole texts: wide patterns find candidates, a random forest removes false positives.

The forest sees a candidate's length, how likely its character transitions are in prose and how it changes
between classes of characters, how much of it dictionary words cover, whether it looks like a path, and the
words beside it. It is trained in numpy on labelled findings: a table of texts with a span and a verdict, or,
where there is none, findings written from the shapes of public key formats, of passwords in addresses and of key
blocks, and of their look-alikes (commit ids, checksums, identifiers, paths, placeholders), among words of the corpus.

Transitions between letters and digits and the dictionary are counted over all documents. A task adds up its own
before anything is shuffled; a word is in the dictionary if at least two documents hold it, and at least a
`DICTIONARY`-th of all pairs of a document and a word in it, so the dictionary has at most `DICTIONARY` words.

Candidates have no greatest length and are judged whole. Patterns scan a text once: a key block ends at the end line
of its label before the next begin line, or, if it is cut off, with the last line of its body.

Null and empty texts have no findings. Spans count code points of the text. Of overlapping candidates those judged
secrets go first, then the one that starts first, then the longer, so one that is refused hides no secret in it.
Repeated rows give their findings once each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm.corpus import batches, only, ready, settled

#: Words of the dictionary at most; and their lengths, as longer ones are not looked for.
DICTIONARY, WORD_SIZES = 500_000, range(3, 13)
#: Words that a task adds up before it hands them on.
COUNTED_WORDS = 200_000
FINDINGS = 6000
TREES, DEPTH, LEAST_LEAF = 40, 10, 3
#: Characters on either side of a candidate whose words count as neighbours.
BESIDE = 48

# Names that announce a secret, and words that speak against one.
ANNOUNCING = "key token secret password passwd pwd auth credential bearer apikey private access client"
DENYING = """
sha sha1 sha256 md5 commit checksum digest hash uuid guid revision blob
example sample test dummy placeholder id ref etag build version file path url
"""
PLACEHOLDERS = """
changeme password example secret placeholder your_token_here
xxxxxxxxxxxxxxxx none null todo insert-key-here <token> ${TOKEN}
"""
USERS = "user username admin root postgres app service deploy"
NAMES_OF_SECRETS = """
token api_key secret SECRET_KEY access_token auth_token client_secret password db_password apiKey
"""

ASSIGNED = re.compile(
    r"(?:key|token|secret|passwor?d|pwd|auth|credential)[\w.-]{0,20}[\"']?"
    r"\s{0,3}(?:=>|:=|[=:])\s{0,3}[\"']?([^\s\"',;]{6,}+)",
    re.IGNORECASE,
)
LONG = re.compile(r"[A-Za-z0-9+/_\-]{16,}+={0,2}")
LOGIN = re.compile(r"://[^\s:/@]++:([^\s/@]{3,}+)@")
BLOCK_LINE = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]++)-----")
#: What may follow the begin line of a block that has no end.
BODY = re.compile(r"(?:\s++[A-Za-z0-9+/=]{16,}+(?!\S))*+")
DIGIT, NEIGHBOUR = re.compile(r"\d"), re.compile(r"[A-Za-z][A-Za-z0-9]*")
WORD = re.compile(rb"[a-z][a-z0-9]*+")


@dataclass(frozen=True)
class Candidate:
    detector: str
    start: int
    end: int


def key_blocks(text: str) -> Iterator[Candidate]:
    """From each begin line of a private key to the end line of its label, if that is the next such line; else to the
    end of its body."""
    lines = list(BLOCK_LINE.finditer(text))
    for line, after in zip(lines, [*lines[1:], None]):
        if line[1] != "BEGIN" or "PRIVATE KEY" not in line[2]:
            continue
        whole = after is not None and after[1] == "END" and after[2] == line[2]
        yield Candidate("private key", line.start(), after.end() if whole else BODY.match(text, line.end()).end())


def candidates(text: str) -> list[Candidate]:
    """Everything that might be a secret, in order; candidates may overlap, equal spans are one."""
    found = [Candidate("assignment", *m.span(1)) for m in ASSIGNED.finditer(text)]
    found += [Candidate("token", *m.span()) for m in LONG.finditer(text) if DIGIT.search(m[0])]
    if "://" in text:
        found += [Candidate("login", *m.span(1)) for m in LOGIN.finditer(text)]
    if "-----BEGIN" in text:
        found += key_blocks(text)
    first = {}
    for c in sorted(found, key=lambda c: (c.start, -c.end, c.detector)):
        first.setdefault((c.start, c.end), c)
    return list(first.values())


def kept(found: Sequence[Candidate], secret: Sequence[bool]) -> list[int]:
    """Places of candidates that do not overlap: secrets first, then the others beside them, each from the left, of
    two that start together the longer."""
    taken: list[tuple[int, int]] = []
    out = []
    for wanted in (True, False):
        held, at, end = sorted(taken), 0, -1
        for i, c in enumerate(found):
            if bool(secret[i]) != wanted or c.start < end:
                continue
            while at < len(held) and held[at][1] <= c.start:
                at += 1
            if at < len(held) and held[at][0] < c.end:
                continue
            out.append(i)
            taken.append((c.start, c.end))
            end = c.end
    return sorted(out)


#: Characters of transitions: 26 letters, 10 digits, and anything else.
SYMBOL = np.full(256, 36, np.intp)
SYMBOL[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8)] = np.arange(36)
#: Digits, lower case, upper case, anything else.
KIND = np.full(128, 3, np.int8)
KIND[48:58], KIND[97:123], KIND[65:91] = 0, 1, 2


def symbols(value: str) -> np.ndarray:
    return SYMBOL[np.frombuffer(value.lower().encode("latin-1", "replace"), np.uint8)]


def character_classes(value: str) -> np.ndarray:
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = KIND[np.minimum(codes, 127)]
    for i in np.flatnonzero(codes > 126).tolist():
        kinds[i] = 0 if value[i].isdigit() else 1 if value[i].islower() else 2 if value[i].isupper() else 3
    return kinds


def word_transitions(text: bytes) -> np.ndarray:
    """How often each symbol follows each other one inside the words of a text, which are stretches of ASCII letters
    and digits from their first letter on."""
    low = SYMBOL[np.frombuffer(text.lower(), np.uint8)]
    place = np.arange(len(low))
    border = np.maximum.accumulate(np.where(low == 36, place, -1))
    letter = np.maximum.accumulate(np.where(low < 26, place, -1))
    inside = (low[1:] < 36) & (letter[:-1] > border[:-1])
    return np.bincount(low[:-1][inside] * 36 + low[1:][inside], minlength=36 * 36)


class Prose:
    """Transitions between characters, and the words, of ordinary text."""

    def __init__(self, transitions: np.ndarray, words: Mapping[str, int]):
        counts = np.zeros((37, 37))
        counts[:36, :36] = np.asarray(transitions, float).reshape(36, 36)
        self.bits = -np.log2((counts + 0.1) / (counts.sum(axis=1, keepdims=True) + 4))
        self.words = frozenset(words)

    @classmethod
    def of(cls, words: Sequence[str]) -> Prose:
        """Of a list of words, repeats included."""
        common = Counter(w.lower() for w in words)
        found = {w: n for w, n in common.items() if n >= 2 and len(w) in WORD_SIZES}
        return cls(word_transitions(" ".join(words).encode()), found)

    def surprise(self, value: str) -> float:
        """Mean bits per transition."""
        codes = symbols(value)
        return float(self.bits[codes[:-1], codes[1:]].mean()) if len(codes) > 1 else 0.0

    def covered(self, value: str) -> float:
        """Share of the characters that the longest dictionary words cover, from left to right."""
        low, at, hit = value.lower(), 0, 0
        while at < len(low):
            size = next((n for n in range(min(12, len(low) - at), 2, -1) if low[at : at + n] in self.words), 0)
            hit += size
            at += size or 1
        return hit / max(1, len(low))


NAMES = (
    "length digits lower upper other changes distinct surprise covered slashes dots underscores hex extension "
    "announced denied repeated quoted assigned private_key login"
).split()


def described(text: str, c: Candidate, prose: Prose) -> list[float]:
    """What the forest sees of a candidate."""
    value = text[c.start : c.end]
    kinds = character_classes(value)
    n = len(value)
    before, after = text[max(0, c.start - BESIDE) : c.start], text[c.end : c.end + BESIDE]
    near = [w.lower() for w in NEIGHBOUR.findall(before)[-4:]]
    beside = near + [w.lower() for w in NEIGHBOUR.findall(after)[:2]]
    counts = Counter(value)
    return [
        math.log2(n + 1),
        *(float((kinds == k).mean()) for k in range(4)),
        float((kinds[1:] != kinds[:-1]).sum()) / max(1, n - 1),
        len(counts) / n,
        prose.surprise(value),
        prose.covered(value),
        value.count("/") / n,
        value.count(".") / n,
        (value.count("_") + value.count("-")) / n,
        float(all(ch in string.hexdigits for ch in counts)),
        float(bool(re.search(r"\.[a-z]{1,4}$", value[-6:]))),
        float(any(a in w for w in near[-2:] for a in ANNOUNCING.split())),
        float(any(w in DENYING.split() for w in beside)),
        max(counts.values()) / n,
        float(before[-1:] in "\"'" and bool(before)),
        float(bool(re.search(r"[=:]\s*[\"']?$", before))),
        float(c.detector == "private key"),
        float(c.detector == "login"),
    ]


# ---- forest ----


@dataclass
class Forest:
    """Trees as arrays: the feature of each node (-1 for a leaf), its threshold, its children and its share."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, threshold, left, share in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                inner = feature[node] >= 0
                right = x[np.arange(len(x)), np.maximum(feature[node], 0)] > threshold[node]
                node = np.where(inner, left[node] + right, node)
            total += share[node]
        return total / len(self.trees)


def best_split(x: np.ndarray, y: np.ndarray, features: np.ndarray) -> tuple[float, int, float]:
    """Gain in Gini impurity, feature and threshold of the best cut."""
    n, ones, best = len(y), y.sum(), (0.0, -1, 0.0)
    whole = 2 * ones / n * (1 - ones / n)
    for f in features.tolist():
        order = np.argsort(x[:, f], kind="stable")
        values, hits = x[order, f], np.cumsum(y[order])[:-1]
        size = np.arange(1, n)
        cut = (values[1:] > values[:-1]) & (size >= LEAST_LEAF) & (n - size >= LEAST_LEAF)
        if not cut.any():
            continue
        p, q = hits / size, (ones - hits) / (n - size)
        gain = whole - (size * 2 * p * (1 - p) + (n - size) * 2 * q * (1 - q)) / n
        gain[~cut] = -1
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (float(gain[at]), f, float((values[at] + values[at + 1]) / 2))
    return best


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator):
    feature, threshold, left, share = [], [], [], []

    def node(rows: np.ndarray) -> int:
        feature.append(-1)
        threshold.append(0.0)
        left.append(0)
        share.append(float(y[rows].mean()) if len(rows) else 0.0)
        return len(feature) - 1

    per_split = max(1, round(math.sqrt(x.shape[1])))
    every = np.arange(len(y))
    waiting = [(node(every), every, 0)]
    while waiting:
        at, rows, depth = waiting.pop()
        if depth >= DEPTH - 1 or len(rows) < 2 * LEAST_LEAF or share[at] in (0.0, 1.0):
            continue
        tried = rng.choice(x.shape[1], per_split, replace=False)
        gain, f, cut = best_split(x[rows], y[rows], tried)
        if f < 0:
            continue
        right = x[rows, f] > cut
        feature[at], threshold[at] = f, cut
        low, high = rows[~right], rows[right]
        left[at] = node(low)
        node(high)
        waiting += [(left[at], low, depth + 1), (left[at] + 1, high, depth + 1)]
    return np.array(feature), np.array(threshold), np.array(left), np.array(share)


def train_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, seed: int = 3) -> Forest:
    """Each tree is grown on rows drawn with replacement, each cut on features drawn anew."""
    rng = np.random.default_rng(seed)
    grown = []
    for _ in range(trees):
        rows = rng.integers(len(y), size=len(y))
        grown.append(grow(x[rows], y[rows].astype(float), rng))
    return Forest(grown)


# ---- labelled findings ----


def written_findings(words: Sequence[str], n: int = FINDINGS, seed: int = 1) -> list[tuple[str, int, int, int]]:
    """Texts with a span and whether it is a secret, half of them secrets."""
    rng = random.Random(seed)
    words = list(words) or ["plain", "words"]
    alphabet = string.ascii_letters + string.digits
    lower_hex = "0123456789abcdef"

    def some(chars: str, low: int, high: int | None = None) -> str:
        return "".join(rng.choices(chars, k=rng.randint(low, high or low)))

    def prose(k: int) -> str:
        return " ".join(rng.choices(words, k=k))

    def name() -> str:
        return rng.choice(NAMES_OF_SECRETS.split())

    def block(body: str) -> str:
        label = rng.choice(["", "RSA ", "EC ", "OPENSSH ", "ENCRYPTED "]) + "PRIVATE KEY"
        return f"-----BEGIN {label}-----\n{body}\n-----END {label}-----"

    def key_lines(low: int, high: int) -> str:
        lines = [some(alphabet + "+/", 64) for _ in range(rng.randint(low, high))]
        return "\n".join([*lines, some(alphabet + "+/", 4, 60) + "=="])

    def address(password: str) -> tuple[str, str]:
        scheme = rng.choice(["https", "postgres", "mysql", "amqp", "redis", "ftp"])
        return f" {scheme}://{rng.choice([*USERS.split(), rng.choice(words)])}:", password

    def secret() -> tuple[str, str]:
        which = rng.random()
        if which < 0.1:
            return rng.choice(["\n", " "]), block(key_lines(0, 40))
        if which < 0.2:
            return address(some(alphabet + rng.choice(["", "!#%*_-+="]), 8, 24))
        value = rng.choice(
            [
                lambda: some(lower_hex, 16, 32),
                lambda: some(lower_hex, 40),
                lambda: some(lower_hex, 64),
                lambda: some(alphabet, 20, 44),
                lambda: some(alphabet + "+/", 40),
                lambda: "AKIA" + some(string.ascii_uppercase + string.digits, 16),
                lambda: "ghp_" + some(alphabet, 36),
                lambda: "sk_live_" + some(alphabet, 24),
                lambda: "xoxb-" + some(string.digits, 11) + "-" + some(alphabet, 24),
                lambda: "eyJ" + some(alphabet, 30, 60),
                lambda: some(alphabet + "!#%*_-", 10, 18),
            ]
        )()
        kind = rng.random()
        if value.startswith(("AKIA", "ghp_", "sk_live_", "xoxb-")) and kind < 0.4:
            return " ", value
        if kind < 0.9:
            return f' {name()}{rng.choice([" = ", "=", ": ", " := "])}{rng.choice(["", chr(34), chr(39)])}', value
        return " Authorization: Bearer token ", value

    def other() -> tuple[str, str]:
        which = rng.random()
        if which < 0.08:
            named = rng.choice(["...", "<your key here>", "MII...", "REDACTED", "xxxxxxxxxxxxxxxx", prose(rng.randint(2, 12))])
            return rng.choice(["\n", " "]), block(named)
        if which < 0.18:
            return address(rng.choice([*PLACEHOLDERS.split(), "pass", "PASSWORD", "*****", "xxxx", rng.choice(words)]))
        path = "/".join(rng.choices(words, k=rng.randint(2, 5))) + f"/{some(string.digits, 1, 6)}"
        joint = "_".join(rng.choices(words, k=rng.randint(2, 4))) + some(string.digits, 1, 3)
        digits = string.digits
        uuid = "-".join(some(lower_hex, k) for k in (8, 4, 4, 4, 12))
        return rng.choice(
            [
                lambda: (rng.choice([" commit ", " sha1: ", " revision ", " blob ", " "]), some(lower_hex, 40)),
                lambda: (rng.choice([" sha256: ", " checksum ", " digest=", " "]), some(lower_hex, 64)),
                lambda: (rng.choice([" md5 ", " etag: ", " hash = "]), some(lower_hex, 32)),
                lambda: (rng.choice([" uuid ", " id=", " ref: ", " "]), uuid),
                lambda: (rng.choice([" file ", " path: ", " "]), path),
                lambda: (" ", joint),
                lambda: (" ", some(string.digits, 16, 24)),
                lambda: (" ", f"20{some(digits, 2)}-0{some('123456789', 1)}-1{some(digits, 1)}T{some(digits, 6)}"),
                lambda: (f" {name()} = ", rng.choice(PLACEHOLDERS.split())),
                lambda: (f" {name()}: ", rng.choice(words) + rng.choice(["", "", ".", ")"])),
                lambda: (" ", rng.choice(words) + "-" * rng.randint(12, 20) + some(string.digits, 1, 2)),
                lambda: (f" {name()} = ", rng.choice("x*.0-") * rng.randint(8, 24)),
            ]
        )()

    out = []
    for i in range(n):
        lead, value = secret() if i % 2 else other()
        before = prose(rng.randint(0, 8)) + lead
        quote = before[-1] if before[-1:] in "\"'" else ""
        after = "@" + rng.choice(words) + "/" + rng.choice(words) if "://" in lead else quote
        text = before + value + after + " " + prose(rng.randint(0, 6))
        out.append((text, len(before), len(before) + len(value), i % 2))
    return out


@dataclass
class Model:
    forest: Forest
    prose: Prose

    def scores(self, found: Sequence[tuple[str, Candidate]]) -> np.ndarray:
        if not found:
            return np.zeros(0)
        return self.forest.scores(np.array([described(t, c, self.prose) for t, c in found]))


def matching(text: str, start: int, end: int) -> Candidate:
    """The candidate that is a labelled span, else the shortest that covers its start, else the span itself."""
    covering = [c for c in candidates(text) if c.start <= start < c.end]
    exact = [c for c in covering if (c.start, c.end) == (start, end)]
    return min(exact or covering, key=lambda c: c.end - c.start, default=Candidate("token", start, end))


def train(findings: Sequence[tuple[str, int, int, int]], prose: Prose) -> Model:
    """A model from labelled findings (text, start, end, 1 for a secret) and the prose of a corpus."""
    x = np.array([described(t, matching(t, a, b), prose) for t, a, b, _ in findings])
    return Model(train_forest(x, np.array([f[3] for f in findings])), prose)


# ---- Spark ----


def counted_prose(documents: DataFrame, text_col: str = "text", dictionary: int = DICTIONARY) -> tuple[Prose, dict[str, int]]:
    """Transitions and dictionary of all documents, and the number of documents for each word of the dictionary."""
    ready(documents.sparkSession)

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(words: list[str], counts: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

        pairs, words = np.zeros(36 * 36, np.int64), Counter()
        for batch in batches(table):
            for text in batch.column(0).to_pylist():
                low = text.lower()
                pairs += word_transitions(low)
                words.update({w for w in set(WORD.findall(low)) if len(w) in WORD_SIZES})
                if len(words) >= COUNTED_WORDS:
                    yield out([w.decode() for w in words], list(words.values()))
                    words = Counter()
        yield out([w.decode() for w in words], list(words.values()))
        used = np.flatnonzero(pairs)
        yield out([f" {i}" for i in used.tolist()], pairs[used].tolist())

    texts = only(documents, text_col).toDF("text").filter("text is not null").select(F.col("text").cast("binary"))
    counted = settled(texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    is_word = ~F.col("word").startswith(" ")
    total = counted.filter(is_word).agg(F.sum("n")).first()[0] or 0
    # words that each have a `dictionary`-th of the total: no more than `dictionary` of them
    common = counted.filter(~is_word | ((F.col("n") >= 2) & (F.col("n") * dictionary >= total)))
    transitions, words = np.zeros(36 * 36, np.int64), {}
    for row in common.collect():
        if row.word.startswith(" "):
            transitions[int(row.word)] = row.n
        else:
            words[row.word] = row.n
    return Prose(transitions, words), dict(sorted(words.items()))


def written_words(words: Mapping[str, int], n: int = 20_000, seed: int = 2) -> list[str]:
    """Words for written findings, drawn as often as documents hold them."""
    return random.Random(seed).choices(list(words), list(words.values()), k=n) if words else []


def fit(
    documents: DataFrame, findings: Sequence[tuple[str, int, int, int]] | None = None, text_col: str = "text"
) -> Model:
    """A model for a corpus, from given labelled findings or from written ones."""
    prose, words = counted_prose(documents, text_col)
    return train(findings if findings is not None else written_findings(written_words(words)), prose)


def judged(model: Model, texts: Sequence[str | None], threshold: float) -> Iterator[tuple[int, Candidate, float]]:
    """Of each text the candidates that do not overlap, with their scores."""
    found = [(i, c) for i, text in enumerate(texts) if text for c in candidates(text)]
    scores = model.scores([(texts[i], c) for i, c in found])
    for i, group in itertools.groupby(range(len(found)), key=lambda k: found[k][0]):
        own = list(group)
        for k in kept([found[j][1] for j in own], [scores[j] >= threshold for j in own]):
            yield i, found[own[k]][1], float(scores[own[k]])


def scan(
    documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """One row per candidate: id, `detector`, `start`, `end`, `value_sha256`, `score`, `is_secret`."""
    spark = ready(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()
    sent = spark.sparkContext.broadcast(model)
    names = ["id", "detector", "start", "end", "value_sha256", "score", "is_secret"]

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            texts = batch.column(1).to_pylist()
            found = list(judged(sent.value, texts, threshold))
            rows, scores = [i for i, _, _ in found], np.array([score for _, _, score in found])
            values = [texts[i][c.start : c.end].encode("utf-8", "replace") for i, c, _ in found]
            hashes = [hashlib.sha256(v).hexdigest() for v in values]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array([c.detector for _, c, _ in found], pa.string()),
                    pa.array([c.start for _, c, _ in found], pa.int64()),
                    pa.array([c.end for _, c, _ in found], pa.int64()),
                    pa.array(hashes, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(scores >= threshold, pa.bool_()),
                ],
                names,
            )

    out = only(documents, id_col, text_col).mapInArrow(
        run, f"id {key}, detector string, start long, `end` long, value_sha256 string, score double, is_secret boolean"
    )
    return out.withColumnRenamed("id", id_col)


def redacted(
    documents: DataFrame, model: Model, text_col: str = "text", mark: str = "[SECRET]", threshold: float = 0.5
) -> DataFrame:
    """The documents with `mark` in place of every secret; all other columns and rows as they are."""
    spark = ready(documents.sparkSession)
    sent = spark.sparkContext.broadcast(model)
    at = documents.columns.index(text_col)

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            texts = batch.column(at).to_pylist()
            for i, c, score in reversed(list(judged(sent.value, texts, threshold))):  # from the end, so that spans hold
                if score >= threshold:
                    texts[i] = texts[i][: c.start] + mark + texts[i][c.end :]
            columns = [*batch.columns]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return documents.mapInArrow(run, documents.schema)
