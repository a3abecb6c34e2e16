"""Groups by exact similarity against brute force."""

from __future__ import annotations

import random

import numpy as np

from lakestream.llm import jaccard, near_dedup, simhash


def slow_set(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} or {" ".join(words)}


def slow_similarity(a, b):
    return len(a & b) / len(a | b)


def slow_components(texts, least=0.8):
    sets, root = [slow_set(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            if slow_similarity(sets[i], sets[j]) >= least:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def near_texts(n, seed):
    """Texts in families: members differ from their predecessor in a few words, at either side of the limit."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    texts = []
    while len(texts) < n:
        text = rng.choices(words, k=rng.randint(60, 200))
        for _ in range(rng.randint(1, 6)):
            texts.append(" ".join(text))
            for at in rng.sample(range(len(text)), rng.randint(1, max(1, len(text) // 30))):
                text[at] = rng.choice(words)
    return texts[:n]


def test_stage_keeps_one_of_each_similar_group(spark):
    """Near copies with far fingerprints, families that share a long passage, equal fingerprints of other texts."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = near_texts(200, 3) + [f"{passage} {t}" for t in near_texts(60, 5)]
    texts += [" ".join("a " * 40 + f"{x}{i}" for i in range(20)) for x in "xyz"]
    expected = slow_components(texts)
    prints = [simhash.fingerprint(t.encode()) for t in texts]
    far = [(i, j) for i, j in zip(expected, range(260)) if (prints[i] ^ prints[j]).bit_count() > 3]
    assert len(far) > 20  # their own fingerprints leave these apart
    assert len(set(prints[260:])) == 1 and expected[260:] == [260, 261, 262]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in near_dedup.deduplicated(table).collect()) == sorted(set(expected))


def test_keys_find_nearly_all_similar_sets():
    rng = np.random.default_rng(4)
    hit = 0
    for _ in range(400):
        hashes = rng.integers(0, 2**64, 180, dtype=np.uint64)
        a, b = np.sort(hashes[:162]), np.sort(np.concatenate([hashes[:144], hashes[162:]]))
        assert jaccard.similarity(a, b) == 0.8
        hit += bool(set(jaccard.band_keys(a).tolist()) & set(jaccard.band_keys(b).tolist()))
    assert hit >= 396


def random_sets(seed, n):
    """Sets around a few centres, from nearly equal to far apart."""
    rng = np.random.default_rng(seed)
    centres = [rng.choice(4000, rng.integers(30, 80), replace=False) for _ in range(4)]
    out = []
    for _ in range(n):
        own = centres[rng.integers(4)].copy()
        change = rng.integers(0, len(own) // 4 + 1)
        own[rng.choice(len(own), change, replace=False)] = 10_000 + rng.integers(0, 400, change)
        out.append(np.unique(own).astype(np.uint64))
    return out


def slow_roots(sets, least=0.8):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= least:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def test_sets_that_meet_are_joined():
    """The edges are links, join what a search of all pairs joins, and are as many as it takes."""
    for seed in range(12):
        sets = random_sets(seed, 60)
        truth = slow_roots(sets)
        for given in (list(range(60)), [t if i % 3 else i for i, t in enumerate(truth)]):
            edges = list(jaccard.joining(sets, given, 0.8))
            assert all(jaccard.similarity(sets[i], sets[j]) >= 0.8 for i, j in edges)
            names = dict(zip(given, given))
            for i, j in edges:
                a, b = names[given[i]], names[given[j]]
                assert a != b
                names = {k: min(a, b) if v in (a, b) else v for k, v in names.items()}
            got = [names[g] for g in given]
            assert len(set(zip(got, truth))) == len(set(got)) == len(set(truth))


def shared_passage_texts(n, seed=11):
    """Texts that share a passage, which is a third to a half of each, and nothing else."""
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    return [" ".join(f"u{rng.randrange(10**9)}" for _ in range(rng.randint(60, 120))) + " " + passage for _ in range(n)]


def near_group(n, seed=13):
    """Texts near one text, mostly below the limit to each other."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    out = []
    for _ in range(n):
        text = list(base)
        for at in rng.sample(range(150), rng.randint(1, 6)):
            text[at] = f"c{rng.randrange(10**9)}"
        out.append(" ".join(text))
    return out


def compared(spark, texts, monkeypatch, **settings):
    """How many comparisons the groups of some texts take, and the groups."""
    pairs = []
    verified, opened = jaccard.verified, jaccard.open_groups

    def counted(proposed, held, least):
        pairs.append(proposed.count())
        return verified(proposed, held, least)

    def met(members, nodes, most, *rounds):
        found = opened(members, nodes, most, *rounds)
        if not rounds:
            pairs.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "verified", counted)
    monkeypatch.setattr(jaccard, "open_groups", met)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.component_id for r in jaccard.groups(table, "doc_id", "text", **settings).collect()}
    monkeypatch.undo()
    return sum(pairs), [rows[i] for i in range(len(texts))]


def test_a_common_passage_costs_no_pairs(spark, monkeypatch):
    """Twice the texts take about twice the rows compared, not four times, and stay apart."""
    few, apart = compared(spark, shared_passage_texts(600), monkeypatch)
    many, _ = compared(spark, shared_passage_texts(1200), monkeypatch)
    assert apart == list(range(600))
    assert many < 2.6 * few + 200 and many < 20_000


def test_large_keys_are_cut_and_dealt_again(spark, monkeypatch):
    """With room for few shingles in a task, the groups are those of the exact search too."""
    texts = near_group(160) + shared_passage_texts(60) + near_texts(60, 8)
    truth = slow_components(texts)
    for most in (1_000_000, 8000, 1200):
        _, got = compared(spark, texts, monkeypatch, most=most)
        assert got == truth


def pair_in_one_large_key(seed=5, fillers=40):
    """Two similar texts that share one key only, far apart by fingerprint, among others that share just that key."""
    rng = random.Random(seed)

    def word():
        return f"v{rng.randrange(10**9)}"

    while True:
        a = [word() for _ in range(100)]
        b = list(a)
        for at in (20, 70):
            b[at] = word()
        sets = [jaccard.shingles(" ".join(t).encode()) for t in (a, b)]
        keys = [set(jaccard.band_keys(s).tolist()) for s in sets]
        apart = (jaccard.bits_of(sets[0]) ^ jaccard.bits_of(sets[1])) & (2**64 - 1)
        if len(keys[0] & keys[1]) == 1 and jaccard.similarity(*sets) >= 0.8 and apart.bit_count() > 3:
            break
    key = (keys[0] & keys[1]).pop()
    band = jaccard.band_keys(sets[0]).tolist().index(key)
    rows = slice(band * jaccard.ROWS, (band + 1) * jaccard.ROWS)
    low = (sets[0] >> np.uint64(32)).astype(np.uint32)
    least = set(sets[0][((low ^ jaccard.FLIPPED[rows]) * jaccard.FACTORS[rows]).argmin(axis=1)].tolist())
    spans = [a[i : i + 5] for i in range(96) if jaccard.shingles(" ".join(a[i : i + 5]).encode())[0] in least]
    texts = [" ".join(a), " ".join(b)]
    while len(texts) < 2 + fillers:
        rng.shuffle(spans)
        text = " ".join([w for s in spans for w in s] + [word() for _ in range(10)])
        if key in jaccard.band_keys(jaccard.shingles(text.encode())).tolist():
            texts.append(text)
    return texts


def test_similar_sets_that_share_only_a_large_key_are_linked(spark, monkeypatch):
    """No key but one brings the two together, and that one has too many shingles and probes for a task."""
    texts = pair_in_one_large_key()
    truth = slow_components(texts)
    assert truth[:2] == [0, 0] and len(set(truth)) > 30
    for most in (300,):
        assert compared(spark, texts, monkeypatch, most=most)[1] == truth


def test_links_by_rare_shingles_are_those_of_all_pairs(spark, monkeypatch):
    """In pairs and in groups, whole, cut and crossed: sets around a few centres, at either side of the limit."""
    texts = near_group(60) + near_texts(80, 21) + shared_passage_texts(30)
    sets = [jaccard.shingles(t.encode()) for t in texts]
    names = [jaccard.name_of(s) for s in sets]
    table = spark.createDataFrame([(n, t.encode()) for n, t in dict(zip(names, texts)).items()], "node long, text binary")
    held = jaccard.settled(jaccard.squeezed(table))
    rows = [(n, len(s), n) for n, s in dict(zip(names, sets)).items()]
    rest = jaccard.settled(spark.createDataFrame(rows, "node long, size long, root long"))
    truth = slow_components(texts)
    for paired, most in ((64, 1_000_000), (3, 1_000_000), (1, 4000), (1, 600)):
        monkeypatch.setattr(jaccard, "PAIRED", paired)
        roots = {n: n for n in names}
        for edge in jaccard.rare_links(rest, held, 0.8, most).collect():
            x, y = roots[edge.a], roots[edge.b]
            roots = {n: min(x, y) if r in (x, y) else r for n, r in roots.items()}
        got = [roots[n] for n in names]
        assert len(set(zip(got, truth))) == len(set(got)) == len(set(truth))


def test_fingerprint_of_a_set():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 40_000):
        hashes = rng.integers(0, 2**64, n, dtype=np.uint64)
        counts = [int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]
        assert jaccard.bits_of(hashes) % 2**64 == sum(1 << b for b in range(64) if 2 * counts[b] > n)


def test_rows_that_go_and_stay(spark, odd, empty):
    """Of odd rows: one of each text's shingle set by exact comparison, repeated rows once."""
    docs = odd.collect()
    sets = [jaccard.shingles((d.text or "").encode()) for d in docs]
    names = {}
    for d, s in zip(docs, sets):
        names.setdefault(s.tobytes(), []).append((d.doc_id is not None, d.doc_id or 0, d.text))
    roots = {}
    for a in names:
        for b in names:
            alike = jaccard.similarity(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")) >= 0.8
            roots.setdefault(a, set()).update([b] if alike else [])
    kept = near_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len({frozenset(r) for r in roots.values()}) == 5
    assert len(rows) == len(set(rows)) and near_dedup.deduplicated(empty).count() == 0
