"""One registered query per operator, with its SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.llm import ann, bpe, langid, manifest, packing, periodic, quality, secret_scan, sharding
from lakestream.llm import simhash, substrings, toxicity, warc
from lakestream.llm.corpus import fold, read, ready
from lakestream.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ready(spark), sf_dir.rstrip("/"))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    QUERIES[query.__name__] = run
    return query


@register
def op1_toxicity(spark, sf_dir):
    """The toxicity of every document; labels of fold 0 of 5 are held out from training."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    found = toxicity.score(docs, toxicity.fit(docs, labels, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "clauses")


@register
def op2_packing(spark, sf_dir):
    """Every document packed into sequences of 1024 tokens."""
    cut = packing.pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packing.pack(cut).select(columns)


@register
def op3_simhash(spark, sf_dir):
    """Every document with its fingerprint and its group of near duplicates."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@register
def op4_quality(spark, sf_dir):
    """Every document judged by the base rules and by cutoffs certified for its language and length."""
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register
def op5_sharding(spark, sf_dir):
    """Every document in one of 16 shards of nearly equal bytes."""
    placed = sharding.sharded(read(spark, sf_dir, "documents"), scratch_path(spark, "slot_map"))
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    columns = ["doc_id", "size", "text_crc32", law, "shard", "slot", grown, "virtual_slot", "map_version"]
    return placed.select(*columns)


@register
def op6_warc(spark, sf_dir):
    """Every page written to ZIP-packaged archives and read back."""
    pages = read(spark, sf_dir, "pages")
    archives = warc.write_archives(warc.records(pages), scratch_path(spark, "archives"))
    key = pages.schema["page_id"].dataType.simpleString()
    return warc.read_archives(archives).select(
        F.col("page").cast(key).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(key).alias("refers_to"),
    )


#: SHA-1 has 160 bits: 32 base-32 digits, each made of 5 of them.
ORACLES["op6_warc"] = """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages
), d AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, hex,
        list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
            (CAST('0x' || substr(hex, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31
        )::INTEGER, 1)), 'string_agg', '') AS payload_digest
    FROM p
), f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""


@register
def op7_ann(spark, sf_dir):
    """The ten nearest vectors of every hundredth, among all others."""
    found = ann.neighbours(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


@register
def op8_langid(spark, sf_dir):
    """The language of every document; those of fold 1 of 3 are held out from training."""
    docs = read(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    found = langid.identify(docs, langid.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register
def op9_bpe(spark, sf_dir):
    """Every document encoded, and decoded again."""
    return bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register
def op10_secrets(spark, sf_dir):
    """Every candidate in every document, with the forest's verdict."""
    docs = read(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fit(docs))


@register
def op11_substrings(spark, sf_dir):
    """Every document without the passages that a document with a smaller id has too."""
    found = substrings.without_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op11_substrings"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS spelled FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY spelled) AS least FROM windows) WHERE doc_id > least
), covered AS (
    SELECT DISTINCT doc_id, i + k AS i FROM later, (SELECT unnest(range(13)) AS k)
), words AS (
    SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@register
def op12_manifest(spark, sf_dir):
    """Every document's leaf, roots and proof; of a seventh, n_chars is tampered with before it is verified."""
    docs = read(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = {"n_chars": F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    found = manifest.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], tampered=tampered)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


#: DuckDB has no CRC32: eight shifts for each digit of the id.
SQL_CRC = """
crc_steps AS (
    SELECT doc_id, 4294967295::BIGINT AS crc, 0 AS step, doc_id::VARCHAR AS digits FROM documents
    UNION ALL
    SELECT doc_id, list_reduce([xor(crc, ascii(digits[step + 1])), 1, 2, 3, 4, 5, 6, 7, 8],
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), step + 1, digits
    FROM crc_steps WHERE step < len(digits)
), crc AS MATERIALIZED (
    SELECT doc_id, xor(crc, 4294967295) AS crc FROM crc_steps WHERE step = len(digits)
)"""

_FIELDS = " || ".join(
    f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "{n_chars}", "text")
)
ORACLES["op12_manifest"] = f"""
WITH RECURSIVE {SQL_CRC}, leaves AS MATERIALIZED (
    SELECT doc_id, coalesce('=' || lang, '-') AS tree, sha256({_FIELDS.format(n_chars='n_chars')}) AS leaf,
        sha256({_FIELDS.format(n_chars='(n_chars + (crc % 7 = 0)::BIGINT)')}) AS claimed,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
    FROM documents JOIN crc USING (doc_id)
), nodes AS (
    SELECT tree, 0 AS level, pos, n, leaf AS digest FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n
), subroots AS MATERIALIZED (
    SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper_nodes AS (
    SELECT 0 AS level, pos, n, digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 2, n
), steps AS MATERIALIZED (
    SELECT doc_id, d.level, (leaves.pos >> d.level) % 2 AS side, s.digest
    FROM leaves JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) d ON d.tree = leaves.tree
    LEFT JOIN nodes s ON s.tree = leaves.tree AND s.level = d.level AND s.pos = xor(leaves.pos >> d.level, 1)
), all_steps AS MATERIALIZED (
    SELECT * FROM steps
    UNION ALL
    SELECT doc_id, 1000 + u.level, (subroots.pos >> u.level) % 2, s.digest
    FROM leaves JOIN subroots USING (tree), (SELECT DISTINCT level FROM upper_nodes WHERE n > 1) u
    LEFT JOIN upper_nodes s ON s.level = u.level AND s.pos = xor(subroots.pos >> u.level, 1)
), ordered AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS k FROM all_steps
), fold AS (
    SELECT doc_id, 1 AS k, claimed AS digest FROM leaves
    UNION ALL
    SELECT f.doc_id, f.k + 1, sha256(CASE WHEN side = 1 THEN o.digest || f.digest ELSE f.digest || coalesce(o.digest, '') END)
    FROM fold f JOIN ordered o ON o.doc_id = f.doc_id AND o.k = f.k
), ends AS (
    SELECT doc_id, arg_max(digest, k) AS folded_root FROM fold GROUP BY doc_id
), proofs AS (
    SELECT doc_id, sha256(coalesce(string_agg(digest, '' ORDER BY k), '')) AS proof_sha256 FROM ordered GROUP BY doc_id
)
SELECT doc_id, leaf, subroots.digest AS subroot, top.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
    folded_root = top.digest AS verified
FROM leaves JOIN subroots USING (tree) JOIN ends USING (doc_id) LEFT JOIN proofs USING (doc_id), (SELECT digest FROM upper_nodes WHERE n = 1) top
"""


def planted_repetition(doc_id: int | None, n: int) -> np.ndarray | None:
    """For a tenth of the ids, where each word of a text comes from when its end repeats itself; a null id has none."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.append(np.arange(a), a + np.arange(n - a) % p)


@register
def op13_periodic(spark, sf_dir):
    """The periodic runs of every document, with repetitions planted in a tenth of them."""
    found = periodic.repetitions(read(spark, sf_dir, "documents"), planted=planted_repetition)
    runs, collapsed = (F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("runs", "collapsed"))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", runs, collapsed)


ORACLES["op13_periodic"] = rf"""
WITH RECURSIVE {SQL_CRC}, d AS (
    SELECT doc_id, crc AS h, crc // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, len(w) AS n
    FROM documents JOIN crc USING (doc_id)
), places AS (
    SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p, unnest(range(n)) AS i FROM d WHERE n > 0
), words AS MATERIALIZED (
    SELECT doc_id, n, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM places
), pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y
    ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretches AS (
    SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM (
        SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
    ) GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS MATERIALIZED (
    SELECT * FROM stretches r WHERE NOT EXISTS (
        SELECT 1 FROM stretches t WHERE t.doc_id = r.doc_id AND t.q < r.q AND r.q % t.q = 0 AND t.s <= r.s AND t.s + t.n >= r.s + r.n
    )
), found AS (
    SELECT doc_id, count(*) AS n_runs, arg_max(struct_pack(s := s, n := n, q := q), struct_pack(e := n / q, s := -s, q := -q)) AS best,
        string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS runs
    FROM runs GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words WHERE NOT EXISTS (
        SELECT 1 FROM runs r WHERE r.doc_id = words.doc_id AND i >= r.s + r.q AND i < r.s + r.n
    ) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.n AS BIGINT) AS length,
    CAST(best.q AS BIGINT) AS period, CAST(1000 * best.n // best.q AS BIGINT) AS exponent_milli,
    sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN found USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
