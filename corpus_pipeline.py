"""The training-data pipeline: named stages over `documents`, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestream.llm import langid, packing, secret_scan, toxicity
from lakestream.llm.corpus import fold, read, ready
from lakestream.llm.near_dedup import deduplicated
from lakestream.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network, trained on this corpus, recognises."""
    network = langid.fit(docs, fold(F.col("doc_id"), 3) != 1)
    return langid.recognised(docs, network)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, as the labels of the corpus teach it."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return toxicity.accepted(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return deduplicated(docs)


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced and character counts brought up to date."""
    clean = secret_scan.redacted(docs, secret_scan.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens; a row per piece of a document, with its ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    total = packing.pieces(docs, path).count()  # tokenizing twice is less work than keeping all ids on disk
    with_ids = packing.pieces(docs, path, with_ids=True)
    return packing.pack(with_ids, run_pieces=10_000, total=total)  # a piece is up to 4 kilobytes here


STAGES: list[tuple[str, Stage]] = [
    ("language id", language_id),
    ("toxicity", toxicity_filter),
    ("near dedup", near_dedup),
    ("secrets", secret_removal),
    ("packing", packed),
]

#: No stage can be put in SQL: trained models, fingerprints and tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    ready(spark)
    docs = read(spark, sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir.rstrip("/")).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
