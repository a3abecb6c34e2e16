"""One document of each group of near duplicates: the groups of `jaccard`, found through the index of `simhash` first.

A document stays if its id is the least of its group (a null id is least, then the text's hash decides); of repeated
rows one stays. All columns are as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestream.llm import jaccard
from lakestream.llm.corpus import settled


def deduplicated(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents that stay. Only rows that may have to go are shuffled: those that share one of `jaccard.CELLS`
    cells with a row that goes, or with one that is repeated."""
    name = "_row" + "_" * max(len(c) for c in documents.columns)  # longer than any other, so clashing with none
    row = F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("hash"))
    named = documents.withColumn(name, row)
    found = settled(jaccard.groups(named, name, text_col, **settings))
    dropped = settled(found.filter(F.col("component_id") != F.col(name)).select(name).distinct())
    repeated = found.groupBy(name).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(name)
    cell = F.pmod(F.xxhash64(F.col(name)), F.lit(jaccard.CELLS))
    cells = settled(dropped.unionByName(repeated).select(cell.alias(f"{name}cell")).distinct())
    marked = named.withColumn(f"{name}cell", cell)
    clear = marked.join(F.broadcast(cells), f"{name}cell", "left_anti")
    rest = marked.join(F.broadcast(cells), f"{name}cell", "left_semi")
    # repeated rows meet in their own task before the shuffle, so that many of them are no hot key
    kept = rest.dropDuplicates([name]).join(dropped, name, "left_anti").select(clear.columns)
    return clear.unionByName(kept).drop(name, f"{name}cell")
