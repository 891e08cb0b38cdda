"""Corpus pipeline: stages over ``documents``, each written and read again.

Every stage works on all that the one before kept.  All stages but the last
return the columns of ``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.llm import common, language_id, line_dedup, ngram_join, packing, quality_rules


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base counts and the fertility bands learned from the labelled ones."""
    return quality_rules.keep_good(docs, labels=common.table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is like a language learned from the labelled ones."""
    return language_id.keep_known(docs, language_id.learn(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks that an earlier document holds; documents left blank go."""
    out = line_dedup.dedup(docs, counts=False, drop_emptied=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


#: Near copies share 80 % or more of their five-word shingles.
WIDTH, PERCENT = 5, 80


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the smallest id."""
    return ngram_join.keep_one(docs, percent=PERCENT, width=WIDTH)


#: Chunks whose tokens the packing stage remembers, next to what the stages before it left in memory.
STORE_CHUNKS = 400_000


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in packed sequences."""
    return packing.pack_documents(docs, store_chunks=STORE_CHUNKS)


STAGES = [("quality rules", quality), ("language ID", language), ("line dedup", lines),
          ("n-gram Jaccard join", near_copies), ("best-fit packing", sequences)]

#: No SQL: tokenisers and profiles are beyond it.  ``tests/llm`` holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), "pipeline-" + "-".join(name.lower().split()))
    return docs
