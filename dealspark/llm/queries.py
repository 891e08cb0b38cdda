"""Registered queries of this subpackage: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, bpe, language_id, line_dedup, ngram_join, packing, piece_bpe, prefix_trie, quality_rules,
               sharding, topk, url_filter, warc)
from .common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents"))
    both = bpe.decode(ids.withColumn("ids_sha256", F.sha2("ids", 256)))
    return both.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.Join(table(spark, sf_dir, "documents")).components()


def op3_block_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op6_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = piece_bpe.encode(table(spark, sf_dir, "documents"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    both = piece_bpe.decode(ids.withColumn("ids_sha256", F.sha2(listed, 256)))
    return both.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents")).withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_ngram_join": op2_ngram_join,
    "op3_block_top_k": op3_block_top_k,
    "op4_histogram_shards": op4_histogram_shards,
    "op5_url_rules": op5_url_rules,
    "op6_genetic_packing": op6_genetic_packing,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc_index": op8_warc_index,
    "op9_rank_order_language": op9_rank_order_language,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_piece_bpe": op12_piece_bpe,
    "op13_token_alignment": op13_token_alignment,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op3_block_top_k": topk.ORACLE,
    "op5_url_rules": url_filter.ORACLE,
    "op8_warc_index": warc.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
}
