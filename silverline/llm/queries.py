"""Queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from silverline.llm import (conversation_repair, decontaminate, fast_sketch, hamming, hard_negatives, host_reputation, line_dedup, mixing,
                            ngram_join, page_diff, quality_crf, sharding, warc)
from silverline.llm.common import table


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the pages of these tables name the document they carry by the number that ends their path
    document = host_reputation.document_of(host_reputation.path_of(F.col("url")))
    return host_reputation.judge_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), document)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


def op9_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.top_k(table(spark, sf_dir, "embeddings"))


def op10_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_fast_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fast_sketch.near_duplicates(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_warc_chunks, op2_decontaminate, op3_ring_sharding, op4_mix_sources, op5_line_dedup, op6_quality_crf,
    op7_host_reputation, op8_ngram_join, op9_hamming_top_k,
    op10_page_diff, op11_hard_negatives, op12_conversation_repair, op13_fast_sketch, pipeline)}

ORACLE = {
    "op1_warc_chunks": warc.WARC_SQL,
    "op4_mix_sources": mixing.MIX_SQL,
    "op5_line_dedup": line_dedup.LINES_SQL,
    "op7_host_reputation": host_reputation.JUDGE_SQL,
    "op9_hamming_top_k": hamming.SEARCH_SQL,
    "op11_hard_negatives": hard_negatives.NEGATIVES_SQL,
}
