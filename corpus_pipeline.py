"""The corpus pipeline: documents to a deduplicated, clean, mixed and sharded corpus.

Every stage is written as Parquet and read back by the next one, so a failure
costs one stage at most. Each stage works on all that the one before kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm import decontaminate, mixing, ngram_join, quality_crf, sharding
from silverline.llm.common import cut, table

# Near copies are documents that share 80 % or more of their five-word shingles.
SHINGLE_WORDS, SIMILARITY = 5, (80, 100)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, learnt from those of its input that have labels."""
    model = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_crf.score_documents(docs, model)
    return scored.filter(F.col("_score") >= quality_crf.THRESHOLD).drop("_score")


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least doc_id, of each group of near copies."""
    return ngram_join.one_of_each(docs, SHINGLE_WORDS, *SIMILARITY)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item within its edit budget."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them."""
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place within it of every row the mix has."""
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_copies),
    ("benchmark decontamination", keep_unleaked),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

# The classifier's training, the edit distances and crc32 are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for position, (_, stage) in enumerate(STAGES):
        docs = cut(stage(spark, docs, sf_dir), f"stage-{position}")
    return docs
