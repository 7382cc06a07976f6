"""Status merge by copy-on-write: only the buckets that an update touches are read and rewritten.

A bronze table kept this way is partitioned by ``bucket``, a hash of the record
key. An update knows the buckets of its keys, so all others keep their files.
Touched buckets are replaced by dynamic partition overwrite: new files are
written aside and moved in when the job is done, and the same update again has
the same outcome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bronze import BRONZE_DDL, apply_status, keyed_updates

BUCKET = "bucket"
CODEC = "zstd"          # a merge writes whole lines again


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def write_buckets(bronze: DataFrame, path: str, buckets: int) -> str:
    """Write a bronze frame (with ``record_key``) as a new bucketed table; a bucket is written by few tasks."""
    bronze.withColumn(BUCKET, bucket_of("record_key", buckets)).hint("rebalance", BUCKET).write.mode("errorifexists").option("compression", CODEC) \
        .partitionBy(BUCKET).parquet(path)
    return path


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{BRONZE_DDL}, {BUCKET} INT").parquet(path)


def merge_status(spark: SparkSession, path: str, updates: DataFrame, buckets: int, status: str | None = None) -> list[int]:
    """``apply_status`` on a bucketed table, in place; the buckets that were rewritten.

    Matched rows get the update's status; unmatched rows keep theirs, no row is
    added or removed, a NULL key matches nothing and two different statuses for
    one key fail the job before anything is replaced. A bucket is rewritten if
    one of its rows changes; ``buckets`` is the number the table was written with.
    """
    changes = keyed_updates(updates, status).withColumn(BUCKET, bucket_of("record_key", buckets))
    held = read_buckets(spark, path)
    asked = [r[0] for r in changes.select(BUCKET).distinct().collect()]              # one number for each bucket at most
    slim = held.where(F.col(BUCKET).isin(asked)).select("record_key", "status", BUCKET)
    differ = slim.join(changes.drop(BUCKET), "record_key").where(~F.col("status").eqNullSafe(F.col("_new_status")))
    touched = sorted(r[0] for r in differ.select(BUCKET).distinct().collect())
    if touched:
        rows = held.where(F.col(BUCKET).isin(touched))
        merged = apply_status(rows, updates, status)
        merged.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC) \
            .partitionBy(BUCKET).parquet(path)
    return touched
