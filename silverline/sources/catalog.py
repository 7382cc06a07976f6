"""Catalog: databases and external tables over written folders."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _check(name: str) -> str:
    for part in name.split("."):
        if not _NAME.match(part):
            raise ValueError(f"bad identifier {name!r}")
    return name


def ensure_database(spark: SparkSession, name: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_check(name)}")
    return name


def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                      partitioned: bool = False) -> DataFrame:
    """(Re-)register ``name`` as an external table at ``path``.

    A partitioned folder reads as empty until its partitions are recovered,
    so that is done on every registration.
    """
    _check(name)
    if "'" in path:
        raise ValueError("path must not contain quotes")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    if partitioned:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def ensure_table(spark: SparkSession, name: str, path: str, ddl: str, partition_by: list[str],
                 buckets: tuple[list[str], int] | None = None) -> str:
    """A Parquet table of the catalog at ``path``, partitioned and, if ``buckets`` names columns and a number, bucketed and sorted.

    A catalog that does not know the table yet, as that of a new session, finds
    the partitions that are there.
    """
    _check(name)
    if "'" in path:
        raise ValueError("path must not contain quotes")
    if not spark.catalog.tableExists(name):
        clustered = f"CLUSTERED BY ({', '.join(buckets[0])}) SORTED BY ({', '.join(buckets[0])}) INTO {buckets[1]} BUCKETS" if buckets else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY ({', '.join(partition_by)}) {clustered} "
                  f"LOCATION '{path}'")
        if _exists(spark, path):
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("value STRING").text(path)          # looks the path up, reads nothing
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
