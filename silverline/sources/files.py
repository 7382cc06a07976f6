"""Readers: multi-line JSON documents, JSON/text lines, tables by path or name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_multiline_json(spark: SparkSession, paths: str | list[str], schema: str | None = None,
                        path_glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Multi-line JSON files (one document per file).

    ``paths`` may hold glob patterns (``landing/movie_*``) to pick source
    folders by name; ``path_glob`` filters file names. Without ``schema`` the
    schema is inferred, which costs a full extra pass over the files: give it
    for large inputs.
    """
    reader = spark.read.option("multiLine", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if schema:
        reader = reader.schema(schema)
    return reader.json(paths if isinstance(paths, list) else [paths])


def explode_array(df: DataFrame, array_col: str, alias: str) -> DataFrame:
    """One row per element of ``array_col`` (NULL or empty arrays give no row)."""
    return df.select(F.explode(array_col).alias(alias))


def read_text_lines(spark: SparkSession, path: str | list[str], drop_blank: bool = True,
                    with_file: bool = False) -> DataFrame:
    """Text files, one row per line, schema ``value STRING``.

    Blank lines are dropped (they are not records). ``with_file`` adds the
    source file path from the hidden ``_metadata`` column.
    """
    df = spark.read.schema("value STRING").text(path)
    if with_file:
        df = df.select("value", F.col("_metadata.file_path").alias("source_file"))
    if drop_blank:
        df = df.where(F.length(F.trim(F.col("value"))) > 0)
    return df


def read_table_path(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    return reader.load(path)


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
