"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.session import scratch_path

# Words are runs of anything but these ASCII blanks (fixed by the operators' contracts).
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8_length(text: Column) -> Column:
    """UTF-8 bytes of a text, null counting as none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def hash60(*parts: Column) -> Column:
    """60 hash-random bits of the parts, equal in every engine that has MD5."""
    joined = F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x1e")) for p in parts])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 15), 16, 10).cast("long")
