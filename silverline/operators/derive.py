"""Silver tables derived from typed records: wide, movie, genre, language, bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.parsing import parse_nested


def silver_wide(clean: DataFrame, contract: Contract, keep_key: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns in contract order without ``value``; ``record_key`` last when kept
    (it lets a later status write-back or re-run find the bronze line), then the columns in ``keep``."""
    if contract.partition_expr:
        clean = clean.withColumn(contract.partition_column, F.expr(contract.partition_expr))
    cols = contract.silver_fields() + (["record_key"] if keep_key and "record_key" in clean.columns else [])
    return clean.select(*cols, *keep)


def silver_movie(wide: DataFrame, contract: Contract) -> DataFrame:
    """The wide table without the nested JSON text."""
    return wide.drop(contract.nested_field)


def exploded_genres(parsed: DataFrame, contract: Contract, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (record, nested element): source id, typed key, ``genres_id``, ``name`` and the columns in ``keep``.

    NULL or empty arrays give no row; elements with a NULL id or name are
    dropped, as ``na.drop`` does on the source rows. Records whose id does not
    type keep their rows under ``source_id``, with a NULL key; a record without
    any id gives none.
    """
    key = contract.key_column
    g = (parsed.where(F.col("source_id").isNotNull())
         .select("source_id", key, *keep, F.explode(parse_nested(contract.nested_field, contract.nested_ddl)).alias("g"))
         .select("source_id", key, F.col("g.id").alias("genres_id"), F.col("g.name").alias("name"), *keep))
    return g.na.drop(how="any", subset=["genres_id", "name"])


def genre_rows(parsed: DataFrame, contract: Contract) -> DataFrame:
    """Distinct (source id, key, genres_id, name): the genre table without the whole source struct."""
    return exploded_genres(parsed, contract).dropDuplicates()


def genre_dimension(genres: DataFrame) -> DataFrame:
    """Distinct (genres_id, name): a true dimension."""
    return genres.select("genres_id", "name").dropDuplicates()


def language_rows(parsed: DataFrame, contract: Contract) -> DataFrame:
    """Distinct (source id, key, Title, OriginalLanguage) of all records, with or without a typed key."""
    return parsed.select("source_id", contract.key_column, *contract.language_fields).dropDuplicates()


def bridge_rows(parsed: DataFrame, contract: Contract) -> DataFrame:
    """Distinct (key, genres_id) pairs of records with a key, read straight from the nested array: no join."""
    pairs = exploded_genres(parsed, contract).select(contract.key_column, "genres_id")
    return pairs.where(F.col(contract.key_column).isNotNull()).dropDuplicates()


def bridge_join(movies: DataFrame, genres: DataFrame, contract: Contract, dedupe: bool = False) -> DataFrame:
    """Inner equi-join movie ⨝ genre rows on the key, projected to the key pair.

    Neither side is broadcast by hint: adaptive execution switches to a
    broadcast only when the measured size of a side is under its threshold.
    """
    key = contract.key_column
    pairs = movies.select(key).join(genres.select(key, "genres_id"), on=key, how="inner")
    return pairs.dropDuplicates([key, "genres_id"]) if dedupe else pairs


def order_by_key(df: DataFrame, contract: Contract) -> DataFrame:
    """Total sort on the key (range-partitioned sort, no single-task collect).

    ``record_key`` (when present) breaks ties, so the range partitioner can
    split a key shared by many rows over several tasks; the order by key is
    the same.
    """
    tiebreak = ["record_key"] if "record_key" in df.columns else []
    return df.orderBy(contract.key_column, *tiebreak)
