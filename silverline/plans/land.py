"""Landing and raw export stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import explode_array, read_multiline_json
from ..sources.sinks import export_json_lines, write_create_only


def land_source(spark: SparkSession, source_paths: str | list[str], landing_path: str,
                array_col: str = "movie", alias: str = "movies", schema: str | None = None) -> DataFrame:
    """Multi-line JSON source documents -> landing table (one struct row per array
    element), written create-only. ``source_paths`` may be globs (``…/movie_*``)."""
    docs = read_multiline_json(spark, source_paths, schema=schema)
    write_create_only(explode_array(docs, array_col, alias), landing_path)
    return spark.read.parquet(landing_path)


def export_raw(spark: SparkSession, landing_path: str, raw_path: str, struct_col: str = "movies") -> str:
    """Landing table -> JSON lines (one object per record, NULL fields left out)."""
    return export_json_lines(spark.read.parquet(landing_path), raw_path, struct_col=struct_col)
