"""Writers: create-only, append, partitioned append, batch writer, JSON lines."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _partitioned(df: DataFrame, partition_by: str | list[str] | None, cluster: bool):
    """(frame, columns). With ``cluster``, rows are REBALANCEd on the partition
    columns first: each value is written by few tasks (few files), and adaptive
    execution splits a value holding many rows over several tasks."""
    if not partition_by:
        return df, []
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    return (df.hint("rebalance", *cols) if cluster else df), cols


def write_create_only(df: DataFrame, path: str, fmt: str = "parquet",
                      partition_by: str | list[str] | None = None, cluster: bool = True) -> str:
    """Write a new table; fails if ``path`` already exists."""
    df, cols = _partitioned(df, partition_by, cluster)
    w = df.write.format(fmt).mode("errorifexists")
    if cols:
        w = w.partitionBy(*cols)
    w.save(path)
    return path


def _check_schema(df: DataFrame, path: str, fmt: str, partition_by: list[str]) -> None:
    """Fail if the table at ``path`` has other columns or types than ``df``. No table yet is fine.

    Types of partition columns are guessed from folder names, so those are compared by name."""
    try:
        stored = df.sparkSession.read.format(fmt).load(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return
        raise
    have, new = ({f.name: "" if f.name in partition_by else f.dataType.simpleString() for f in s.fields} for s in (stored, df.schema))
    if have != new:
        differ = sorted(set(have.items()) ^ set(new.items()))
        raise ValueError(f"the table at {path} has another schema ({differ}); append with allow_schema_change=True to change it")


def write_batch(df: DataFrame, path: str, partition_by: str | list[str] | None = None,
                exclude: list[str] | tuple[str, ...] = (), mode: str = "append",
                fmt: str = "parquet", cluster: bool = True, allow_schema_change: bool = False) -> str:
    """Generic batch writer: drop ``exclude``, then write. Appends unless
    another mode (``overwrite``, ``errorifexists``) is asked for.

    An append must have the columns and types of the table; with
    ``allow_schema_change`` it may differ, and readers then merge schemas."""
    out, cols = _partitioned(df.drop(*exclude), partition_by, cluster)
    if mode == "append" and not allow_schema_change and fmt not in ("json", "text"):
        _check_schema(out, path, fmt, cols)
    w = out.write.format(fmt).mode(mode)
    if cols:
        w = w.partitionBy(*cols)
    w.save(path)
    return path


def append(df: DataFrame, path: str, partition_by: str | list[str] | None = None, fmt: str = "parquet",
           allow_schema_change: bool = False) -> str:
    return write_batch(df, path, partition_by=partition_by, mode="append", fmt=fmt, allow_schema_change=allow_schema_change)


def export_json_lines(df: DataFrame, path: str, struct_col: str | None = None, mode: str = "errorifexists") -> str:
    """One JSON object per line; NULL fields are left out. ``struct_col`` is star-expanded first."""
    out = df.select(f"{struct_col}.*") if struct_col else df
    out.write.mode(mode).json(path)
    return path


def to_json_lines(df: DataFrame) -> DataFrame:
    """The same lines as a ``value`` column (for a text or stream sink)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
