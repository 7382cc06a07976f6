"""Bronze operators: ingest metadata, status filters and the status merge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ingest import (DEFAULT_SOURCE, STATUS_LOADED, STATUS_NEW, STATUS_QUARANTINED,
                                ingest_time, record_key)

# The bronze column contract (one for every path that writes bronze), then the key.
BRONZE_COLUMNS = ["datasource", "ingesttime", "value", "status", "p_ingestdate"]
BRONZE_DDL = ("datasource STRING, ingesttime TIMESTAMP, value STRING, status STRING, "
              "p_ingestdate DATE, record_key STRING")


def to_bronze(raw: DataFrame, source: str = DEFAULT_SOURCE,
              now: dt.datetime | str | None = None, with_key: bool = True,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw lines -> bronze rows with status ``new``.

    ``now`` fixes the ingest time for repeatable runs; otherwise it is
    ``current_timestamp()``, which is one value for the whole query.
    ``keep`` names extra input columns carried after the bronze columns.
    """
    t = ingest_time(now)
    cols = [F.lit(source).alias("datasource"), t.alias("ingesttime"), F.col("value"),
            F.lit(STATUS_NEW).alias("status"), t.cast("date").alias("p_ingestdate")]
    if with_key:
        cols.append(record_key("value").alias("record_key"))
    return raw.select(*cols, *keep)


def read_status(bronze: DataFrame, status: str, since: dt.date | str | None = None) -> DataFrame:
    """Rows of one status; ``since`` adds a filter on the ingest-date partition column."""
    out = bronze.where(F.col("status") == F.lit(status))
    if since is not None:
        out = out.where(F.col("p_ingestdate") >= F.lit(str(since)).cast("date"))
    return out


def read_new(bronze: DataFrame, since=None) -> DataFrame:
    return read_status(bronze, STATUS_NEW, since)


def read_quarantined(bronze: DataFrame, since=None) -> DataFrame:
    return read_status(bronze, STATUS_QUARANTINED, since)


def _with_key(df: DataFrame, on: str) -> DataFrame:
    if on == "record_key" and "record_key" not in df.columns:
        return df.withColumn("record_key", record_key("value"))
    return df


# Statuses as numbers, so that the merge below aggregates with a hash table.
STATUSES = (STATUS_NEW, STATUS_QUARANTINED, STATUS_LOADED)


def keyed_updates(updates: DataFrame, status: str | None = None, on: str = "record_key") -> DataFrame:
    """One row for each key of the updates, with ``_new_status``; two different statuses for one key, or one that is
    not a bronze status, fail the job. NULL keys are left out. Aggregates map-side before the shuffle."""
    updates = _with_key(updates, on).where(F.col(on).isNotNull())
    if status is not None:
        return updates.select(on).distinct().withColumn("_new_status", F.lit(status))
    names = F.array(*[F.lit(s) for s in STATUSES])
    code = F.array_position(names, F.col("status")).cast("int")
    return (updates.select(on, F.coalesce(code, F.lit(0)).alias("_code")).groupBy(on)
            .agg(F.min("_code").alias("_lo"), F.max("_code").alias("_hi"))
            .select(on, F.when((F.col("_lo") == F.col("_hi")) & (F.col("_lo") > 0), F.try_element_at(names, F.col("_lo")))
                    .otherwise(F.raise_error(F.concat(F.lit("conflicting statuses for key "), F.col(on))))
                    .alias("_new_status")))


def apply_status(bronze: DataFrame, updates: DataFrame, status: str | None = None,
                 on: str = "record_key") -> DataFrame:
    """Matched-row update: bronze rows whose key equals an update's get its status.

    Unmatched rows keep their status, no row is added or removed, NULL keys
    never match and every duplicate of a matched key is updated. ``updates``
    needs ``value`` (or the key) and, unless ``status`` is given, a ``status``
    column. It is reduced to one row per key before the join (``keyed_updates``).
    """
    per_key = keyed_updates(updates, status, on)
    bronze = _with_key(bronze, on)
    joined = bronze.join(per_key, on=on, how="left")
    return joined.select(*[F.coalesce(F.col("_new_status"), F.col("status")).alias("status")
                           if c == "status" else F.col(c) for c in bronze.columns])


def status_of(routed: DataFrame) -> DataFrame:
    """A routed frame with the status each row's own route implies: no join needed."""
    return routed.withColumn("status", F.when(F.col("route") == "clean", F.lit(STATUS_LOADED))
                             .when(F.col("route") == "quarantined", F.lit(STATUS_QUARANTINED))
                             .otherwise(F.col("status")))


def status_from_route(routed: DataFrame) -> DataFrame:
    """Bronze rows of a routed frame with the status their own route implies."""
    return status_of(routed).select(*[c for c in BRONZE_COLUMNS + ["record_key"] if c in routed.columns])
