"""Ingest metadata: source label, ingest time, status, ingest date, record key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bronze status names and the default source label.
STATUS_NEW = "new"
STATUS_LOADED = "loaded"
STATUS_QUARANTINED = "quarantined"
DEFAULT_SOURCE = "json files"


def ingest_time(now: dt.datetime | str | None = None) -> Column:
    """``current_timestamp()`` (one value per query), or a fixed instant for repeatable runs."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, dt.datetime):
        now = now.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(now).cast("timestamp")


def record_key(value: Column | str = "value") -> Column:
    """SHA-256 of the raw line: a fixed-width stand-in for equality on the whole text.

    Joins, dedupes and merges shuffle 64 hex characters per row instead of the
    full document; equal keys mean equal lines up to SHA-256 collisions.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.sha2(value, 256)
