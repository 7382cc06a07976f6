"""Parse, type, check and route records; split and dedupe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.ingest import STATUS_QUARANTINED
from ..functions.parsing import (CORRUPT, PARSED, SINGLE, WRAPPED, is_single, parse_line, parse_wrapped, reasons_column, record_checks,
                                 rule_failures, typed_columns)
from ..functions.repair import apply_repairs
from .bronze import status_of

CLEAN = "clean"
QUARANTINED = "quarantined"
UNROUTED = "new"


def parse_records(df: DataFrame, contract: Contract, value: str = "value") -> DataFrame:
    """Star-expand ``from_json(value)`` and type it; every other input column is kept.

    Output: the input columns, ``source_id`` (the key as the source has it), the
    typed fields in source order, then ``_checks`` (record-level reasons:
    malformed, trailing data, missing/bad key, bad date, bad nested text).
    A line is parsed once, and the same pass says whether it is one JSON value:
    the parse sits in its own projection, which Catalyst does not inline into the
    several expressions that read it. Lines that are not, or do not fit the
    schema, are parsed again to name the reason.
    """
    keep = [F.col(c) for c in df.columns]
    wrapped = df.select(*keep, parse_wrapped(value, contract.source_ddl).alias(WRAPPED)) \
        .select("*", is_single(F.col(WRAPPED), value).alias(SINGLE))
    record = F.struct(F.col(SINGLE).alias(SINGLE), parse_line(F.col(WRAPPED), F.col(SINGLE), value, contract.source_ddl).alias(PARSED))
    # a generator of one row: filters on what was parsed stop here, where they would else repeat the parse in their conditions
    parsed = wrapped.select(*keep, F.explode(F.array(record)).alias("_read")).select(*keep, f"_read.{SINGLE}", f"_read.{PARSED}")
    fields = [F.col(f"{PARSED}.{name}").alias(name) for name in contract.source_fields]
    flat = parsed.select(*keep, *fields, reasons_column(record_checks(contract, value, single=SINGLE)).alias("_checks"))
    return flat.select(*keep, F.col(contract.key_field).alias("source_id"), *typed_columns(contract), "_checks")


def route(parsed: DataFrame, contract: Contract, null_policy: str = "quarantine") -> DataFrame:
    """Add ``reasons`` (array of failed checks and rules), ``route`` and ``fixable``
    (1 if no record-level check failed, so that a repair may help).

    ``null_policy="quarantine"``: a rule that is NULL fails, so the two routes
    are total and disjoint. ``"unrouted"`` leaves records whose only problem
    is a NULL rule result with route ``new``, as a plain pair of filters does.
    """
    rules = rule_failures(contract)
    reasons = F.concat(F.col("_checks"), reasons_column(rules))
    out = parsed.withColumn("reasons", reasons)
    if null_policy == "quarantine":
        r = F.when(F.size("reasons") == 0, F.lit(CLEAN)).otherwise(F.lit(QUARANTINED))
    elif null_policy == "unrouted":
        any_false = F.lit(False)
        for rule in contract.rules:
            any_false = any_false | F.coalesce(~F.expr(rule.predicate), F.lit(False))
        r = (F.when(F.size("reasons") == 0, F.lit(CLEAN))
             .when((F.size("_checks") > 0) | any_false, F.lit(QUARANTINED))
             .otherwise(F.lit(UNROUTED)))
    else:
        raise ValueError(f"unknown null_policy {null_policy!r}")
    # Repairs change typed columns, so only failed rules can come right.
    return out.withColumn("route", r).withColumn("fixable", (F.size("_checks") == 0).cast("int")).drop("_checks")


def parse_and_route(df: DataFrame, contract: Contract, null_policy: str = "quarantine") -> DataFrame:
    return route(parse_records(df, contract), contract, null_policy)


def repair(parsed: DataFrame, contract: Contract) -> DataFrame:
    """Apply the contract's repair expressions to typed records (before routing)."""
    return parsed.withColumns(apply_repairs(contract.repairs))


def with_status(routed: DataFrame, final: bool) -> DataFrame:
    """Routed bronze rows with the status their route implies; after a repair
    (``final``) a row that still fails is not fixable any more."""
    rows = status_of(routed)
    kept = (F.col("status") != STATUS_QUARANTINED) | (F.col("fixable") == 1)
    return rows.withColumn("fixable", (kept & ~(F.lit(final) & (F.col("status") == STATUS_QUARANTINED))).cast("int"))


def split(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) views of one routed frame."""
    return (routed.where(F.col("route") == CLEAN), routed.where(F.col("route") == QUARANTINED))


def dedupe_records(df: DataFrame, key: str | None = None) -> DataFrame:
    """One row per record. The key defaults to ``record_key`` (SHA-256 of the line)
    when present, else ``value``; every other column is a function of it.
    Partial aggregation before the shuffle folds repeats of a hot line map-side."""
    if key is None:
        key = "record_key" if "record_key" in df.columns else "value"
    return df.dropDuplicates([key])


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=subset)


def drop_columns(df: DataFrame, exclude: list[str] | tuple[str, ...]) -> DataFrame:
    return df.drop(*exclude)


__all__ = ["CLEAN", "QUARANTINED", "UNROUTED", "CORRUPT", "parse_records", "route",
           "parse_and_route", "repair", "with_status", "split", "dedupe_records", "drop_null_rows", "drop_columns"]
