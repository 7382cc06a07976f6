"""Counts, completeness and schema contracts.

Counts are computed in one aggregation pass (partial aggregates per task,
one tiny final merge) instead of one job per number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, StructType

from ..contract import Contract
from ..functions.parsing import bad_nested, more_than_one_value, parse_json, to_date_safe, to_int_safe


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def count_non_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(*[F.count(F.col(c)).alias(f"n_{c}") for c in cols])


def completeness(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Total rows, rows with no NULL in ``cols`` and NULLs per column, in one pass."""
    cols = cols or df.columns
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(complete).alias("n_complete"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def stage_metrics(routed: DataFrame) -> DataFrame:
    """Rows, records with a line, clean and quarantined counts of a routed frame."""
    return routed.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.count("value").alias("n_values"),
                      F.count_if(F.col("route") == "clean").alias("n_clean"),
                      F.count_if(F.col("route") == "quarantined").alias("n_quarantined"),
                      F.count_if(F.col("route") == "new").alias("n_unrouted"))


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n_records"))


def reason_counts(routed: DataFrame) -> DataFrame:
    return (routed.select(F.explode("reasons").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_records")))


def _fields(schema: StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def schema_differences(actual: StructType, expected_ddl: str, ignore_nullable: bool = True,
                       check_order: bool = True) -> list[tuple[str, str | None, str | None, str]]:
    """(column, expected type, actual type, problem) for every mismatch."""
    expected = StructType.fromDDL(expected_ddl)
    exp, act = _fields(expected), _fields(actual)
    out: list[tuple[str, str | None, str | None, str]] = []
    for name, t in exp.items():
        if name not in act:
            out.append((name, t, None, "missing"))
        elif act[name] != t:
            out.append((name, t, act[name], "type"))
    for name, t in act.items():
        if name not in exp:
            out.append((name, None, t, "unexpected"))
    if not ignore_nullable:
        en = {f.name: f.nullable for f in expected.fields}
        for f in actual.fields:
            if f.name in en and en[f.name] != f.nullable:
                out.append((f.name, str(en[f.name]), str(f.nullable), "nullable"))
    if check_order and not out and list(exp) != list(act):
        out.append(("*", ",".join(exp), ",".join(act), "order"))
    return out


def conformance(lines: DataFrame, contract: Contract, value: str = "value") -> DataFrame:
    """For every column of the typed contract: lines, lines that have the field and
    lines whose value fits its type, from one pass over the lines.

    The key and the dates fit when they cast, nested text when it is an array of
    objects with ids; any other field is typed by the parse, so it fits when it is there.
    """
    parsed = lines.select(parse_json(value, contract.source_ddl).alias("s"))
    columns, sums = list(zip(contract.source_fields, StructType.fromDDL(contract.typed_ddl()).fields, strict=True)), []
    for i, (name, typed) in enumerate(columns):
        raw = F.col("s")[name]
        fits = raw.isNotNull()
        if name == contract.key_field:
            fits = to_int_safe(raw, contract.key_type).isNotNull()
        elif name in contract.date_fields:
            fits = to_date_safe(raw).isNotNull()
        elif name == contract.nested_field:
            fits = raw.isNotNull() & ~bad_nested(raw, contract.nested_ddl)
        sums += [F.count(raw).alias(f"present_{i}"), F.count_if(fits).alias(f"fits_{i}")]
    totals = parsed.agg(F.count(F.lit(1)).alias("n_rows"), *sums)
    rows = [F.struct(F.lit(t.name).alias("column"), F.lit(t.dataType.simpleString().upper()).alias("expected"), F.col("n_rows"),
                     F.col(f"present_{i}").alias("n_present"), F.col(f"fits_{i}").alias("n_conform")) for i, (_, t) in enumerate(columns)]
    return totals.select(F.inline(F.array(*rows)))


# Variant types that a declared type takes; a decimal is any of them, whatever its digits.
FITTING = {"double": ("DOUBLE", "DECIMAL", "BIGINT"), "bigint": ("BIGINT",), "int": ("BIGINT",), "string": ("STRING",), "boolean": ("BOOLEAN",)}


def _variant_type(declared: DataType) -> str:
    """A declared type as the variant functions write it: objects with their names in order, decimals without digits."""
    if isinstance(declared, StructType):
        return f"OBJECT<{', '.join(f'{f.name}: {_variant_type(f.dataType)}' for f in sorted(declared.fields, key=lambda f: f.name))}>"
    if isinstance(declared, ArrayType):
        return f"ARRAY<{_variant_type(declared.elementType)}>"
    return "DECIMAL" if isinstance(declared, DecimalType) else declared.simpleString().upper()


def contract_drift(lines: DataFrame, contract: Contract, value: str = "value") -> DataFrame:
    """What the lines hold against what the contract declares, read without a schema: column, expected, found, problem, n_lines.

    Every top-level field of every line counts under the type it has there:
    ``problem`` is ``none`` if the contract's type takes it, ``type`` if not and
    ``unexpected`` if the contract has no such field. Fields of the contract that
    lines lack are ``missing``, JSON nulls ``null``; lines that are no JSON
    object are ``malformed`` and lines with more after it ``trailing_data``, both
    as column ``*``. Nested text is held against the type its elements are parsed with.
    """
    document = F.try_parse_json(value)
    kind = F.when(F.coalesce(~F.schema_of_variant(document).startswith("OBJECT<"), F.lit(True)), "malformed") \
        .when(more_than_one_value(value), "trailing_data").otherwise("record")
    read = lines.select(document.alias("document"), kind.alias("kind"))
    present = read.where("kind = 'record'").lateralJoin(lines.sparkSession.tvf.variant_explode(F.col("document").outer())) \
        .select(F.col("key").alias("column"), F.schema_of_variant("value").alias("found"))
    present = present.withColumn("found", F.regexp_replace("found", r"DECIMAL\(\d+,\d+\)", "DECIMAL"))
    # a row for each field and type, and one for the records: small, whatever the lines
    counts = present.groupBy("column", "found").agg(F.count(F.lit(1)).alias("n_lines"))
    odd = read.groupBy("kind").agg(F.count(F.lit(1)).alias("n_lines"))
    nested, expected = StructType.fromDDL(f"x {contract.nested_ddl}")["x"].dataType, []
    for f in StructType.fromDDL(contract.source_ddl).fields:
        own = _variant_type(nested if f.name == contract.nested_field else f.dataType)
        fitting = [own, "ARRAY<VOID>"] if own.startswith("ARRAY<") else list(FITTING.get(f.dataType.simpleString(), (own,)))
        expected.append((f.name, own, fitting))
    wanted = lines.sparkSession.createDataFrame(expected, "column STRING, expected STRING, fitting ARRAY<STRING>")
    problem = F.when(F.col("expected").isNull(), "unexpected").when(F.col("found") == "VOID", "null") \
        .when(F.array_contains("fitting", F.col("found")), "none").otherwise("type")
    seen = counts.join(F.broadcast(wanted), "column", "left").select("column", "expected", "found", problem.alias("problem"), "n_lines")
    held = counts.groupBy("column").agg(F.sum("n_lines").alias("n_held"))
    missing = wanted.withColumn("kind", F.lit("record")).join(odd, "kind").join(held, "column", "left") \
        .select("column", "expected", F.lit(None).cast("string").alias("found"), F.lit("missing").alias("problem"),
                (F.col("n_lines") - F.coalesce("n_held", F.lit(0))).alias("n_lines")).where("n_lines > 0")
    others = odd.where("kind <> 'record'").select(F.lit("*").alias("column"), F.lit(None).cast("string").alias("expected"),
                                                  F.lit(None).cast("string").alias("found"), F.col("kind").alias("problem"), "n_lines")
    return seen.unionByName(missing).unionByName(others)


def schema_diff(spark: SparkSession, df: DataFrame, expected_ddl: str, **kw) -> DataFrame:
    """The schema differences as a small DataFrame (schemas are metadata, not data)."""
    rows = schema_differences(df.schema, expected_ddl, **kw)
    return spark.createDataFrame(rows, "column STRING, expected STRING, actual STRING, problem STRING")


def assert_schema(df: DataFrame, expected_ddl: str, **kw) -> None:
    diff = schema_differences(df.schema, expected_ddl, **kw)
    if diff:
        raise AssertionError(f"schema mismatch: {diff}")
