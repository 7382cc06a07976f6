"""Column expressions that turn a raw JSON line into typed, checked columns.

Everything here is a built-in Spark expression, so it stays inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..contract import Contract

CORRUPT = "_corrupt_record"
PARSED = "_parsed"
WRAPPED = "_wrapped"
SINGLE = "_single"
RECORD, END = "_record", "_end_of_record"     # fields of the wrapping object; no line should hold the second name

# Fixed names of the record-level quarantine reasons, in the order they are listed.
MALFORMED = "malformed"
TRAILING_DATA = "trailing_data"
MISSING_KEY = "missing_key"
BAD_KEY = "bad_key"
BAD_DATE = "bad_date"
BAD_NESTED = "bad_nested"


def parse_json(value: Column | str, ddl: str, keep_corrupt: bool = True) -> Column:
    """``from_json`` in PERMISSIVE mode against a declared DDL schema.

    With ``keep_corrupt`` the struct gets a ``_corrupt_record`` field holding
    the line whenever it is not valid JSON or a value does not fit its
    declared type (a quoted number for a DOUBLE, ``120.0`` for a LONG).
    Field names match case-sensitively; nested objects and arrays declared as
    STRING come back as their JSON text.
    """
    value = F.col(value) if isinstance(value, str) else value
    if not keep_corrupt:
        return F.from_json(value, ddl)
    return F.from_json(value, f"{ddl}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT})


def parse_wrapped(value: Column | str, ddl: str) -> Column:
    """The line as a member of an object that one more member ends, parsed in one pass.

    A line that is one JSON value and fits the schema gives both members; of any
    other line the object is broken, corrupt or ends before its second member.
    """
    value = F.col(value) if isinstance(value, str) else value
    text = F.concat(F.lit(f'{{"{RECORD}":'), value, F.lit(f',"{END}":0}}'))
    return F.from_json(text, f"{RECORD} STRUCT<{ddl}>, {END} INT, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT})


def is_single(wrapped: Column, value: Column | str) -> Column:
    """True if the line is exactly one JSON object that fits the schema."""
    value = F.col(value) if isinstance(value, str) else value
    whole = wrapped[RECORD].isNotNull() & wrapped[END].isNotNull() & wrapped[CORRUPT].isNull() & ~F.contains(value, F.lit(END))
    return F.coalesce(whole, F.lit(False))


def parse_line(wrapped: Column, single: Column, value: Column | str, ddl: str) -> Column:
    """The struct that ``parse_json`` gives, taken from the wrapped line; only lines with something odd are parsed again."""
    fields = [wrapped[RECORD][name].alias(name) for name in StructType.fromDDL(ddl).fieldNames()]
    return F.when(single, F.struct(*fields, F.lit(None).cast("string").alias(CORRUPT))).otherwise(parse_json(value, ddl))


def parse_nested(text: Column | str, ddl: str) -> Column:
    """Re-parse a JSON array kept as text (e.g. ``genres``) into an array of structs."""
    text = F.col(text) if isinstance(text, str) else text
    return F.from_json(text, ddl)


def to_date_safe(c: Column | str) -> Column:
    """string -> DATE that yields NULL instead of failing under ANSI mode."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("date")


def to_int_safe(c: Column | str, sql_type: str = "INT") -> Column:
    """string -> integral type that yields NULL instead of failing under ANSI mode."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(sql_type.lower())


def typed_columns(contract: Contract) -> list[Column]:
    """Typed projection of the star-expanded source fields, in source order."""
    out = []
    for name in contract.source_fields:
        if name == contract.key_field:
            out.append(to_int_safe(name, contract.key_type).alias(contract.key_column))
        elif name in contract.date_fields:
            out.append(to_date_safe(name).alias(name))
        else:
            out.append(F.col(name))
    return out


def more_than_one_value(value: Column | str) -> Column:
    """True when a line does not hold exactly one JSON value: ``from_json`` reads the
    first one and would silently leave out what follows it. The line is wrapped in
    an array and in an object, so that no closing bracket of its own ends both."""
    value = F.col(value) if isinstance(value, str) else value
    one = (F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1) \
        & (F.size(F.json_object_keys(F.concat(F.lit('{"v":'), value, F.lit("}")))) == 1)
    return ~F.coalesce(one, F.lit(False))


def bad_nested(text: Column, ddl: str) -> Column:
    """True when nested text is there but is not an array of objects with ids."""
    parsed = parse_nested(text, ddl)
    return text.isNotNull() & F.coalesce(F.exists(parsed, lambda g: g.isNull() | g["id"].isNull()), F.lit(True))


def record_checks(contract: Contract, value: Column | str = "value", parsed: str = PARSED, single: str | None = None) -> list[tuple[str, Column]]:
    """(reason, failing condition) for the record-level checks; ``single`` names a column that is true for lines known to be one value.

    Conditions are over the line and its parsed struct ``parsed`` so they can be
    evaluated in the same projection that types the record.
    """
    s = F.col(parsed)
    key = s[contract.key_field]
    malformed = s.isNull() | s[CORRUPT].isNotNull()
    checks = [
        (MALFORMED, malformed),
        (TRAILING_DATA, F.when(F.col(single) if single else F.lit(False), F.lit(False)).otherwise(~malformed & more_than_one_value(value))),
        (MISSING_KEY, s.isNotNull() & key.isNull()),
        (BAD_KEY, key.isNotNull() & to_int_safe(key, contract.key_type).isNull()),
    ]
    if contract.date_fields:
        bad_date = F.lit(False)
        for d in contract.date_fields:
            bad_date = bad_date | (s[d].isNotNull() & to_date_safe(s[d]).isNull())
        checks.append((BAD_DATE, bad_date))
    checks.append((BAD_NESTED, bad_nested(s[contract.nested_field], contract.nested_ddl)))
    return checks


def rule_failures(contract: Contract) -> list[tuple[str, Column]]:
    """(rule name, failing condition) over typed columns; NULL counts as a failure."""
    return [(r.name, ~F.coalesce(F.expr(r.predicate), F.lit(False))) for r in contract.rules]


def reasons_column(named_conditions: list[tuple[str, Column]]) -> Column:
    """Array of the names whose condition is true, in list order (empty when none)."""
    return F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in named_conditions]),
                    lambda x: x.isNotNull())
