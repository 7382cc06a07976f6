"""Column-level building blocks (built-in Spark expressions only)."""

from .ingest import (DEFAULT_SOURCE, STATUS_LOADED, STATUS_NEW, STATUS_QUARANTINED, ingest_time,
                     record_key)
from .parsing import (parse_json, parse_nested, reasons_column, record_checks, rule_failures,
                      to_date_safe, to_int_safe, typed_columns)
from .repair import abs_value, apply_repairs, floor_at

__all__ = [
    "DEFAULT_SOURCE", "STATUS_LOADED", "STATUS_NEW", "STATUS_QUARANTINED", "ingest_time",
    "record_key", "parse_json", "parse_nested", "reasons_column", "record_checks",
    "rule_failures", "to_date_safe", "to_int_safe", "typed_columns", "abs_value",
    "apply_repairs", "floor_at",
]
