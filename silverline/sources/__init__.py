"""Scans, sinks and catalog registration."""

from .catalog import ensure_database, register_external
from .files import (explode_array, read_catalog_table, read_multiline_json, read_table_path,
                    read_text_lines)
from .sinks import append, export_json_lines, to_json_lines, write_batch, write_create_only

__all__ = ["ensure_database", "register_external", "explode_array", "read_catalog_table",
           "read_multiline_json", "read_table_path", "read_text_lines", "append",
           "export_json_lines", "to_json_lines", "write_batch", "write_create_only"]
