"""Readers: parquet batches, execution directories, catalog tables, rule tables."""

from lakeload.sources.files import (
    EXECUTION_COL,
    RULES_SCHEMA,
    list_dirs,
    path_exists,
    read_rules,
    rules_from_local_csv,
    scan_executions,
    scan_explicit_schema,
    scan_parquet,
    table_exists,
)

__all__ = [
    "EXECUTION_COL",
    "RULES_SCHEMA",
    "list_dirs",
    "path_exists",
    "read_rules",
    "rules_from_local_csv",
    "scan_executions",
    "scan_explicit_schema",
    "scan_parquet",
    "table_exists",
]
