"""Column-expression helpers shared by the operators (all JVM-side builtins)."""

from lakeload.functions.columns import (
    NUMBER_PATTERN,
    bracket_list,
    cast_columns,
    count_if,
    first_number,
    impact_class,
    key_condition,
    null_key_salt,
    any_null,
    all_not_null,
)
from lakeload.functions.sizing import is_small

__all__ = [
    "NUMBER_PATTERN",
    "bracket_list",
    "cast_columns",
    "count_if",
    "first_number",
    "impact_class",
    "key_condition",
    "null_key_salt",
    "any_null",
    "all_not_null",
    "is_small",
]
