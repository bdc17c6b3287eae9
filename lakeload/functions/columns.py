"""Pure Column builders: no actions, no Python UDFs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Number pattern used to scrape a metric out of a constraint message.
NUMBER_PATTERN = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"
# Impact classes and their thresholds on the failure percentage.
HIGH_IMPACT = "High Impact"
LOW_IMPACT = "Low Impact"
NO_IMPACT = "No Impact"

# Number of buckets over which rows with a null key are spread before a join.
# Null keys never match, so the bucket only decides which task carries the row.
NULL_KEY_BUCKETS = 1024


def key_condition(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    """``left.k1 = right.k1 and left.k2 = right.k2 ...`` (plain equality: null never matches)."""
    parts = [left[k] == right[k] for k in keys]
    if not parts:
        raise ValueError("a merge needs at least one key column")
    return reduce(lambda a, b: a & b, parts)


def any_null(keys: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def all_not_null(keys: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def null_key_salt(keys: Iterable[str], spread_on: Iterable[str]) -> Column:
    """0 for rows whose key is complete, 1..N for rows with a null key part.

    Joining on ``keys + salt`` (with the other side's salt fixed at 0) keeps the
    match semantics unchanged, but spreads the never-matching null-key rows over
    many shuffle partitions instead of sending all of them to the task that owns
    the hash of null.
    """
    keys = list(keys)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in spread_on]), F.lit(NULL_KEY_BUCKETS)) + 1
    return F.when(any_null(keys), spread).otherwise(F.lit(0)).cast("int")


_WIDENING = {
    "tinyint": {"smallint", "int", "bigint", "double", "float"},
    "smallint": {"int", "bigint", "double", "float"},
    "int": {"bigint", "double"},
    "bigint": set(),
    "float": {"double"},
    "timestamp": {"date"},
    "timestamp_ntz": {"date", "timestamp"},
    "date": {"timestamp", "timestamp_ntz"},
}


def cast_cannot_fail(source: str | None, target: str) -> bool:
    """True for casts that never reject a value (same type, widening, to string)."""
    if source is None:
        return False
    src, dst = source.lower(), target.lower().replace("integer", "int").replace("long", "bigint")
    return src == dst or dst == "string" or dst in _WIDENING.get(src, set())


def cast_columns(
    fields: Mapping[str, str], lenient: bool = False, source_types: Mapping[str, str] | None = None
) -> list[Column]:
    """``cast(f as T) as f`` for each configured field, in configuration order.

    ``lenient`` uses ``try_cast`` so that a bad value becomes null; strict mode fails
    the job on such a value whatever the session's ANSI setting.  With
    ``source_types`` (column -> type name), casts that cannot fail stay plain casts.
    """
    out = []
    for name, type_name in fields.items():
        c = F.col(f"`{name}`")
        if cast_cannot_fail((source_types or {}).get(name), type_name):
            out.append(c.cast(type_name).alias(name))
            continue
        converted = c.try_cast(type_name)
        if not lenient:
            # Strict whatever the session's ANSI setting: a value that does not
            # convert fails the job instead of turning into null.
            message = F.concat(F.lit(f"CAST_INVALID_INPUT: column {name} value '"), c.cast("string"), F.lit(f"' is not a valid {type_name}"))
            converted = F.when(c.isNotNull() & converted.isNull(), F.raise_error(message)).otherwise(converted)
        out.append(converted.alias(name))
    return out


def count_if(cond: Column) -> Column:
    """Count of rows where ``cond`` is true (null counts as false); bigint."""
    return F.count(F.when(cond, F.lit(1)))


def first_number(message: Column) -> Column:
    """First number found in a text, as double; null when there is none."""
    found = F.regexp_extract_all(message, F.lit(NUMBER_PATTERN), 0)
    return F.try_element_at(found, F.lit(1)).try_cast("double")


def impact_class(fail_pct: Column, pass_pct: Column) -> Column:
    """Failure above 50 % is high, above 0 low, a full pass none; otherwise null."""
    return (
        F.when(fail_pct > 50, F.lit(HIGH_IMPACT))
        .when((fail_pct <= 50) & (fail_pct > 0), F.lit(LOW_IMPACT))
        .when(pass_pct == 100, F.lit(NO_IMPACT))
    )


def bracket_list(text: Column, trim: bool = False) -> Column:
    """``'[a,b, c]'`` -> ``['a', 'b', ' c']`` (items keep blanks unless ``trim``)."""
    items = F.split(F.regexp_replace(text, r"[\[\]]", ""), ",")
    return F.transform(items, lambda x: F.trim(x)) if trim else items
