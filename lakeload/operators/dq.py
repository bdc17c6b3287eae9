"""Rule-table-driven data-quality checks and the impact report.

A rule table (see ``sources.RULES_SCHEMA``) names, per table, an attribute, a rule
function and its arguments.  The rules define the *plan*: they are a small, bounded
configuration that is read on the driver, and each becomes one aggregate column.
All rules of a table are computed by **one** ``agg`` over the table (plus one
group-by job per uniqueness rule), results are unpivoted to one row per rule and
joined back to the rule rows on their key.  No data row reaches the driver.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeload.functions import bracket_list, count_if, first_number, impact_class

LOG = logging.getLogger(__name__)

# Constraint status names and the failure message of a rule.
SUCCESS, FAILURE = "Success", "Failure"
MESSAGE_PREFIX = "Value: "
MESSAGE_SUFFIX = " does not meet the constraint requirement!"

# Patterns of the predefined checks (Java regex and RE2 agree on them).
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
URL_PATTERN = r"(https?|ftp)://[^\s/$.?#][^\s]*"
# Card numbers of 15 or 16 digits in one piece or in their usual groups; US social security numbers.
CARD_PATTERN = (
    r"\b((4[0-9]{3}|5[1-5][0-9]{2}|65[0-9]{2}|6011)([0-9]{12}|( [0-9]{4}){3}|(-[0-9]{4}){3})"
    r"|3[47][0-9]{2}([0-9]{11}| [0-9]{6} [0-9]{5}|-[0-9]{6}-[0-9]{5}))\b"
)
SSN_PATTERN = (
    r"\b(00[1-9]|0[1-9][0-9]|[1-57-8][0-9]{2}|6[0-57-9][0-9]|66[0-57-9])"
    r"(-(0[1-9]|[1-9][0-9])-| (0[1-9]|[1-9][0-9]) )(000[1-9]|00[1-9][0-9]|0[1-9][0-9]{2}|[1-9][0-9]{3})\b"
)
CONTENT_PATTERNS = {
    "containsEmail": EMAIL_PATTERN, "containsURL": URL_PATTERN,
    "containsCreditCardNumber": CARD_PATTERN, "containsSocialSecurityNumber": SSN_PATTERN,
}
#: Rules over the frequencies of values.
UNIQUE = ("isUnique", "isPrimaryKey")
TYPE_PATTERNS = {
    "Boolean": r"^(true|false)$",
    "Integral": r"^[-+]?[0-9]+$",
    "Fractional": r"^[-+]?[0-9]*\.[0-9]+([eE][-+]?[0-9]+)?$",
}

# Rule shapes, in the order the rule columns are tested.
KIND_COLUMN = "column"          # Condition is null: f(attribute)
KIND_LIST = "list"              # Condition starts with '[': f(attribute, values)
KIND_ASSERTION = "assertion"    # hasMaxLength: f(attribute, assertion text)
KIND_SATISFIES = "satisfies"    # Pattern set: f(predicate, label, == Value)
KIND_DATATYPE = "datatype"      # Condition is a type name such as 'Boolean'
KIND_ARGUMENT = "argument"      # anything else: f(attribute, Condition)

_ASSERTION_RE = re.compile(r"^\s*lambda\s+(\w+)\s*:\s*\1\s*(==|<=|>=|<|>|!=)\s*([-+]?[0-9]*\.?[0-9]+)\s*$")
_OPS = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
}
_COMPARISONS = {
    "isLessThan": "<", "isLessThanOrEqualTo": "<=", "isGreaterThan": ">", "isGreaterThanOrEqualTo": ">=",
}

RESULT_COLUMNS = [
    "Table Name", "Attribute Name", "Rule Definition", "Domain", "DQ Dimension",
    "Constraint Status", "Constraint Message", "Row Num", "Total Rows",
]
REPORT_COLUMNS = [
    "Table Name", "Attribute Name", "Rule Definition", "DQ Dimension", "Constraint Status", "Domain",
    "Total Rows", "Pass Count", "Failure Count", "Pass %", "Fail %", "Impact", "Constraint Message", "Date",
]


def parse_rules(rules: DataFrame, trim_items: bool = False) -> DataFrame:
    """Add ``attribute`` (trimmed), ``rule_kind`` and ``list_values`` to a rule table."""
    cond = F.col("Condition")
    kind = (
        F.when(cond.isNull(), F.lit(KIND_COLUMN))
        .when(F.substring(cond, 1, 1) == "[", F.lit(KIND_LIST))
        .when(F.col("Rule Function") == "hasMaxLength", F.lit(KIND_ASSERTION))
        .when(F.col("Pattern").isNotNull(), F.lit(KIND_SATISFIES))
        .when(cond.isin(*TYPE_PATTERNS, "String"), F.lit(KIND_DATATYPE))
        .otherwise(F.lit(KIND_ARGUMENT))
    )
    return rules.select(
        "*",
        F.trim(F.col("Attribute Name")).alias("attribute"),
        kind.alias("rule_kind"),
        F.when(kind == KIND_LIST, bracket_list(cond, trim_items)).alias("list_values"),
    )


@dataclass(frozen=True)
class Rule:
    key: int
    function: str
    attribute: str
    kind: str
    condition: str | None
    value: int | None
    values: tuple[str, ...]


def _frac(n: Column, d: Column) -> Column:
    return F.try_divide(n.cast("double"), d.cast("double"))


def _assertion(text: str):
    m = _ASSERTION_RE.match(text or "")
    if not m:
        raise ValueError(f"unsupported assertion {text!r}: expected 'lambda x: x <op> <number>'")
    return m.group(2), float(m.group(3))


def rule_state(rule: Rule) -> tuple[Column, Column, Column]:
    """``(passing, base, top)`` of a rule as aggregates that can be added up over parts of a table.

    ``passing`` and ``base`` are row counts (sums), ``top`` is a maximum (null but for length rules).
    """
    c = F.col(f"`{rule.attribute}`")
    total = F.count(F.lit(1))
    none = F.lit(None).cast("double")
    f = rule.function
    if f == "isComplete":
        return F.count(c), total, none
    if f == "hasDataType":
        if rule.condition == "String":
            typed = F.lit(True)
            for p in TYPE_PATTERNS.values():
                typed = typed & ~c.cast("string").rlike(p)
        else:
            typed = c.cast("string").rlike(TYPE_PATTERNS[rule.condition])
        return count_if(c.isNotNull() & typed), F.count(c), none
    if f == "hasMaxLength":
        op, bound = _assertion(rule.condition)
        length = F.length(c.cast("string"))
        return count_if(c.isNull() | _OPS[op](length, F.lit(bound))), total, F.max(length).cast("double")
    if f == "isNonNegative":  # like null, text that is no number counts as 0
        passes = F.coalesce(c.try_cast("double"), F.lit(0.0)) >= 0
    elif f == "isPositive":
        passes = F.coalesce(c.try_cast("double"), F.lit(1.0)) > 0
    elif f in CONTENT_PATTERNS:
        passes = c.cast("string").rlike(CONTENT_PATTERNS[f])
    elif f == "isContainedIn":
        passes = c.isNull() | c.cast("string").isin(*rule.values)
    elif f == "hasPattern":
        passes = c.cast("string").rlike(rule.condition)
    elif f in _COMPARISONS:
        passes = _OPS[_COMPARISONS[f]](c, F.col(f"`{rule.condition.strip()}`"))
    elif f == "satisfies":
        passes = F.expr(rule.condition)
    else:
        raise ValueError(f"unsupported rule function {f!r}")
    return count_if(passes), total, none


def rule_outcome(rule: Rule, passing: Column, base: Column, top: Column) -> tuple[Column, Column, Column]:
    """``(metric value, fraction of passing rows, assertion holds)`` from a rule's (summed) state."""
    frac = _frac(passing, base)
    if rule.function == "hasMaxLength":
        op, bound = _assertion(rule.condition)
        return top, frac, F.coalesce(_OPS[op](top, F.lit(bound)), F.lit(False))
    asserted = float(rule.value if rule.value is not None else 1) if rule.function == "satisfies" else 1.0
    return frac, frac, F.coalesce(frac == F.lit(asserted), F.lit(False))


def unique_columns(rule: Rule) -> list[str]:
    """Columns whose value together must be unique: the attribute and, for a primary key, its list."""
    return [rule.attribute, *(v.strip() for v in rule.values)]


def _unique_state(values: Column, n: Column) -> tuple[Column, Column, Column]:
    """State of a uniqueness rule over distinct values (null where every column is) and their row counts."""
    met = values.isNotNull()
    return count_if(met & (n == 1)), F.sum(F.when(met, n)), F.lit(None).cast("double")


def collect_rules(rules: DataFrame) -> dict[str, list[Rule]]:
    """All rules by table, read once on the driver (bounded configuration, not data)."""
    out: dict[str, list[Rule]] = {}
    for r in parse_rules(rules).collect():
        out.setdefault(r["Table Name"], []).append(
            Rule(
                key=r["Key"], function=r["Rule Function"], attribute=r["attribute"], kind=r["rule_kind"],
                condition=r["Condition"], value=r["Value"], values=tuple(r["list_values"] or ()),
            )
        )
    return out


def _rules_for(rules: DataFrame, table_name: str) -> list[Rule]:
    """Rules of one table (see ``collect_rules``)."""
    return collect_rules(rules.filter(F.col("Table Name") == table_name)).get(table_name, [])


def _result_struct(key: Column, metric: Column, pass_frac: Column, holds: Column, total: Column) -> Column:
    return F.struct(
        key.cast("int").alias("Key"),
        metric.cast("double").alias("metric_value"),
        pass_frac.cast("double").alias("pass_fraction"),
        holds.alias("holds"),
        total.cast("bigint").alias("total_rows"),
    )


def _wanted(rule: Rule) -> list[str]:
    if rule.function == "satisfies":
        return []
    return unique_columns(rule) if rule.function in UNIQUE else [rule.attribute]


def rule_errors(df: DataFrame, rules: Sequence[Rule]) -> dict[int, str]:
    """Why rules cannot run on this table (unknown column, function or text), by key.

    All are analyzed together; only where that fails one by one.
    """
    errors, rest = {}, []
    for r in rules:
        unknown = [c for c in _wanted(r) if c not in df.columns]
        if unknown:
            errors[r.key] = f"Input data does not include column {unknown[0]}!"
        elif r.function not in UNIQUE:
            rest.append(r)

    def analyzed(some: Sequence[Rule]) -> None:
        df.agg(*[x.alias(f"x{i}") for i, x in enumerate(x for r in some for x in rule_state(r))])  # analysis only

    try:
        if rest:
            analyzed(rest)
    except (AnalysisException, KeyError, ValueError, AttributeError):
        for r in rest:
            try:
                analyzed([r])
            except (AnalysisException, KeyError, ValueError, AttributeError) as e:
                errors[r.key] = str(e).split("\n")[0]
    return errors


def rule_error(df: DataFrame, rule: Rule) -> str | None:
    """Why a rule cannot run on this table; None if it can."""
    return rule_errors(df, [rule]).get(rule.key)


def _failed() -> tuple[Column, Column, Column]:
    return F.lit(None).cast("double"), F.lit(0.0), F.lit(False)


def rule_metrics(df: DataFrame, rules: Sequence[Rule], errors: Mapping[int, str] | None = None) -> DataFrame:
    """One row per rule: Key, metric_value, pass_fraction, holds, total_rows.

    Rules that share the table scan are fused into a single aggregation; each
    uniqueness rule adds one group-by (map-side combined) over its columns.  A rule
    that cannot run (``errors``, by key) fails alone: no metric, pass fraction 0.
    """
    broken = rule_errors(df, rules) if errors is None else errors
    shared = [r for r in rules if r.function not in UNIQUE or r.key in broken]
    parts = []
    if shared:
        states, structs = [], []
        for i, r in enumerate(shared):
            if r.key in broken:
                outcome = _failed()
            else:
                states += [x.alias(f"{n}{i}") for n, x in zip("nbt", rule_state(r))]
                outcome = rule_outcome(r, *(F.col(f"{n}{i}") for n in "nbt"))
            structs.append(_result_struct(F.lit(r.key), *outcome, F.col("__total")))
        agg = df.agg(F.count(F.lit(1)).alias("__total"), *states)
        parts.append(agg.select(F.inline(F.array(*structs))))
    for r in rules:
        if r.function not in UNIQUE or r.key in broken:
            continue
        freq = df.groupBy(value_of(df, unique_columns(r)).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
        u = freq.agg(*[x.alias(n) for n, x in zip("nbt", _unique_state(F.col("__v"), F.col("__n")))], F.coalesce(F.sum("__n"), F.lit(0)).alias("__total"))
        parts.append(u.select(F.inline(F.array(_result_struct(F.lit(r.key), *rule_outcome(r, F.col("n"), F.col("b"), F.col("t")), F.col("__total"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def value_of(df: DataFrame, columns: Sequence[str]) -> Column:
    """One value for the columns of a uniqueness rule; null where all of them are."""
    if len(columns) == 1:
        return F.col(f"`{columns[0]}`")
    some = F.coalesce(*[F.when(F.col(f"`{c}`").isNotNull(), F.lit(True)) for c in columns])
    return F.when(some, F.struct(*[F.col(f"`{c}`") for c in columns]))


def _message(metric: Column, holds: Column) -> Column:
    text = F.concat(F.lit(MESSAGE_PREFIX), F.round(metric, 6).cast("string"), F.lit(MESSAGE_SUFFIX))
    return F.when(holds, F.lit("")).otherwise(F.coalesce(text, F.lit(MESSAGE_PREFIX + "null" + MESSAGE_SUFFIX)))


def check_table(
    df: DataFrame, rules: DataFrame, table_name: str, parsed: Sequence[Rule] | None = None
) -> DataFrame | None:
    """Constraint results of one table joined to its rule rows; None without rules."""
    if parsed is None:
        parsed = _rules_for(rules, table_name)
    if not parsed:
        return None
    errors = rule_errors(df, parsed)
    message = F.lit(None).cast("string")
    for key, error in errors.items():
        message = F.when(F.col("Key") == key, F.lit(error)).otherwise(message)
    metrics = rule_metrics(df, parsed, errors).select(F.lit(table_name).alias("table_name"), "*", message.alias("error"))
    return with_rules(metrics, rules.filter(F.col("Table Name") == table_name))


def with_rules(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Rule metrics (table_name, Key, ..., error) with status, message and their rule rows."""
    res = metrics.select(
        "*",
        F.when(F.col("holds"), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("Constraint Status"),
        F.coalesce("error", _message(F.col("metric_value"), F.col("holds"))).alias("Constraint Message"),
    )
    on = (res["Key"] == rules["Key"]) & (res["table_name"] == rules["Table Name"])
    # The rule rows are bounded by the (collected) rule list.
    return res.join(F.broadcast(rules), on, "inner").drop(rules["Key"])


METRIC_ROWS = "table_name string, Key int, metric_value double, pass_fraction double, holds boolean, total_rows bigint, error string"


def metric_rows(tables: Mapping[str, DataFrame], by_table: Mapping[str, Sequence[Rule]]) -> list[tuple]:
    """Metrics of every table that has rules, one row per rule, whatever the data holds.

    All tables are one job.  Should it fail at run time (a predicate that divides by zero,
    a value that does not convert) the tables run one by one, and the rules of a
    table that fails one by one, so a rule that cannot run costs its own row only.
    """
    errors = {n: rule_errors(df, by_table[n]) for n, df in tables.items() if by_table.get(n)}

    def rows(name: str, rules: Sequence[Rule], known: Mapping[int, str]) -> DataFrame:
        return rule_metrics(tables[name], rules, known).select(F.lit(name).alias("table_name"), "*")

    def run(frames: Sequence[DataFrame]) -> list[tuple]:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        found = [tuple(r) for r in out.collect()]  # one row per rule
        return [(*r, errors[r[0]].get(r[1])) for r in found]

    if not errors:
        return []
    try:
        return run([rows(n, by_table[n], errors[n]) for n in errors])
    except Exception:  # noqa: BLE001 - found out below which rule it was
        LOG.warning("a data quality rule failed at run time", exc_info=True)
    out = []
    for n in errors:
        try:
            out += run([rows(n, by_table[n], errors[n])])
        except Exception:  # noqa: BLE001
            for r in by_table[n]:
                try:
                    out += run([rows(n, [r], errors[n])])
                except Exception as e:  # noqa: BLE001
                    errors[n][r.key] = str(e).split("\n")[0]
                    try:
                        out += run([rows(n, [r], errors[n])])
                    except Exception:  # noqa: BLE001 - not even the rows can be counted
                        out.append((n, r.key, None, 0.0, False, None, errors[n][r.key]))
    return out


def results_frame(results: DataFrame) -> DataFrame:
    """The nine result columns in a fixed order (typed ``Row Num`` = the rule key)."""
    return results.select(
        "Table Name", "Attribute Name", "Rule Definition", "Domain", "DQ Dimension",
        "Constraint Status", "Constraint Message",
        F.col("Key").cast("int").alias("Row Num"), F.col("total_rows").cast("long").alias("Total Rows"),
        "metric_value", "pass_fraction",
    )


def empty_results(spark: SparkSession) -> DataFrame:
    schema = StructType.fromJson(
        {
            "type": "struct",
            "fields": [
                {"name": n, "type": t, "nullable": True, "metadata": {}}
                for n, t in [
                    ("Table Name", "string"), ("Attribute Name", "string"), ("Rule Definition", "string"),
                    ("Domain", "string"), ("DQ Dimension", "string"), ("Constraint Status", "string"),
                    ("Constraint Message", "string"), ("Row Num", "integer"), ("Total Rows", "long"),
                    ("metric_value", "double"), ("pass_fraction", "double"),
                ]
            ],
        }
    )
    return spark.createDataFrame([], schema)


def report(results: DataFrame, as_of: str) -> DataFrame:
    """Pass / fail percentages and counts, impact class and report date per rule."""
    frac = F.coalesce(F.when(F.col("Constraint Status") == SUCCESS, F.lit(1.0)).otherwise(F.col("pass_fraction")), F.lit(1.0))
    pass_pct = frac * 100
    fail_pct = (F.lit(1.0) - frac) * 100
    total = F.col("Total Rows").cast("double")
    return results.select(
        "Table Name", "Attribute Name", "Rule Definition", "DQ Dimension", "Constraint Status", "Domain",
        "Total Rows",
        F.round(pass_pct * (total / 100), 2).alias("Pass Count"),
        F.round(fail_pct * (total / 100), 2).alias("Failure Count"),
        F.round(pass_pct, 2).alias("Pass %"),
        F.round(fail_pct, 2).alias("Fail %"),
        impact_class(fail_pct, pass_pct).alias("Impact"),
        "Constraint Message",
        F.date_format(F.lit(as_of).cast("date"), "dd/MM/yyyy").alias("Date"),
    )


def message_metric(results: DataFrame) -> DataFrame:
    """Percentages scraped from the constraint message (first number; none = pass)."""
    v = first_number(F.col("Constraint Message"))
    return results.select(
        "Table Name", "Row Num",
        F.coalesce(v * 100, F.lit(100.0)).alias("Pass %"),
        F.coalesce((F.lit(1.0) - v) * 100, F.lit(0.0)).alias("Fail %"),
    )
