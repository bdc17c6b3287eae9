"""Data-quality states per execution, summed for the report: a load checks new data only.

A state is what a rule needs from a part of a table so that parts add up: passing rows, base rows,
the largest length, and for uniqueness the frequency of every value.  States
of an execution are written once; the report sums them over executions.

Layout, below ``root/<table>/<rules>`` (a hash of the table's rules, so changed rules start
anew): ``freq`` holds value frequencies and is overwritten by execution, then ``counts`` is
appended, which makes the execution count as done.  An execution that was cut off in between is
simply read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.operators.dq import UNIQUE, Rule, rule_errors, rule_outcome, rule_state, unique_columns
from lakeload.sources import EXECUTION_COL
from lakeload.sources.files import path_exists

COUNTS = f"{EXECUTION_COL} string, Key int, passing bigint, base bigint, top double, total bigint, error string"
FREQ = f"Key int, value string, n bigint, {EXECUTION_COL} string"


def _value(df: DataFrame, rule: Rule) -> Column:
    """The value of a uniqueness rule as text that is equal for equal values only; null where all columns are."""
    cols = []
    for c in unique_columns(rule):
        zero = F.lit(0.0) if df.schema[c].dataType.simpleString() in ("double", "float") else None
        cols.append((F.col(f"`{c}`") + zero if zero is not None else F.col(f"`{c}`")).alias(c))  # -0.0 is 0.0
    some = F.coalesce(*[F.when(F.col(f"`{c}`").isNotNull(), F.lit(True)) for c in unique_columns(rule)])
    return F.when(some, F.to_json(F.struct(*cols)))


class DqStates:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, name: str, rules: Sequence[Rule]) -> str:
        told = hashlib.sha256(repr(sorted(rules, key=lambda r: r.key)).encode()).hexdigest()[:16]
        return f"{self.root}/{name}/{told}"

    def _read(self, path: str, schema: str) -> DataFrame:
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def executions(self, name: str, rules: Sequence[Rule]) -> set[str]:
        """Executions that have a state (one row each and rule; names only reach the driver)."""
        rows = self._read(f"{self._folder(name, rules)}/counts", COUNTS).select(EXECUTION_COL).distinct()
        return {r[0] for r in rows.collect()}

    def refresh(self, name: str, rows: DataFrame, rules: Sequence[Rule]) -> None:
        """Store the states of the executions in ``rows`` (with ``execution_id``): one aggregation by execution."""
        folder, errors = self._folder(name, rules), rule_errors(rows, rules)
        shared = [r for r in rules if r.function not in UNIQUE and r.key not in errors]
        unique = [r for r in rules if r.function in UNIQUE and r.key not in errors]
        if unique:
            met = F.inline(F.array(*[F.struct(F.lit(r.key).alias("Key"), _value(rows, r).alias("value")) for r in unique]))
            freq = rows.select(EXECUTION_COL, met).groupBy("Key", "value", EXECUTION_COL).agg(F.count(F.lit(1)).alias("n"))
            freq.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(EXECUTION_COL).parquet(f"{folder}/freq")
        states = [x.alias(f"{n}{i}") for i, r in enumerate(shared) for n, x in zip("nbt", rule_state(r))]
        agg = rows.groupBy(EXECUTION_COL).agg(F.count(F.lit(1)).alias("total"), *states)
        none = F.lit(None)
        told = [(r, *(F.col(f"{n}{i}") for n in "nbt")) for i, r in enumerate(shared)] + [(r, none, none, none) for r in rules if r not in shared]
        structs = [
            F.struct(
                F.lit(r.key).alias("Key"), n.cast("bigint").alias("passing"), b.cast("bigint").alias("base"), t.cast("double").alias("top"),
                F.col("total"), F.lit(errors.get(r.key)).cast("string").alias("error"),
            )
            for r, n, b, t in told
        ]
        agg.select(EXECUTION_COL, F.inline(F.array(*structs))).write.mode("append").parquet(f"{folder}/counts")

    def metric_rows(self, name: str, rules: Sequence[Rule]) -> list[tuple]:
        """One row per rule from the summed states, as ``dq.metric_rows`` gives for whole tables."""
        folder = self._folder(name, rules)
        done = self._read(f"{folder}/counts", COUNTS)
        sums = done.groupBy("Key").agg(
            F.sum("passing").alias("n"), F.sum("base").alias("b"), F.max("top").alias("t"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.max("error").alias("error")
        )
        if any(r.function in UNIQUE for r in rules):
            freq = self._read(f"{folder}/freq", FREQ).join(done.select(EXECUTION_COL).distinct(), EXECUTION_COL, "left_semi")
            whole = freq.groupBy("Key", "value").agg(F.sum("n").alias("c"))
            met = F.col("value").isNotNull()
            uniq = whole.groupBy("Key").agg(F.count(F.when(met & (F.col("c") == 1), 1)).alias("un"), F.sum(F.when(met, F.col("c"))).alias("ub"))
            sums = sums.join(uniq, "Key", "left").select("Key", F.coalesce("un", "n").alias("n"), F.coalesce("ub", "b").alias("b"), "t", "total", "error")
        metric = passed = F.lit(None).cast("double")
        holds = F.lit(False)
        for r in rules:
            m, p, h = rule_outcome(r, F.col("n"), F.col("b"), F.col("t"))
            own = F.col("Key") == r.key
            metric, passed, holds = F.when(own, m).otherwise(metric), F.when(own, p).otherwise(passed), F.when(own, h).otherwise(holds)
        broken = F.col("error").isNotNull()
        out = sums.select(
            F.lit(name).alias("table_name"), "Key", F.when(~broken, metric).alias("m"), F.when(broken, F.lit(0.0)).otherwise(passed).alias("p"),
            (~broken & holds).alias("h"), "total", "error",
        )
        return [tuple(r) for r in out.collect()]
