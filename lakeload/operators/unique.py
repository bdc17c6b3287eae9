"""Uniqueness of a wide column without shuffling its values.

Rows are first counted by a hash of the value, so eight bytes a distinct value are shuffled
instead of the value.  Only values whose hash was met more than once can repeat; their
rows alone are counted by value.  Two values with one hash are told apart there, so the
result is exact at any number of hash bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.functions.sizing import is_small
from lakeload.operators.dq import Rule, _result_struct, rule_metrics, rule_outcome, unique_columns, value_of
from lakeload.session import work_dir


def possible_repeats(values: DataFrame, bits: int = 64) -> DataFrame | None:
    """Rows of ``values`` (``__v``, not null) whose hash is met again; None if too many hashes repeat for a broadcast."""
    spark = values.sparkSession
    print_ = F.xxhash64("__v") if bits >= 64 else F.xxhash64("__v").bitwiseAND(F.lit((1 << bits) - 1))
    path = work_dir(spark, "dq-repeated")
    values.groupBy(print_.alias("__p")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__p").write.parquet(path)
    again = spark.read.schema("__p bigint").parquet(path)
    if not is_small(again):
        return None
    return values.withColumn("__p", print_).join(F.broadcast(again), "__p", "left_semi").select("__v")


def unique_metrics(df: DataFrame, rule: Rule, *, bits: int = 64) -> DataFrame:
    """The row of ``rule_metrics`` for one uniqueness rule: Key, metric_value, pass_fraction, holds, total_rows.

    A column in which more distinct hashes repeat than may be broadcast is counted by
    value, as ``rule_metrics`` does.  Nulls are no values; an empty table has no metric.
    """
    rows = df.select(value_of(df, unique_columns(rule)).alias("__v"))
    values = rows.where("__v is not null")
    possible = possible_repeats(values, bits)
    if possible is None:
        return rule_metrics(df, [rule])
    by_value = possible.groupBy("__v").agg(F.count(F.lit(1)).alias("__n"))
    zero = F.lit(0).cast("bigint")
    again = by_value.agg(F.coalesce(F.sum("__n"), zero).alias("rows"), F.count_if(F.col("__n") == 1).alias("once"))
    every = rows.agg(F.count(F.lit(1)).alias("total"), F.count("__v").alias("base"))
    parts = every.select("total", "base", zero.alias("rows"), zero.alias("once")).unionByName(again.select(zero.alias("total"), zero.alias("base"), "rows", "once"))
    state = parts.agg(*[F.sum(c).alias(c) for c in ("total", "base", "rows", "once")])
    met_once = F.col("base") - F.col("rows") + F.col("once")
    outcome = rule_outcome(rule, met_once, F.col("base"), F.lit(None).cast("double"))
    return state.select(F.inline(F.array(_result_struct(F.lit(rule.key), *outcome, F.col("total")))))
