"""Change feed between two snapshots of a keyed table.

Rows are tagged ``insert``, ``delete``, ``update_preimage`` and ``update_postimage``
(an update gives both images; a row whose values did not change gives nothing).

Plan (each snapshot is read once; no join ever pairs rows up):

1. ``before ∪ after`` is grouped by the whole row, counting how often the row
   occurs on each side (map-side combine; identical rows collapse early).  Rows
   with equal counts are unchanged and drop out; the rest are *removed* or *added*
   with a multiplicity.
2. The changed rows (usually a small fraction) are grouped by key: a key with
   exactly one removed and one added row is an update (pre and post image);
   anything else is reported as deletes and inserts.  Rows with a null key never
   pair with anything, so they are deletes / inserts; they are spread over many
   tasks by a salt instead of meeting in the task that owns ``hash(null)``.

``feed_of_merge`` starts from a merge's tagged frame with images instead: kept rows never
leave their task, so only what the merge touched is grouped, and no snapshot is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.functions import all_not_null, count_if, null_key_salt
from lakeload.operators import merge as mg

CHANGE_TYPE = "_change_type"
INSERT, DELETE, PRE, POST = "insert", "delete", "update_preimage", "update_postimage"


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    cols = list(before.columns)
    both = before.select(*cols, F.lit(1).alias("__inb"), F.lit(0).alias("__ina")).unionByName(
        after.select(*cols, F.lit(0).alias("__inb"), F.lit(1).alias("__ina"))
    )
    return _labelled(both, cols, keys)


def feed_of_merge(tagged: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The change feed of a merge from its tagged frame (``merge(..., images=True)``), staged or not.

    Equal to ``change_feed`` of the tables before and after: removed and added rows of
    equal values cancel, and a key deleted and inserted again is an update.
    """
    keys, cols = list(keys), list(columns)
    action = F.col(mg.ACTION)
    touched = tagged.filter(action.isin(mg.UPDATE, mg.DELETE, mg.INSERT))
    old = F.struct(*[F.col(mg.OLD)[c].alias(c) for c in cols], F.lit(1).alias("__inb"), F.lit(0).alias("__ina"))
    new = F.struct(*[F.col(f"`{c}`") for c in cols], F.lit(0).alias("__inb"), F.lit(1).alias("__ina"))
    sides = F.when(action == mg.UPDATE, F.array(old, new)).when(action == mg.DELETE, F.array(old)).otherwise(F.array(new))
    return _labelled(touched.select(F.inline(sides)), cols, keys)


def _labelled(both: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """Change rows from removed (``__inb``) and added (``__ina``) rows."""
    rows = (
        both.groupBy(*cols)
        .agg(F.sum("__inb").alias("__nb"), F.sum("__ina").alias("__na"))
        .filter(F.col("__nb") != F.col("__na"))
        .select(
            *cols,
            F.greatest(F.col("__nb") - F.col("__na"), F.lit(0)).alias("__removed"),
            F.greatest(F.col("__na") - F.col("__nb"), F.lit(0)).alias("__added"),
        )
    )
    per_key = (
        rows.filter(all_not_null(keys))
        .groupBy(*keys)
        .agg(F.sum("__removed").alias("__r"), F.sum("__added").alias("__s"))
        .select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__r", "__s")
        # 0 for every row (r, s >= 0); written so the optimizer keeps it a join key
        .withColumn("__salt_k", F.when(F.col("__r") < 0, F.lit(-1)).otherwise(F.lit(0)))
    )
    salted = rows.withColumn("__salt", null_key_salt(keys, cols))
    cond = None
    for k in keys:
        c = salted[k] == per_key[f"__k_{k}"]
        cond = c if cond is None else cond & c
    cond = cond & (salted["__salt"] == per_key["__salt_k"])
    labelled = salted.join(per_key, cond, "left")
    update = (F.col("__r") == 1) & (F.col("__s") == 1)
    kind = (
        F.when(F.col("__removed") > 0, F.when(update, F.lit(PRE)).otherwise(F.lit(DELETE)))
        .otherwise(F.when(update, F.lit(POST)).otherwise(F.lit(INSERT)))
    )
    times = F.greatest(F.col("__removed"), F.col("__added")).cast("int")
    return labelled.select(*cols, kind.alias(CHANGE_TYPE), F.explode(F.array_repeat(F.lit(1), times)).alias("__x")).drop("__x")


def change_counts(feed: DataFrame) -> DataFrame:
    """One row of counts per change type (updates counted once, by post image)."""
    t = F.col(CHANGE_TYPE)
    return feed.agg(
        count_if(t == INSERT).alias("num_inserted_rows"),
        count_if(t == POST).alias("num_updated_rows"),
        count_if(t == DELETE).alias("num_deleted_rows"),
    )


def apply_change_feed(before: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``before`` with the feed applied: the inverse of ``change_feed`` (for checks)."""
    cols = list(before.columns)
    t = F.col(CHANGE_TYPE)
    removed = feed.filter(t.isin(DELETE, PRE)).select(*cols)
    added = feed.filter(t.isin(INSERT, POST)).select(*cols)
    return before.select(*cols).exceptAll(removed).unionByName(added)
