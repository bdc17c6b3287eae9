"""Keyed MERGE of a change batch into a table, over plain DataFrames.

Semantics (S = source row with the key, T = target row with the key):

========  ==========  =====================  ===========================
T present S flag      CDC                    FULL
========  ==========  =====================  ===========================
yes       (no S)      keep                   keep
yes       true        delete                 delete
yes       false       update all columns     delete, then insert
yes       null        update all columns     delete (row is lost)
no        false       insert                 insert
no        true/null   drop                   drop
========  ==========  =====================  ===========================

Keys compare with plain equality, so a null key never matches.  CDC mode deletes
first, then updates and inserts: a key with one true row and further rows in the same
batch is deleted, and its false rows are inserted again (its null rows are dropped).
Several true rows for one target row, or several rows without a true one, are an
error (raised inside the job).

Plan shape (the target's rows are read and shuffled once — in CDC mode the insert
side adds a scan of the key columns only; no full outer join):

* target side: ``target LEFT JOIN source_by_key`` where ``source_by_key`` is the
  source reduced to one row per key by an aggregation (map-side combine collapses a
  hot key before the shuffle).  Target rows with a null key are spread over many
  shuffle partitions by a salt column; they can never match.  Keys that hold a large
  share of the target (``heavy_keys``) are salted too, and only their source rows are
  repeated, once for each salt.
* insert side: ``source LEFT ANTI target_keys`` (CDC; only the key columns of the
  target are read) — AQE can split a skewed source partition of this join.  The
  target's keys and the keys the batch deletes are one aggregation, so a hot key is a
  few rows by then and four shuffles and two joins make the whole merge.  FULL
  needs no join here: every source row with flag false is inserted.
* When the source is proven small, it is broadcast and the target is never
  shuffled; the insert side then uses the (small) set of matched keys.  Otherwise both
  joins stay sort-merge joins: adaptive execution would broadcast any side whose shuffle
  files are small, and keys compress so well that 10 MB of them are over 30 MB on the driver.

The result is a *tagged* frame (target columns + ``_action``); table rows and
insert / update / delete / drop counts both come from it, so a write with observed
metrics gives everything in one job.  With ``images`` it also carries ``_old``, the
target row before the merge, which is all a change feed needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions import all_not_null, count_if, is_small, null_key_salt
from lakeload.specs import CDC, DELETE_FLAG, FULL

ACTION = "_action"
OLD = "_old"
KEEP, UPDATE, DELETE, INSERT, DROP = "keep", "update", "delete", "insert", "drop"
LIVE_ACTIONS = (KEEP, UPDATE, INSERT)

_FLAG = "__flag"
_N = "__n"
_N_TRUE = "__n_true"
_GONE = "__gone"
_HERE = "__here"
_S = "__src"
_SALT = "__salt"
_SALT_R = "__salt_r"

#: Counters of the sketch that finds heavy target keys, and the most it reports.
HEAVY_TRACKED = 4096
HEAVY_KEYS = 256
#: Salts for each even share of rows a heavy key holds (more than one, so that hashing fills the partitions
#: evenly), and the most salts.
SALTS_PER_SHARE = 8
HEAVY_SALTS = 65_536

MULTI_MATCH_ERROR = "MERGE: several source rows match the same target row"


def metric_columns() -> list[Column]:
    a = F.col(ACTION)
    return [
        count_if(a == INSERT).alias("num_inserted_rows"),
        count_if(a == UPDATE).alias("num_updated_rows"),
        count_if(a == DELETE).alias("num_deleted_rows"),
        count_if(a == DROP).alias("num_dropped_rows"),
        count_if(a == KEEP).alias("num_kept_rows"),
    ]


@dataclass
class MergeResult:
    tagged: DataFrame
    columns: list[str]
    mode: str
    broadcast: bool

    def rows(self) -> DataFrame:
        """The table after the merge."""
        return self.tagged.filter(F.col(ACTION).isin(*LIVE_ACTIONS)).select(*[F.col(f"`{c}`") for c in self.columns])

    def metrics(self) -> DataFrame:
        """One row: inserted, updated, deleted, dropped and kept row counts."""
        return self.tagged.agg(*metric_columns())


def _source_frame(target: DataFrame, source: DataFrame, flag: str) -> DataFrame:
    """Source values take the table's types (the table's schema rules the merge)."""
    cols = [F.col(f"`{c}`").cast(target.schema[c].dataType).alias(c) for c in target.columns]
    return source.select(*cols, F.col(f"`{flag}`").cast("boolean").alias(_FLAG))


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


@dataclass(frozen=True)
class HeavyKeys:
    """Hashes of the keys that hold more than a shuffle partition's share, and their salts."""

    hashes: tuple[int, ...] = ()
    salts: int = 1

    def among(self, keys: Sequence[str]) -> Column:
        return _key_hash(keys).isin(*self.hashes) if self.hashes else F.lit(False)


def heavy_keys(target: DataFrame, keys: Sequence[str], partitions: int | None = None) -> HeavyKeys:
    """Keys with at least twice the rows of an even shuffle partition.

    One aggregation over the key columns keeps ``HEAVY_TRACKED`` counters a task (a
    frequent-items sketch of key hashes, whose estimates are never low by more than
    rows / ``HEAVY_TRACKED``); at most ``HEAVY_KEYS`` hashes reach the driver.  A wrong or missing
    entry costs speed, never a row.
    """
    spark = target.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = target.filter(all_not_null(keys)).agg(
        F.count(F.lit(1)).alias("n"), F.call_function("approx_top_k", _key_hash(keys), F.lit(HEAVY_KEYS), F.lit(HEAVY_TRACKED)).alias("top")
    ).first()
    even = found["n"] / max(1, partitions)
    heavy = [(r["item"], r["count"]) for r in found["top"] or [] if r["count"] >= 2 * even and r["count"] > 1]
    if not heavy or partitions < 2:
        return HeavyKeys()
    salts = min(HEAVY_SALTS, max(2, -(-max(n for _, n in heavy) * SALTS_PER_SHARE // max(1, int(even)))))
    return HeavyKeys(tuple(h for h, _ in heavy), int(salts))


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    mode: str = CDC,
    flag: str = DELETE_FLAG,
    small_source: bool | None = None,
    heavy: HeavyKeys | None = None,
    images: bool = False,
) -> MergeResult:
    """Tag every target and source row with what the merge does to it.

    ``small_source`` forces (True) or forbids (False) the broadcast plan; by default a
    bounded job checks the source size first.  ``heavy`` (see ``heavy_keys``) splits hot
    target keys in the shuffle plan.  ``images`` adds ``_old``, the target row before the
    merge (null for source rows).
    """
    mode = mode.upper()
    if mode not in (CDC, FULL):
        raise ValueError(f"unknown merge mode {mode!r}")
    keys = list(keys)
    cols = list(target.columns)
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"merge keys {missing} are not columns of the target")
    values = [c for c in cols if c not in keys]
    src = _source_frame(target, source, flag)
    if small_source is None:
        small_source = is_small(src)

    # One row per complete key: n rows and (any) their values + flag.  In the
    # shuffle plan the source side also carries the join's salt (0 for every
    # complete key, written as pmod(hash, 1) so the optimizer cannot fold it away):
    # grouping by it leaves the aggregate partitioned exactly as the join needs, so
    # the deduplicated source is shuffled once, not twice.
    heavy = heavy or HeavyKeys()
    no_salt = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(1)).cast("int")
    # Keys that cannot be null need no salt: the planner would drop it on one side only.
    salt_target = not small_source and bool(heavy.hashes or any(target.schema[k].nullable for k in keys))
    salt_source = not small_source and any(src.schema[k].nullable for k in keys)
    complete = src.filter(all_not_null(keys))
    group_cols = [F.col(k) for k in keys]
    if salt_target:
        if heavy.hashes:  # a heavy key's source rows meet every salt of its target rows
            salts = F.when(heavy.among(keys), F.sequence(F.lit(0), F.lit(heavy.salts - 1))).otherwise(F.array(no_salt))
            complete = complete.select("*", F.explode(salts).alias(_SALT_R))
            group_cols.append(F.col(_SALT_R))
        else:
            group_cols.append(no_salt.alias(_SALT_R))
    by_key = (
        complete.groupBy(*group_cols)
        .agg(F.count(F.lit(1)).alias(_N), count_if(F.col(_FLAG)).alias(_N_TRUE), F.any_value(F.struct(*values, _FLAG)).alias(_S))
        .select(*[F.col(k).alias(f"__s_{k}") for k in keys], _N, _N_TRUE, _S, *([_SALT_R] if salt_target else []))
    )
    t = target
    if salt_target:
        salt = null_key_salt(keys, cols)
        if heavy.hashes:
            # by content, so that a task that runs again deals its rows out alike
            dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), F.lit(heavy.salts)).cast("int")
            salt = F.when(heavy.among(keys) & all_not_null(keys), dealt).otherwise(salt)
        t = t.withColumn(_SALT, salt)
    right = F.broadcast(by_key) if small_source else by_key.hint("merge")
    cond = t[_SALT] == right[_SALT_R] if salt_target else F.lit(True)
    for k in keys:
        cond = (t[k] == right[f"__s_{k}"]) & cond
    joined = t.join(right, cond, "left")

    matched = F.col(_N).isNotNull()
    if mode == CDC:
        action = (
            F.when(~matched, F.lit(KEEP))
            .when((F.col(_N_TRUE) > 1) | ((F.col(_N_TRUE) == 0) & (F.col(_N) > 1)), F.raise_error(F.lit(MULTI_MATCH_ERROR)).cast("string"))
            .when(F.col(_N_TRUE) == 1, F.lit(DELETE))
            .otherwise(F.lit(UPDATE))
        )
        out_cols = [
            F.col(f"`{c}`") if c in keys else F.when(matched, F.col(_S)[c]).otherwise(t[f"`{c}`"]).alias(c)
            for c in cols
        ]
    else:
        action = F.when(~matched, F.lit(KEEP)).otherwise(F.lit(DELETE))
        out_cols = [t[f"`{c}`"].alias(c) for c in cols]
    old = [F.struct(*[t[f"`{c}`"].alias(c) for c in cols]).alias(OLD)] if images else []
    target_side = joined.select(*out_cols, action.alias(ACTION), *old)

    insert_action = F.when(F.col(_FLAG) == F.lit(False), F.lit(INSERT)).otherwise(F.lit(DROP))
    none = [F.lit(None).cast(target.select(*[F.col(f"`{c}`") for c in cols]).schema).alias(OLD)] if images else []
    if mode == FULL:
        insert_side = src.select(*cols, insert_action.alias(ACTION), *none)
    else:
        # A target key that the batch deletes stands in the way of its true row only.
        target_keys = target.select(*keys).filter(all_not_null(keys))
        if small_source:
            src_keys = src.filter(all_not_null(keys)).groupBy(*keys).agg(F.coalesce(F.bool_or(_FLAG), F.lit(False)).alias(_GONE))
            tk = target_keys.join(F.broadcast(src_keys), keys).distinct()
            s, on = src, keys
        else:
            deleted = src.filter(F.col(_FLAG) & all_not_null(keys)).select(*keys, F.lit(False).alias(_HERE), F.lit(True).alias(_GONE))
            both = target_keys.select(*keys, F.lit(True).alias(_HERE), F.lit(False).alias(_GONE)).unionByName(deleted)
            by = [no_salt.alias(_SALT)] if salt_source else []
            tk = both.groupBy(*keys, *by).agg(F.bool_or(_HERE).alias(_HERE), F.bool_or(_GONE).alias(_GONE)).filter(_HERE)
            s, on = src, keys
            if salt_source:
                s, on = src.withColumn(_SALT, null_key_salt(keys, cols + [_FLAG])), keys + [_SALT]
        tk = tk.select(*[F.col(k).alias(f"__t_{k}") for k in on], F.coalesce(F.col(_GONE), F.lit(False)).alias(_GONE))
        stands = F.coalesce(s[_FLAG], F.lit(False)) | ~tk[_GONE]
        for k in on:
            stands = (s[k] == tk[f"__t_{k}"]) & stands
        unmatched = s.join(F.broadcast(tk) if small_source else tk.hint("merge"), stands, "left_anti")
        insert_side = unmatched.select(*cols, insert_action.alias(ACTION), *none)

    tagged = target_side.unionByName(insert_side)
    return MergeResult(tagged=tagged, columns=cols, mode=mode, broadcast=bool(small_source))


def bootstrap_target(batch: DataFrame, flag: str = DELETE_FLAG) -> DataFrame:
    """A missing table is created from the whole first batch (deleted rows included)."""
    return batch.drop(flag)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last row per complete key by ``order_by``; rows with a null key are all kept.

    ``max_by`` over a struct is an aggregation with a map-side combine, so a key that
    holds a large share of the rows is reduced before the shuffle instead of being
    sorted in one task as a window would.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(f"`{c}`") for c in order_by])
    latest = (
        df.filter(all_not_null(keys))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), order).alias("__last"))
        .select(*keys, *[F.col("__last")[c].alias(c) for c in others])
        .select(*df.columns)
    )
    return latest.unionByName(df.filter(~all_not_null(keys)))


def duplicate_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source keys present more than once that also match a target row (the rows a
    CDC merge refuses), with their multiplicity in ``n_source_rows``."""
    keys = list(keys)
    dup = (
        source.filter(all_not_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_source_rows"))
        .filter(F.col("n_source_rows") > 1)
    )
    return dup.join(target.select(*keys), keys, "left_semi")


def _flagged(source: DataFrame, target: DataFrame, flag: str) -> DataFrame:
    return _source_frame(target, source, flag)


def delete_step(target: DataFrame, source: DataFrame, keys: Sequence[str], flag: str = DELETE_FLAG) -> DataFrame:
    """Target rows left after ``when matched and flag = true then delete`` (anti join)."""
    gone = _flagged(source, target, flag).filter(F.col(_FLAG) == F.lit(True)).select(*keys)
    return target.join(gone.filter(all_not_null(keys)), list(keys), "left_anti")


def insert_step(target: DataFrame, source: DataFrame, keys: Sequence[str], flag: str = DELETE_FLAG) -> DataFrame:
    """Source rows ``when not matched and flag = false then insert``."""
    src = _flagged(source, target, flag)
    return (
        src.filter(F.col(_FLAG) == F.lit(False))
        .join(target.select(*keys).filter(all_not_null(keys)), list(keys), "left_anti")
        .select(*target.columns)
    )


def update_step(target: DataFrame, source: DataFrame, keys: Sequence[str], flag: str = DELETE_FLAG) -> DataFrame:
    """Matched rows with the source's values (``when matched then update set *``),
    for source rows not flagged as deleted."""
    src = _flagged(source, target, flag).filter(~F.coalesce(F.col(_FLAG), F.lit(False)))
    return src.join(target.select(*keys), list(keys), "left_semi").select(*target.columns)


def repeats_keys(batches: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> bool:
    """Whether one batch (``order_by``) holds a complete key more than once."""
    rows = batches.filter(all_not_null(keys)).groupBy(*keys, *order_by).agg(F.count(F.lit(1)).alias(_N))
    return not rows.filter(F.col(_N) > 1).isEmpty()


def collapse_changes(
    batches: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    mode: str = CDC,
    flag: str = DELETE_FLAG,
) -> DataFrame:
    """Reduce several ordered CDC batches to one net change per key.

    Merging the result once gives the same table as merging the batches one after
    another (one table rewrite instead of one per batch), provided each batch holds
    at most one row per key (``latest_per_key`` per batch ensures that):

    * CDC: the net row carries the values of the key's last row and the flag of its
      last row whose flag is not null (null when all are null).  A null flag only
      updates an existing row, so it never changes whether the key exists.
    * FULL: every batch replaces the key, so the last row (values and flag) decides.

    ``order_by`` orders the batches (and rows inside them); rows with a null key are
    passed through unchanged.  The reduction is an aggregation with map-side combine.
    """
    keys = list(keys)
    order = F.struct(*[F.col(f"`{c}`") for c in order_by])
    others = [c for c in batches.columns if c not in keys and c != flag]
    fl = F.col(f"`{flag}`")
    net_flag = F.max_by(fl, F.when(fl.isNotNull(), order)) if mode.upper() == CDC else F.max_by(fl, order)
    net = (
        batches.filter(all_not_null(keys))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), order).alias("__last"), net_flag.alias("__flag"))
        .select(*keys, *[F.col("__last")[c].alias(c) for c in others], F.col("__flag").alias(flag))
        .select(*batches.columns)
    )
    return net.unionByName(batches.filter(~all_not_null(keys)))
