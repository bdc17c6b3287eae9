"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a ``groupBy`` and a join; edges and labels stay distributed, and each
round is written to the shared checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

import gc
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.session import work_dir

_SCOPE = threading.local()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a work table below the checkpoint folder and read it back."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    for made in getattr(_SCOPE, "open", ()):
        made.append(path)
    out.work_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(*tables: DataFrame) -> None:
    """Delete work tables that nothing will read again (frames that are no work tables are left alone)."""
    for t in tables:
        path = getattr(t, "work_path", None)
        if path:
            _delete(t.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Work tables made inside (by this thread) are deleted at the end, but for those given to ``keep``.

    For operators whose result depends on a few written tables only: ``with scratch(spark) as keep: ...``.
    """
    made: list[str] = []
    kept: set[str] = set()
    _SCOPE.open = [*getattr(_SCOPE, "open", []), made]
    try:
        yield lambda *tables: kept.update(t.work_path for t in tables)
    finally:
        _SCOPE.open = [m for m in _SCOPE.open if m is not made]
        for path in made:
            if path not in kept:
                _delete(spark, path)
        free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished rounds: its cleaner waits for the driver's garbage collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Edges a task of a star step works on, and the tasks a step has at least: a step over few edges
#: runs as few tasks, whatever the number of shuffle partitions.
TASK_EDGES = 200_000
LEAST_TASKS = 8


def _large_star(e: DataFrame, tasks: int) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").coalesce(tasks)


def _small_star(e: DataFrame, tasks: int) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    return (
        e.join(least.hint("merge"), "u")
        .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        .select("x.u", "x.v")
        .where("u <> v")
        .coalesce(tasks)
        .distinct()
        .coalesce(tasks)
    )


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that has an edge; root is the smallest node of its component.

    ``edges`` has two columns of one comparable type; self loops, repeats and rows
    with a null end are allowed and add nothing.  No edges give an empty table.
    """
    a, b = edges.columns[:2]
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = stage(e.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "cc")
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now["n"] == 0 or now == mark:
            break
        mark = now
        tasks = max(LEAST_TASKS, now["n"] // TASK_EDGES)
        before, e = e, stage(_small_star(_large_star(e, tasks), tasks), "cc")
        release(before)
    free_shuffles(spark)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def settle(spark: SparkSession, links: DataFrame, pairs: DataFrame, verify, rounds: int = 2) -> DataFrame:
    """``links`` plus the confirmed ones of ``pairs`` (a, b) that join components.

    ``pairs`` is used up: a work table is deleted once it has been read.  Some rounds verify one pair for each two components, since one link is enough to
    join them; the last round verifies every pair whose ends are still apart, so no
    link that matters is lost.
    """
    for last in [False] * rounds + [True]:
        if pairs.isEmpty():
            break
        roots = components(spark, links)
        x, y = roots.toDF("a", "ra"), roots.toDF("b", "rb")
        apart = pairs.join(x, "a", "left").join(y, "b", "left").select("a", "b", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb")).where("ra <> rb")
        if last:
            chosen = apart.select("a", "b")
        else:
            ends = apart.groupBy(F.least("ra", "rb").alias("lo"), F.greatest("ra", "rb").alias("hi")).agg(F.min(F.struct("a", "b")).alias("p"))
            chosen = ends.select("p.a", "p.b")
        chosen = stage(chosen, "cc-chosen")
        links = links.union(stage(verify(chosen), "cc-links"))
        before, pairs = pairs, stage(apart.select("a", "b").join(chosen, ["a", "b"], "left_anti"), "cc-pairs")
        release(before, chosen)
    return links
