"""Versioned snapshots over plain parquet.

A table is a folder of ``version=N`` sub-folders, each a complete snapshot written
by one Spark job.  A version counts only once its ``_SUCCESS`` marker exists, so a
half-written version is never read.  A new version never overwrites the folder it
reads from, which is what makes read-merge-write safe on parquet.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeload.sources.files import _fs, list_dirs

VERSION_COL = "version"
_APPLIED = "_applied"


class ConcurrentCommitError(RuntimeError):
    """Another writer moved the table past the version a change was computed from."""


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = [c for c in partition_by if c]

    def _path(self, version: int) -> str:
        return f"{self.root}/{VERSION_COL}={version}"

    def path(self, version: int | None = None) -> str:
        """Folder of a version (default: latest committed)."""
        return self._path(self.latest_version() if version is None else version)

    def versions(self) -> list[int]:
        """Committed versions, ascending (one glob for all ``_SUCCESS`` markers)."""
        fs, pattern = _fs(self.spark, f"{self.root}/{VERSION_COL}=*/_SUCCESS")
        found = fs.globStatus(pattern) or []
        out = []
        for st in found:
            name = st.getPath().getParent().getName()
            try:
                out.append(int(name.split("=", 1)[1]))
            except ValueError:
                continue
        return sorted(out)

    def exists(self) -> bool:
        return bool(self.versions())

    def latest_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def read(self, version: int | None = None) -> DataFrame:
        """The snapshot at ``version`` (default: latest committed)."""
        if version is None:
            version = self.latest_version()
            if version is None:
                raise FileNotFoundError(f"no committed version under {self.root}")
        elif version not in self.versions():
            raise FileNotFoundError(f"version {version} is not committed under {self.root}")
        return self.spark.read.parquet(self._path(version))

    def history(self) -> DataFrame:
        """All committed versions with a ``version`` column (partition discovery)."""
        paths = [self._path(v) for v in self.versions()]
        return self.spark.read.option("basePath", self.root).parquet(*paths)

    def applied_batches(self) -> set[str]:
        """Batch ids recorded with committed versions (see ``commit(batch_ids=...)``)."""
        committed = self.versions()
        root = f"{self.root}/{_APPLIED}"
        if not committed or not list_dirs(self.spark, root):
            return set()
        df = self.spark.read.option("basePath", root).parquet(root)
        rows = df.filter(F.col(VERSION_COL).isin(*committed)).select("batch_id").distinct().collect()
        return {r["batch_id"] for r in rows}

    def commit(
        self,
        df: DataFrame,
        metrics: Sequence[Column] = (),
        batch_ids: Sequence[str] = (),
        base_version: int | None = None,
    ) -> tuple[int, dict]:
        """Write ``df`` as the next version; return ``(version, observed metrics)``.

        ``metrics`` are aggregate expressions observed on ``df`` during the write
        (rows written is always included as ``rows``).  ``batch_ids`` are recorded
        with the version *before* its data is written; they count as applied only
        once the version is committed, so "applied" and "visible" change together.
        ``base_version`` is the version ``df`` was computed from: if another writer
        has started or committed a newer version since, the commit is refused
        (optimistic concurrency) instead of silently dropping that writer's changes.
        """
        # Skip folders of failed writes too (they hold no _SUCCESS but do exist).
        taken = [int(n.split("=", 1)[1]) for n in list_dirs(self.spark, self.root) if n.startswith(f"{VERSION_COL}=")]
        if base_version is not None and any(v > base_version for v in taken):
            raise ConcurrentCommitError(
                f"{self.root}: version(s) {sorted(v for v in taken if v > base_version)} appeared after base {base_version}"
            )
        version = max(taken, default=0) + 1
        if batch_ids:
            ids = self.spark.createDataFrame([(str(b),) for b in batch_ids], "batch_id string")
            ids.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{_APPLIED}/{VERSION_COL}={version}")
        obs = Observation(f"commit_{uuid.uuid4().hex[:8]}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
        w = observed.write.mode("errorifexists")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(self._path(version))
        return version, dict(obs.get)

    def retract(self, version: int) -> None:
        """Take back a committed version: without its marker it is never read again."""
        fs, marker = _fs(self.spark, f"{self._path(version)}/_SUCCESS")
        fs.delete(marker, False)

    def restore(self, version: int) -> int:
        """Make ``version`` current again by committing it as a new version."""
        new_version, _ = self.commit(self.read(version))
        return new_version
