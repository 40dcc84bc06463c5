"""Upserted result tables of streaming queries that survive a crash at any point.

A micro-batch's rows are written once, into a folder of their own, and
count from the moment a small commit file names that folder.  Nothing that
is committed is ever rewritten: a batch that dies before its commit leaves
an unnamed folder, and its replay writes another; a batch that is replayed
after its commit is known by its id and skipped.  Readers take the newest
rows of each key from the committed folders.  ``compact`` writes those as a
base, committed in the same way, and ``vacuum`` deletes what no commit
names any more.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

VERSION = "_version"


@dataclass(frozen=True)
class Commit:
    """A folder (None: no rows) that holds the rows of micro-batch ``version``, or of all up to it."""
    version: int
    folder: str | None
    base: bool


class UpsertTable:
    """A table below ``path`` in which a micro-batch's rows replace earlier rows of the same ``keys``
    (several rows of one key value in a batch stay together).  Rows are partitioned by day of
    ``day_of``, so that readers of some days read their files only."""

    def __init__(self, spark: SparkSession, path: str, keys, day_of: str = "window_end", day_col: str = "window_day"):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.day_of, self.day_col = list(keys), day_of, day_col

    # -- files, through Spark's own file system layer

    def _fs(self, name: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), p

    def _publish(self, name: str, content: dict) -> None:
        """Put a whole file under ``commits`` in one step."""
        fs, target = self._fs(f"commits/{name}")
        _, draft = self._fs(f"drafts/{name}-{os.urandom(6).hex()}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise FileExistsError(f"{target} is committed already")

    def commits(self) -> list[Commit]:
        """All commits, oldest first; a base stands behind the batch that it reaches up to."""
        fs, folder = self._fs("commits")
        if not fs.exists(folder):
            return []
        found = []
        for status in fs.listStatus(folder):
            stream = fs.open(status.getPath())
            content = json.loads(bytes(stream.readAllBytes()).decode())
            stream.close()
            found.append(Commit(**content))
        return sorted(found, key=lambda c: (c.version, c.base))

    def visible(self) -> list[Commit]:
        """The commits that readers need: the newest base and the batches after it."""
        out: list[Commit] = []
        for c in self.commits():
            out = [c] if c.base else [*out, c]
        return out

    # -- rows

    def _write(self, rows: DataFrame, label: str) -> str:
        folder = f"{label}-{os.urandom(6).hex()}"
        (rows.withColumn(self.day_col, F.to_date(self.day_of)).write.partitionBy(self.day_col)
         .parquet(f"{self.path}/data/folder={folder}"))
        return folder

    def commit(self, rows: DataFrame, batch_id: int) -> bool:
        """Make the rows of a micro-batch count; False if they did before (a replay)."""
        if any(c.version >= batch_id for c in self.commits()):
            return False
        kept = rows.withColumn(VERSION, F.lit(batch_id).cast("bigint")).persist()
        try:
            folder = None if kept.isEmpty() else self._write(kept, f"batch-{batch_id}")
        finally:
            kept.unpersist()
        self._publish(f"{batch_id:020d}", {"version": batch_id, "folder": folder, "base": False})
        return True

    def read(self, days=None, versions: bool = False) -> DataFrame | None:
        """The newest rows of each key (of the given days), or None while no rows are committed."""
        folders = [f"{self.path}/data/folder={c.folder}" for c in self.visible() if c.folder]
        if not folders:
            return None
        rows = self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders).drop("folder")
        if days is not None:
            rows = rows.where(F.col(self.day_col).isin(list(days)))
        newest = F.max(VERSION).over(Window.partitionBy(*self.keys))
        rows = rows.withColumn("_newest", newest).where(F.col(VERSION) == F.col("_newest")).drop("_newest")
        return rows if versions else rows.drop(VERSION, self.day_col)

    def compact(self) -> None:
        """Write the newest rows as one base in place of all batches so far."""
        visible = self.visible()
        rows = self.read(versions=True)
        if rows is None or len(visible) < 2:
            return
        last = visible[-1].version
        folder = self._write(rows.drop(self.day_col), f"base-{last}")
        self._publish(f"{last:020d}-base", {"version": last, "folder": folder, "base": True})

    def vacuum(self) -> None:
        """Delete commits that a base covers, and every folder that no commit is left to name.  Call it
        while no batch is being written and no reader still works on what a compaction replaced."""
        visible = self.visible()
        fs, folder = self._fs("commits")
        if not fs.exists(folder):
            return
        names = {f"{c.version:020d}{'-base' if c.base else ''}" for c in visible}
        for status in fs.listStatus(folder):
            if status.getPath().getName() not in names:
                fs.delete(status.getPath(), False)
        kept = {f"folder={c.folder}" for c in visible}
        for part in ("data", "drafts"):
            fs, folder = self._fs(part)
            if fs.exists(folder):
                for status in fs.listStatus(folder):
                    if status.getPath().getName() not in kept:
                        fs.delete(status.getPath(), True)
