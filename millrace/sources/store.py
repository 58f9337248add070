"""Parquet tables as numbered, immutable folders.

A table is a folder with `snap=N` (a full state) and `batch=N` (rows added by batch N) inside.
A folder counts only once Spark has put `_SUCCESS` into it, so a job that lost its executors or its
driver leaves nothing a reader would see, and running the batch again overwrites its own folder.
Readers take the newest snapshot and the later batches; which row wins per key is the reader's
merge rule. Appending a batch therefore costs its own size, not the table's.

`fold` keeps the number of folders small: `FAN` neighbouring folders of one size (1, FAN, FAN^2 ... batches)
become one folder `batch=LOW-HIGH`, so n batches stand in at most (FAN - 1) folders of each size, and a row
is rewritten once for each size. Rows of a folded folder carry their batch, so ranges of batches can still be
read. What was folded stays on disk for readers that planned on it, until `expire`.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

FAN = 16
BATCH = "_batch"
Part = tuple[int, int]  # first and last batch of a folder


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _marks(self, table: str, kind: str) -> dict[str, object]:
        """Status of the `_SUCCESS` file of each complete folder of a kind. Lists folder names only, never data."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{self.folder(table)}/{kind}=*/_SUCCESS")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = system.globStatus(path) or []
        return {status.getPath().getParent().getName().split("=")[1]: status for status in found}

    def _numbers(self, table: str, kind: str) -> list[int]:
        """The last batch of each complete folder of a kind."""
        return sorted(int(name.split("-")[-1]) for name in self._marks(table, kind))

    def _parts(self, table: str) -> list[Part]:
        """Complete folders of batches, folded and single ones, as far as no other one holds their rows."""
        found = [tuple(int(n) for n in name.split("-")) for name in self._marks(table, "batch")]
        ranges = sorted({(n[0], n[-1]) for n in found}, key=lambda p: (p[0], -p[1]))
        out: list[Part] = []
        for low, high in ranges:
            if not out or high > out[-1][1]:
                out.append((low, high))
        return out

    @staticmethod
    def _name(part: Part) -> str:
        return f"batch={part[0]:08d}" if part[0] == part[1] else f"batch={part[0]:08d}-{part[1]:08d}"

    def last_batch(self, table: str) -> int:
        """Number of the last batch the table has taken in; 0 for none. This is its offset."""
        return max([0, *self._numbers(table, "batch"), *self._numbers(table, "snap")])

    def add_batch(self, table: str, df: DataFrame, batch: int, partition_by: Sequence[str] = ()) -> None:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.folder(table)}/batch={batch:08d}")

    def add_snapshot(self, table: str, df: DataFrame, batch: int, order: Sequence[str] = ()) -> None:
        """Write a full state. With `order`, each file holds a range of it, sorted: ranges are then read from few files."""
        if order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        df.write.mode("overwrite").parquet(f"{self.folder(table)}/snap={batch:08d}")

    def batches(
        self, table: str, after: int = 0, upto: int | None = None, schema: str | None = None
    ) -> DataFrame | None:
        """Rows of the batches in (after, upto], one scan over all of them.

        A table partitioned inside its batches needs its `schema`: a batch without rows has no file.
        """
        last = upto if upto is not None else self.last_batch(table)
        parts = [part for part in self._parts(table) if part[1] > after and part[0] <= last]
        return self._read(table, parts, after, last, schema).drop(BATCH) if parts else None

    def _read(self, table: str, parts: Sequence[Part], after: int, upto: int, schema: str | None) -> DataFrame:
        paths = [f"{self.folder(table)}/{self._name(part)}" for part in parts]
        reader = self.spark.read.option("basePath", self.folder(table))
        reader = reader.option("mergeSchema", "true") if schema is None else reader.schema(f"{schema}, {BATCH} bigint")
        rows = reader.parquet(*paths).drop("batch")
        if any(low <= after or high > upto for low, high in parts):
            # A folded folder that the range covers in part: only such folders have rows outside of it.
            rows = rows.where(F.col(BATCH).isNull() | ((F.col(BATCH) > after) & (F.col(BATCH) <= upto)))
        return rows

    def fold(
        self,
        table: str,
        partition_by: Sequence[str] = (),
        schema: str | None = None,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        fan: int = FAN,
    ) -> int:
        """Fold what has gathered; returns the number of folders written.

        `merge` may reduce the rows of a folder (it keeps the column `BATCH`); without it all rows stay.
        """
        written = 0
        while due := self._due(self._parts(table), fan):
            rows = [self._stamped(table, part, schema) for part in due]
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
            if merge is not None:
                rows = merge(rows)
            target = f"{self.folder(table)}/{self._name((due[0][0], due[-1][1]))}"
            if partition_by:
                rows = rows.hint("rebalance", *partition_by)
            else:
                rows = rows.hint("rebalance")
            rows.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
            written += 1
        return written

    def _stamped(self, table: str, part: Part, schema: str | None) -> DataFrame:
        rows = self._read(table, [part], part[0] - 1, part[1], schema)
        if BATCH not in rows.columns:
            rows = rows.withColumn(BATCH, F.lit(None).cast("bigint"))
        return rows.withColumn(BATCH, F.coalesce(BATCH, F.lit(part[1]).cast("bigint")))

    @staticmethod
    def _due(parts: Sequence[Part], fan: int) -> list[Part]:
        """The first `fan` neighbours of the smallest size that has so many."""

        def size(part: Part) -> int:
            n, tier = part[1] - part[0] + 1, 0
            while n >= fan:
                n, tier = n // fan, tier + 1
            return tier

        runs: list[list[Part]] = []
        for part in parts:
            if runs and size(runs[-1][0]) == size(part) and len(runs[-1]) < fan:
                runs[-1].append(part)
            else:
                runs.append([part])
        full = [run for run in runs if len(run) == fan]
        return min(full, key=lambda run: size(run[0]), default=[])

    def expire(self, table: str, grace_seconds: float = 86_400) -> int:
        """Delete folders whose rows stand in a folded folder that is complete for longer than the grace time.

        A reader that planned before the folding has that long to end. Returns the number of folders deleted.
        """
        marks = self._marks(table, "batch")
        held = {tuple(int(n) for n in name.split("-")): name for name in marks}
        old = time.time() - grace_seconds
        folded = [p for p, name in held.items() if len(p) == 2 and marks[name].getModificationTime() / 1000 <= old]
        gone = 0
        for part, name in held.items():
            if any(low <= part[0] and part[-1] <= high and (low, high) != part for low, high in folded):
                path = marks[name].getPath().getParent()
                system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
                gone += bool(system.delete(path, True))
        return gone

    def snapshot(self, table: str, before: int | None = None, upto: int | None = None) -> DataFrame | None:
        """The newest full state (older than batch `before`, not newer than `upto`, if given)."""
        numbers = [n for n in self._numbers(table, "snap") if (before is None or n < before) and (upto is None or n <= upto)]
        if not numbers:
            return None
        return self.spark.read.parquet(f"{self.folder(table)}/snap={numbers[-1]:08d}")

    def publish(self, name: str, number: int) -> None:
        """Make the snapshots of a run visible together: an empty file whose name is the run's number."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder('_published')}/{name}={number:08d}")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        system.create(path, True).close()
        for older in self._published(name):
            if older < number:
                system.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path.getParent(), f"{name}={older:08d}"), False)

    def _published(self, name: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder('_published')}/{name}=*")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(int(found.getPath().getName().split("=")[1]) for found in system.globStatus(path) or [])

    def published(self, name: str) -> int:
        """The newest run of a name that is visible; 0 for none."""
        return max([0, *self._published(name)])

    def rows(self, table: str) -> DataFrame | None:
        """Newest snapshot and later batches, not yet merged by key."""
        snaps = self._numbers(table, "snap")
        parts = [self.snapshot(table), self.batches(table, after=snaps[-1] if snaps else 0)]
        parts = [part for part in parts if part is not None]
        if not parts:
            return None
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
