"""Settings and small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_dir

T = TypeVar("T")

# An Arrow batch is bounded by its bytes, so that very long texts do not pile up in a Python worker.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> SparkSession:
    """Runtime settings that every plan of this subpackage is written for."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the cluster's shared folder and read it back: cuts the lineage for good.

    A lost executor then costs a new read of a file, never the work before it.
    """
    folder = scratch_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs inside leave no shuffle files behind. For small results that come to the driver and are not asked for again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fresh(prefix: str) -> str:
    """A column name that clashes with no other."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def content_key(text: Column) -> list[Column]:
    """96 bits that stand for a text: equal texts share them, null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("key_a"), F.hash(text).alias("key_b")]


def kept_by_worker(name: Hashable, build: Callable[[], T]) -> T:
    """What a Python worker keeps from task to task: one thing at a time.

    Spark runs the tasks of all steps in the same worker processes. What an earlier step kept there is dropped before
    the next one builds its own, so that the caches of a chain of steps do not add up.
    """
    slot = sys.__dict__.setdefault("_millrace_kept", {})
    if name not in slot:
        slot.clear()
        gc.collect()
        give_back()  # also what steps without caches left
        slot[name] = build()
    return slot[name]


def forget() -> None:
    """Drop what a Python worker keeps of an earlier step; for steps that need room and keep nothing themselves.

    Freed memory is given back to the system: a worker lives on, and the JVM beside it may need the room.
    """
    slot = sys.__dict__.setdefault("_millrace_kept", {})
    if slot:
        slot.clear()
        gc.collect()
        give_back()


def give_back() -> None:
    """Unused memory of Arrow and of the C library goes back to the system, where the library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
