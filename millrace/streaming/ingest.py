"""Structured Streaming entry points.

Both streams are idempotent per micro-batch: a batch writes into a folder named after itself, so a
batch that is replayed after a failure overwrites what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import upsert_latest
from ..session import scratch_dir
from ..sources import files
from ..sources.store import Store


def stream_latest(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    glob: str,
    keys: Sequence[str],
    seq: Sequence[str],
) -> DataFrame:
    """Drain a folder of Parquet files as a stream, keeping the newest row per key.

    Each micro-batch appends only its own winners; the final pick runs over those.
    """
    store = Store(spark, scratch_dir(spark, "stream-latest"))
    order = [F.col(c) for c in seq]

    def fold(batch: DataFrame, epoch: int) -> None:
        store.add_batch("latest", upsert_latest(None, batch, keys, order), epoch + 1)

    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(source)
    query = (
        stream.writeStream.foreachBatch(fold)
        .option("checkpointLocation", store.folder("checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = store.rows("latest")
    if rows is None:
        rows = spark.createDataFrame([], schema)
    return upsert_latest(None, rows, keys, order)


def stream_files(
    store: Store,
    root: str,
    checkpoint: str,
    after_batch: Callable[[int], None] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Ingest new event files as they appear; `after_batch` can refresh the layers above.

    Without `every` the stream takes what is there and stops; with it (say "30 seconds") it goes on.
    New paths set off a micro-batch. It compares the listing of the whole tree with the ledger, so files that
    were rewritten under their old path come in with it; contents of other files are not read. The ledger also
    keeps a replayed micro-batch from adding rows twice.
    """

    def take(_: DataFrame, epoch: int) -> None:
        number = files.ingest(store, root)
        if after_batch is not None:
            after_batch(number)

    stream = files.discover(store.spark, root, streaming=True)
    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if every is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=every)
    return writer.start()
