"""Incremental jobs.

Each micro-batch writes to its own ``batch=<id>`` folder in overwrite mode, so a
batch that is replayed after a failure replaces its output instead of doubling it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lorefield.operators.chunking import chunk_documents
from lorefield.operators.collections import to_collection, with_ids
from lorefield.operators.generation import Model
from lorefield.plans.ingest import ingest_rows
from lorefield.session import spread

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def write_batches(stream: DataFrame, build: Callable[[DataFrame, int], dict[str, DataFrame]], checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    """Run ``build`` on each micro-batch and write each ``{folder: rows}`` it returns."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # Each output is written from the source files again only if it is not kept here.
        batch.persist()
        try:
            for folder, rows in build(batch, batch_id).items():
                rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def incremental_chunks(files: DataFrame, out: str, log: str, checkpoint: str, available_now: bool = True,
                       **chunking) -> StreamingQuery:
    """Chunk files as they arrive and log their completion.

    ``files`` is a stream ``file_name, text, checksum``; chunks go to ``out`` and one
    state event per file to ``log``.
    """
    def build(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        # The files of a batch come in few partitions, but their chunks are worth every core.
        chunks = chunk_documents(spread(batch.select("file_name", "text")), **chunking)
        events = batch.select(
            F.col("file_name").alias("file"), "checksum", F.current_timestamp().alias("processed_at"),
            F.lit("complete").alias("status"), F.lit(1).alias("step"), F.lit(None).cast("string").alias("error"),
            F.array("file_name").alias("output_files"))
        return {out: chunks, log: events}

    return write_batches(files, build, checkpoint, available_now)


@contextmanager
def _rocksdb(spark) -> Iterator[None]:
    """State of streams started here lives on the executors' disks, not in their heaps; a stream takes its settings at its start."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def first_arrivals(rows: DataFrame, key: str = "id", event_time: str | None = None, keep_for: str | None = None) -> DataFrame:
    """The rows of a stream whose key has not arrived before; one null key counts like any other.

    Keys seen are the stream's state, kept by hash of the key: a micro-batch
    looks up and adds its own keys, whatever has arrived before. With
    ``event_time`` and ``keep_for`` (such as ``'7 days'``) a key is forgotten
    that long after it arrived, so the state does not grow for ever.
    """
    if (event_time is None) != (keep_for is None):
        raise ValueError("event_time and keep_for belong together")
    # Told apart as text, as collections hold ids.
    keyed = rows.withColumn("_key", F.col(key).cast("string"))
    if event_time is None:
        return keyed.dropDuplicates(["_key"]).drop("_key")
    return keyed.withWatermark(event_time, keep_for).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def streaming_ingest(rows: DataFrame, out: str, checkpoint: str, embedding_template: str | None = None,
                     document_template: str | None = None, encoder: Model | None = None, source_file: str = "",
                     available_now: bool = True, event_time: str | None = None, keep_for: str | None = None, **options) -> StreamingQuery:
    """Append arriving rows to a collection folder.

    Rows with templates are rendered and embedded; without, they must carry a
    vector. A repeated id is stored once, whether its copies arrive in one batch
    or in several: the ids seen are state of the stream (see ``first_arrivals``),
    so a batch costs what it brings, and a batch that is replayed after a failure
    starts from the state before it. Rows without an id column all stay; their
    derived ids hold the number of the batch.
    """
    given = "id" in rows.columns
    fresh = first_arrivals(rows, "id", event_time, keep_for) if given else rows

    def build(batch: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        salt = "" if given else f"{batch_id}:"
        made = (to_collection(with_ids(batch, salt)) if embedding_template is None else
                ingest_rows(batch, embedding_template, document_template or embedding_template, encoder,
                            source_file, id_salt=salt, **options))
        return {out: made}

    with _rocksdb(rows.sparkSession):
        return write_batches(fresh, build, checkpoint, available_now)


def log_state(events: DataFrame, log: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream of file-state events to the log that ``current_state`` reads."""
    return write_batches(events, lambda batch, batch_id: {log: batch}, checkpoint, available_now)
