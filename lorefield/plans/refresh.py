"""Bring the chunks of a corpus up to date: new, changed and failed files only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lorefield.operators.chunking import chunk_documents
from lorefield.operators.states import files_to_process

UNREADABLE = "the file is not valid UTF-8 text"


@dataclass(frozen=True)
class Refresh:
    """``chunks``: the new snapshot; ``events``: rows for the state log; ``errors``: rows for the error log."""

    chunks: DataFrame
    events: DataFrame
    errors: DataFrame


def refresh_chunks(files: DataFrame, chunks: DataFrame | None, state: DataFrame, **chunking) -> Refresh:
    """Chunk what ``state`` does not show as done and replace the chunks of those files.

    ``files(file_name, text, checksum)`` is the present corpus, ``chunks`` the last
    snapshot and ``state`` what ``current_state`` makes of the log. Files that are
    new, changed, failed or incomplete are chunked again; chunks of files that no
    longer exist go. A file without readable text is logged as failed and the
    others go on; its earlier chunks stay until it can be read. Write the
    snapshot to a new place, then append the events and errors.
    """
    named = files.withColumnRenamed("file_name", "file")
    readable = F.col("text").isNotNull() & F.coalesce(F.is_valid_utf8("text"), F.lit(False))
    todo = files_to_process(named, state, 1).withColumn("_readable", readable)
    good = todo.where("_readable")
    new = chunk_documents(good.select(F.col("file").alias("file_name"), "text"), **chunking)
    if chunks is not None:
        current = named.select(F.col("file").alias("file_name")).distinct()
        kept = chunks.join(good.select(F.col("file").alias("file_name")), "file_name", "left_anti").join(current, "file_name", "left_semi")
        new = kept.select(new.columns).unionByName(new)
    error = F.when(~F.col("_readable"), F.lit(UNREADABLE))
    done = F.when(F.col("_readable"), F.array("file")).otherwise(F.array().cast("array<string>"))
    events = todo.select(
        "file", "checksum", F.current_timestamp().alias("processed_at"),
        F.when(F.col("_readable"), "complete").otherwise("failed").alias("status"),
        F.when(F.col("_readable"), F.lit(1)).alias("step"), error.alias("error"), done.alias("output_files"))
    errors = todo.where("not _readable").select("file", F.lit(1).alias("step"), F.lit(UNREADABLE).alias("error"),
                                                F.current_timestamp().alias("timestamp"), F.lit(0).alias("retries"))
    return Refresh(new, events, errors)
