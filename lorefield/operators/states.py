"""Incremental work: which rows and files still need which step.

File state is kept as an append-only log with one row per event; the current
state is an aggregate of it. Appending never rewrites what earlier runs wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

STEPS = (1, 2, 3)

# Columns of the log and of the error log.
LOG_SCHEMA = ("file string, checksum string, processed_at timestamp, status string, "
              "step int, error string, output_files array<string>")
ERROR_SCHEMA = "file string, step int, error string, timestamp timestamp, retries int"


def current_state(log: DataFrame) -> DataFrame:
    """One row per file: latest checksum, status and time, last error, step flags ever set.

    Every part is a partial aggregate, so a file with very many events is
    reduced in each task before the shuffle.
    """
    at = F.col("processed_at")
    flag = lambda s: F.coalesce(F.bool_or(F.col("step") == s), F.lit(False)).alias(f"step{s}_completed")
    given = lambda c, held: F.max_by(F.when(held, F.col(c)), F.when(held, at)).alias(c)
    # One struct, so that all parts come from one event when several have the same time.
    latest = F.max(F.struct(at, "step", "status", "checksum"))
    return log.groupBy("file").agg(
        latest.alias("_latest"),
        given("error", F.col("error").isNotNull() & (F.col("error") != "")),
        *[flag(s) for s in STEPS],
        given("output_files", F.size("output_files") > 0)).select(
        "file", "_latest.checksum", "_latest.processed_at", "_latest.status", "error", *[f"step{s}_completed" for s in STEPS], "output_files")


def classify_files(corpus: DataFrame, state: DataFrame) -> DataFrame:
    """Each file of the corpus as ``new``, ``unchanged`` or ``modified``."""
    known = state.select("file", F.col("checksum").alias("_old"), F.col("status").alias("_status"))
    fresh = F.col("_status").isNull() | (F.col("_status") == "not_processed")
    kind = F.when(fresh, F.lit("new")).when(F.col("checksum") == F.col("_old"), F.lit("unchanged")).otherwise(
        F.lit("modified"))
    return corpus.join(known, "file", "left").select(*corpus.columns, kind.alias("change"))


def files_to_process(corpus: DataFrame, state: DataFrame, step: int, check_content: bool = True) -> DataFrame:
    """Files that are new, failed, incomplete, lack the step, or (``check_content``) changed."""
    known = state.select("file", F.col("checksum").alias("_old"), F.col("status").alias("_status"),
                         F.col(f"step{step}_completed").alias("_done"))
    todo = (F.col("_status").isNull() | F.col("_status").isin("failed", "incomplete")
            | ~F.coalesce("_done", F.lit(False)))
    if check_content:
        todo = todo | ~F.col("checksum").eqNullSafe(F.col("_old"))
    return corpus.join(known, "file", "left").where(todo).select(*corpus.columns)


def ready_for_qa(files: DataFrame, state: DataFrame) -> DataFrame:
    """Files with step 1 done and step 2 not."""
    ready = state.where(F.coalesce("step1_completed", F.lit(False)) & ~F.coalesce("step2_completed", F.lit(False)))
    return files.join(ready.select("file"), "file", "left_semi")


def ready_for_merge(files: DataFrame, state: DataFrame) -> DataFrame:
    """One row ``ready``: has every file finished step 2?"""
    done = files.join(state.select("file", "step2_completed"), "file", "left")
    return done.agg(F.coalesce(F.bool_and(F.coalesce("step2_completed", F.lit(False))), F.lit(True)).alias("ready"))


def pending_rows(chunks: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("file_name", "chunk_no"),
                 nonempty: bool = True) -> DataFrame:
    """Chunks without a finished question and answer."""
    finished = done.where(F.col("question").isNotNull() & F.col("answer").isNotNull())
    if nonempty:
        finished = finished.where((F.col("question") != "") & (F.col("answer") != ""))
    return chunks.join(finished.select(*keys), list(keys), "left_anti")


def upsert_results(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("file_name", "chunk_no")) -> DataFrame:
    """New rows replace old ones with the same key as a whole, others are appended."""
    values = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    pick = lambda df: F.struct(*[(F.col(c) if c in df.columns else F.lit(None)).alias(c) for c in values])
    left = old.select(*keys, pick(old).alias("_old"))
    right = new.select(*keys, pick(new).alias("_new"))
    return left.join(right, list(keys), "full_outer").select(*keys, F.coalesce("_new", "_old").alias("_v")).select(
        *keys, "_v.*")


def valid_files(chunks: DataFrame, file: str = "file_name",
                required: tuple[str, ...] = ("text", "text_pure", "img_url", "position")) -> DataFrame:
    """Row count per file of a chunk table that has the required columns."""
    missing = [c for c in required if c not in chunks.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return chunks.groupBy(file).agg(F.count(F.lit(1)).alias("n_chunks"))


def select_errors(errors: DataFrame, file: str | None = None, step: int | None = None) -> DataFrame:
    """Errors of a file and step."""
    return errors.where(_matches(file, step))


def clear_errors(errors: DataFrame, file: str | None = None, step: int | None = None) -> DataFrame:
    """What is left after clearing: by file if given, else by step, else nothing."""
    if file:
        return errors.where(~_matches(file, None))
    return errors.where(~_matches(None, step)) if step else errors.limit(0)


def _matches(file: str | None, step: int | None) -> Column:
    held = F.lit(True)
    if file:
        held = held & F.col("file").eqNullSafe(F.lit(file))
    if step:
        held = held & F.col("step").eqNullSafe(F.lit(step))
    return held
