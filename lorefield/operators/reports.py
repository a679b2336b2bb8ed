"""Roll-ups of state, errors and quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lorefield.functions.answers import valid_qa
from lorefield.operators.states import STEPS

# The file statuses that are counted by name.
STATUSES = ("complete", "incomplete", "failed")


def status_rollup(state: DataFrame) -> DataFrame:
    """Files by status in one row; any other status counts as not processed."""
    status = F.coalesce(F.col("status"), F.lit("not_processed"))
    return state.agg(
        F.count(F.lit(1)).alias("total_files"), F.count_if(status == "complete").alias("completed_files"),
        F.count_if(status == "incomplete").alias("incomplete_files"),
        F.count_if(status == "failed").alias("failed_files"),
        F.count_if(~status.isin(*STATUSES)).alias("not_processed_files"))


def step_rollup(state: DataFrame) -> DataFrame:
    """``step, completed, pending``."""
    flags = F.array(*[F.struct(F.lit(s).alias("step"), F.coalesce(f"step{s}_completed", F.lit(False)).alias("done"))
                      for s in STEPS])
    return state.select(F.inline(flags)).groupBy("step").agg(
        F.count_if("done").alias("completed"), F.count_if(~F.col("done")).alias("pending"))


def error_rollup(errors: DataFrame) -> DataFrame:
    """Totals, by type and by step, from one pass: ``type, step, total, recovered, fatal``.

    The row with neither type nor step holds the totals.
    """
    recovered = F.coalesce("recovered", F.lit(False))
    return errors.groupingSets([["type"], ["step"], []], "type", "step").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(recovered).alias("recovered_errors"),
        F.count_if(~recovered).alias("fatal_errors"), F.grouping_id().alias("level"))


def last_errors(errors: DataFrame, n: int = 10, at: str = "timestamp", tie: str | None = None) -> DataFrame:
    """The latest errors."""
    return errors.orderBy(F.desc(at), *([F.desc(tie)] if tie else [])).limit(n)


def quality_rate(pairs: DataFrame, *keys: str, valid: Column | None = None) -> DataFrame:
    """Valid and invalid items and the pass rate in percent, 0 without items."""
    held = valid_qa("question", "answer") if valid is None else F.coalesce(valid, F.lit(False))
    aggs = [F.count(F.lit(1)).alias("total_items"), F.count_if(held).alias("valid_items"),
            F.count_if(~held).alias("invalid_items")]
    counts = pairs.groupBy(*keys).agg(*aggs) if keys else pairs.agg(*aggs)
    rate = F.coalesce(F.try_divide(F.col("valid_items"), F.col("total_items")) * 100, F.lit(0.0))
    return counts.withColumn("validation_pass_rate", rate)


def throughput(events: DataFrame, *keys: str, start: str = "ts", end: str | None = None) -> DataFrame:
    """Items, seconds between first start and last end, and items per second (null without duration)."""
    seconds = F.unix_micros(F.max(end or start).cast("timestamp")) - F.unix_micros(F.min(start).cast("timestamp"))
    aggs = [F.count(F.lit(1)).alias("items_processed"), (seconds / 1e6).alias("duration_seconds")]
    rates = events.groupBy(*keys).agg(*aggs) if keys else events.agg(*aggs)
    per = F.when(F.col("duration_seconds") > 0, F.col("items_processed") / F.col("duration_seconds"))
    return rates.withColumn("items_per_second", per)


def step_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """Generation counters: rows, succeeded, failed, calls, retries, tokens.

    Needs ``question, answer, calls, retries, tokens``.
    """
    good = F.coalesce((F.col("question") != "") & (F.col("answer") != ""), F.lit(False))
    aggs = [F.count(F.lit(1)).alias("rows_processed"), F.count_if(good).alias("rows_succeeded"),
            F.count_if(~good).alias("rows_failed"), F.sum("calls").alias("api_calls_made"),
            F.sum("retries").alias("api_retries"), F.sum("tokens").alias("total_tokens")]
    return rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs)


def observed_counts(df: DataFrame, name: str, *aggs: Column):
    """Count while a job runs: returns the observed frame and its ``Observation``."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *(aggs or (F.count(F.lit(1)).alias("rows"),))), seen


def write_report(report: DataFrame, path: str) -> None:
    """A report as JSON lines."""
    report.write.mode("overwrite").json(path)
