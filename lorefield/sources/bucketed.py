"""Collections in buckets by id, of which a change rewrites only those it touches.

A collection is a folder of ``bucket=<n>`` partitions; a row's bucket is a hash of
its id. An update or deletion reads and overwrites the buckets of the changed
ids, the others are not opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lorefield.operators.collections import delete_rows, update_rows
from lorefield.session import scratch_path

BUCKETS = 256
_COUNT = "buckets"


def bucket_of(id_: Column | str, buckets: int) -> Column:
    """A null id is in the bucket of the empty text."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(id_).cast("string") if isinstance(id_, str) else id_.cast("string"), F.lit(""))), F.lit(buckets)).cast("int")


def write_buckets(collection: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store a collection under ``path``; choose ``buckets`` for some hundred MB each."""
    rows = collection.withColumn("bucket", bucket_of("id", buckets))
    rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/rows")
    collection.sparkSession.createDataFrame([(buckets,)], f"{_COUNT} int").coalesce(1).write.parquet(f"{path}/about")


def open_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The collection, without the bucket column."""
    return _rows(spark, path).drop("bucket")


def lookup_in_buckets(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """Rows with the given ids; only their buckets are read."""
    wanted = spark.createDataFrame([(i,) for i in ids], "id string")
    return _rows(spark, path).where(F.col("bucket").isin(touched_buckets(spark, path, wanted))).where(F.col("id").isin(ids)).drop("bucket")


def touched_buckets(spark: SparkSession, path: str, ids: DataFrame) -> list[int]:
    """Numbers of the buckets that the ids fall in; at most the number of buckets."""
    buckets = spark.read.parquet(f"{path}/about").first()[_COUNT]
    return sorted(r["bucket"] for r in ids.select(bucket_of("id", buckets).alias("bucket")).distinct().collect())


def update_buckets(spark: SparkSession, path: str, updates: DataFrame) -> list[int]:
    """Apply :func:`lorefield.operators.collections.update_rows` in place; returns the buckets rewritten."""
    return _rewrite(spark, path, updates, lambda rows: update_rows(rows, updates))


def delete_from_buckets(spark: SparkSession, path: str, ids: DataFrame) -> list[int]:
    """Apply :func:`lorefield.operators.collections.delete_rows` in place; returns the buckets rewritten."""
    return _rewrite(spark, path, ids, lambda rows: delete_rows(rows, ids))


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows")


def _rewrite(spark: SparkSession, path: str, changed: DataFrame, change) -> list[int]:
    """Only buckets that hold one of the ids are rewritten.

    The new rows are stored in the scratch folder before a bucket is replaced, so
    a bucket is never read while it is overwritten. A change that is repeated
    after a failure gives the same rows.
    """
    parts = touched_buckets(spark, path, changed)
    near = _rows(spark, path).where(F.col("bucket").isin(parts))
    parts = sorted(r["bucket"] for r in near.join(changed.select("id"), "id", "left_semi").select("bucket").distinct().collect())
    if not parts:
        return []
    staged = scratch_path(spark, "buckets")
    near = near.where(F.col("bucket").isin(parts))
    change(near).select(*near.columns).repartition("bucket").write.parquet(staged)
    new = spark.read.schema(near.schema).parquet(staged)
    new.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{path}/rows")
    # A bucket without a row left is not among the partitions written.
    left = {r["bucket"] for r in new.select("bucket").distinct().collect()}
    for part in (p for p in parts if p not in left):
        _remove(spark, f"{path}/rows/bucket={part}")
    return parts


def _remove(spark: SparkSession, folder: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
