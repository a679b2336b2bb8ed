"""Reading, changing and describing collections.

A collection is a table ``id, document, embedding, metadata`` with one vector
size and text metadata. Changes return a new snapshot; write it to a new place
and switch, never over the files being read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lorefield.functions.records import SYSTEM_FIELDS, VECTOR_FIELDS, coerce_metadata, fallback_document
from lorefield.functions.strings import plain_text
from lorefield.functions.templates import clean_values
from lorefield.session import scratch_path

# Columns an export leaves out.
EXPORT_SKIPS = ("id", "upload_time", *VECTOR_FIELDS)


#: Rows before a page's end up to which a sorted prefix is taken.
DEEP = 100_000


def to_collection(df: DataFrame) -> DataFrame:
    """Canonical form of a flat table.

    ``embedding`` may be called ``dense_vector``; a missing ``id`` is derived from
    the whole row (see ``with_ids``); a missing ``document`` is built from the
    text columns.
    """
    vector = next((c for c in VECTOR_FIELDS if c in df.columns), None)
    if vector is None:
        raise ValueError("the data has neither an 'embedding' nor a 'dense_vector' column")
    df = with_ids(df)
    row_id = F.col("id").cast("string")
    document = F.col("document") if "document" in df.columns else fallback_document(df)
    return df.select(row_id.alias("id"), document.alias("document"),
                     F.col(vector).cast("array<float>").alias("embedding"),
                     coerce_metadata(df).alias("metadata"))


def with_ids(df: DataFrame, salt: str = "") -> DataFrame:
    """``df`` with an ``id``; a missing one is a digest of the row and of ``salt``.

    A repeated run over the same rows gives the same ids. Equal rows keep their
    own: the second is ``<digest>-1`` and so on. Only a table with equal rows is
    stored for that: its rows are numbered within the task that read them and
    then by one row per digest and task, so a row that is repeated very often is
    not gathered anywhere.
    """
    if "id" in df.columns:
        return df
    columns = [F.col(f"`{c}`") for c in df.columns]
    digest = F.sha2(F.concat(F.lit(salt), F.to_json(F.struct(*columns))), 256)
    if df.groupBy(digest.alias("_digest")).count().where("count > 1").isEmpty():
        return df.select(digest.alias("id"), *columns)
    path = scratch_path(df.sparkSession, "equal-rows")
    df.select(*columns, digest.alias("_digest"), F.spark_partition_id().alias("_task"),
              F.monotonically_increasing_id().alias("_turn")).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    counts = rows.groupBy("_digest", "_task").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_digest").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_digest", "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_digest", "_task").orderBy("_turn")) - 1
    number = F.col("_start") + F.col("_place")
    return rows.withColumn("_place", place).join(starts, ["_digest", "_task"]).select(
        F.when(number == 0, F.col("_digest")).otherwise(F.concat_ws("-", "_digest", number.cast("string"))).alias("id"), *columns)


def flatten(collection: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Metadata entries as columns; system columns are never overwritten."""
    extra = [F.col("metadata")[f].alias(f) for f in fields if f not in SYSTEM_FIELDS]
    return collection.select(*[c for c in collection.columns if c != "metadata"], *extra)


def metadata_fields(collection: DataFrame) -> DataFrame:
    """All metadata keys in use, one row each.

    Distinct keys are formed per task first, so only the few keys are shuffled.
    """
    return collection.select(F.explode(F.map_keys("metadata")).alias("field")).distinct()


def scan(collection: DataFrame, limit: int | None = None, ordered: bool = True) -> DataFrame:
    """All rows, or the first ``limit``; by id when ``ordered``."""
    rows = collection.orderBy("id") if ordered else collection
    return rows if limit is None else rows.limit(limit)


def lookup_ids(collection: DataFrame, ids: DataFrame | Sequence[str]) -> DataFrame:
    """Rows with the given ids; unknown ids are silently absent."""
    if isinstance(ids, DataFrame):
        return collection.join(ids.select("id"), "id", "left_semi")
    return collection.where(F.col("id").isin(list(ids)))


def update_rows(collection: DataFrame, updates: DataFrame) -> DataFrame:
    """New snapshot with the given values; unknown ids are skipped.

    ``updates`` has one row per id and any of ``document, embedding, metadata``;
    null leaves the old value, metadata is replaced as a whole.
    """
    fields = [c for c in ("document", "embedding", "metadata") if c in updates.columns]
    new = updates.select("id", *[F.col(c).alias(f"_new_{c}") for c in fields])
    value = lambda c: F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in fields else F.col(c)
    return collection.join(new, "id", "left").select(*[value(c) for c in collection.columns])


def delete_rows(collection: DataFrame, ids: DataFrame) -> DataFrame:
    """New snapshot without the given ids."""
    return collection.join(ids.select("id"), "id", "left_anti")


def collection_stats(collection: DataFrame, name: str) -> DataFrame:
    """Row count and vector sizes."""
    return collection.agg(F.count(F.lit(1)).alias("row_count"), F.max(F.size("embedding")).alias("dimension"),
                          F.count_distinct(F.size("embedding")).alias("n_dimensions")).select(
        F.lit(name).alias("name"), "row_count", "dimension", "n_dimensions")


def page(collection: DataFrame, number: int, size: int, order: str = "id", deep: int = DEEP) -> DataFrame:
    """One page without vectors, by a unique ``order``.

    Near the start each task keeps only the rows up to the page's end; beyond
    ``deep`` rows the positions of all rows are found by ranges instead, so no
    task gathers what lies before the page. Both give the same page.
    """
    if number < 1 or size < 1:
        raise ValueError("page number and size start at 1")
    rows, start = collection.drop(*VECTOR_FIELDS), (number - 1) * size
    if start + size <= deep:
        return rows.orderBy(order).offset(start).limit(size)
    placed = order_id(rows, order, "_place")
    return placed.where(F.col("_place").between(start, start + size - 1)).orderBy(order).drop("_place")


def page_after(collection: DataFrame, last_id, size: int, order: str = "id") -> DataFrame:
    """The page after a known id: as cheap at the end of a table as at its start."""
    return collection.drop(*VECTOR_FIELDS).where(F.col(order) > last_id).orderBy(order).limit(size)


def page_counts(collection: DataFrame, size: int) -> DataFrame:
    """Total rows and pages; an empty table has one page."""
    return collection.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.greatest(F.lit(1), F.ceil(F.col("total") / size)).cast("bigint").alias("pages"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows as display text, infinities as symbols."""
    return clean_values(df.limit(n), infinity="symbol")


def preview_counts(df: DataFrame, n: int = 5) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", F.least(F.col("total_rows"), F.lit(n)).cast("bigint").alias("preview_rows"),
        F.lit(len(df.columns)).alias("n_columns"))


def export_rows(flat: DataFrame) -> DataFrame:
    """Everything but ids, upload times and vectors, as text with null as ''."""
    names = [c for c in flat.columns if c not in EXPORT_SKIPS]
    return flat.select(*[F.coalesce(plain_text(flat, c), F.lit("")).alias(c) for c in names])


def order_id(df: DataFrame, key: str = "id", out: str = "order_id", parts: int | None = None) -> DataFrame:
    """0-based position of each row by a unique key, without a single-task sort.

    Keys are cut into ranges at sampled quantiles; a row's position is the
    number of rows in earlier ranges plus its place in its own range. The cuts
    only balance the work, the result is exact for any cuts.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = _cuts(df, key, parts)
    if not cuts:
        return df.withColumn(out, (F.row_number().over(Window.orderBy(key)) - 1).cast("bigint"))
    kind = df.schema[key].dataType
    # Two levels of cuts, so a row is compared with few of them.
    width = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    literal = lambda values: F.array(*[F.lit(v).cast(kind) for v in values])
    heads, fine = literal([g[0] for g in groups]), F.array(*[literal(g) for g in groups])
    group = F.size(F.filter(heads, lambda c: c <= F.col(key)))
    inner = F.size(F.filter(F.get(fine, group - 1), lambda c: c <= F.col(key)))
    ranged = df.withColumn("_range", F.when(group == 0, F.lit(0)).otherwise((group - 1) * width + inner))
    # One row per range, and the number of ranges is fixed above.
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    return (ranged.withColumn("_place", place).join(F.broadcast(starts), "_range")
            .withColumn(out, (F.col("_start") + F.col("_place")).cast("bigint"))
            .drop("_range", "_start", "_place"))


def _cuts(df: DataFrame, key: str, parts: int) -> list:
    """At most ``parts - 1`` increasing key values that split the rows about evenly."""
    wanted = 40 * parts
    rows = df.count()
    if rows <= 10_000 or parts < 2:
        return []
    keys = df.select(key)
    # The fraction bounds the sample; a limit would take it from the first partitions only.
    sample = keys.sample(min(1.0, wanted / rows), seed=7) if rows > wanted else keys
    values = sorted(r[0] for r in sample.collect() if r[0] is not None)
    step = max(1, len(values) // parts)
    return sorted(set(values[step::step]))[:parts - 1]
