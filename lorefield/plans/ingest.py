"""From an uploaded table to collection rows, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorefield.functions.templates import check_template, render_template
from lorefield.operators.collections import to_collection, with_ids
from lorefield.operators.generation import Model, embed, embed_texts
from lorefield.sources.collections import append_collection


def ingest_rows(df: DataFrame, embedding_template: str, document_template: str, encoder: Model,
                source_file: str, id_salt: str = "", **options) -> DataFrame:
    """Collection rows of a table: rendered texts, vectors, metadata, source and time.

    Templates are checked against the columns before any job runs. With the
    option ``store`` equal rendered texts are encoded once, over runs too.
    """
    for template in (embedding_template, document_template):
        check_template(template, df.columns)
    # Ids come from the uploaded columns alone, so they are the same in every run.
    df = with_ids(df, id_salt)
    texts = df.withColumn("_embed", render_template(df, embedding_template)).withColumn(
        "document", render_template(df, document_template))
    rows = (embed_texts(texts, "_embed", encoder, **options).drop("_embed")
            .withColumn("source_file", F.lit(source_file))
            .withColumn("upload_time", F.unix_micros(F.current_timestamp()) / 1e6))
    return to_collection(rows)


def ingest_table(spark: SparkSession, df: DataFrame, embedding_template: str, document_template: str,
                 encoder: Model, name: str, source_file: str = "", path: str | None = None, **options) -> DataFrame:
    """Append a table to a collection with one write; returns ``total_records, inserted_records``.

    Rows are counted while they are written, not by a second pass.
    """
    from pyspark.sql import Observation

    read, written = Observation("read"), Observation("written")
    count = F.count(F.lit(1)).alias("n")
    rows = ingest_rows(df.observe(read, count), embedding_template, document_template, encoder, source_file, **options)
    append_collection(rows.observe(written, count), name, path)
    return spark.createDataFrame([(name, read.get["n"], written.get["n"])],
                                 "collection_name string, total_records bigint, inserted_records bigint")


def reembed(updates: DataFrame, encoder: Model, template: str | None = None, **options) -> DataFrame:
    """Updates with fresh vectors, of a template over the metadata or of the document itself."""
    if template is None:
        text = F.col("document")
    else:
        from lorefield.functions.templates import template_fields
        fields = list(dict.fromkeys(template_fields(template)))
        flat = updates.select("*", *[F.col("metadata")[f].alias(f) for f in fields if f not in updates.columns])
        return flat.withColumn("embedding", embed(render_template(flat, template), encoder, **options)).select(
            *dict.fromkeys([*updates.columns, "embedding"]))
    return updates.withColumn("embedding", embed(text, encoder, **options))
