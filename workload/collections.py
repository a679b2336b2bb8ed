"""Collections made of the documents and embeddings tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lorefield.functions.conditions import metadata_filter
from lorefield.operators import collections as C
from lorefield.operators.shredded import shred, shredded_filter, unshred
from lorefield.session import scratch_path
from lorefield.sources import bucketed, collections as store
from lorefield.sources import tables
from workload.base import doc_collection, documents, embeddings, load, query


def _vectors(spark, d):
    return embeddings(spark, d).withColumn("document", F.concat(F.lit("v"), "id")).withColumn("none", F.lit(None).cast("string"))


@query("append_collection", """SELECT vec_id::VARCHAR AS id, 'v'||vec_id AS document, label::VARCHAR AS label, '' AS missing, round(embedding[1]::DOUBLE, 6) + 0.0 AS first FROM embeddings
 UNION ALL SELECT 'x'||vec_id, 'v'||vec_id, label::VARCHAR, '', round(embedding[1]::DOUBLE, 6) + 0.0 FROM embeddings""")
def _(spark, d):
    name, path = f"coll_{uuid.uuid4().hex[:12]}", scratch_path(spark, "collection")
    rows = _vectors(spark, d)
    store.create_collection(rows, name, path)
    again = rows.withColumn("id", F.concat(F.lit("x"), "id")).withColumnRenamed("embedding", "dense_vector")
    store.append_collection(again, name, path)
    stored = store.scan_collection(spark, name, limit=None, ordered=False)
    out = stored.select("id", "document", F.col("metadata")["label"].alias("label"), F.col("metadata")["none"].alias("missing"),
                        (F.round(F.col("embedding")[0].cast("double"), 6) + F.lit(0.0)).alias("first"))
    kept = spark.read.parquet(path)
    assert store.has_collection(spark, name) and name in store.list_collections(spark) and kept.columns == stored.columns
    return out


@query("scan_collection", """SELECT doc_id::VARCHAR AS id, text AS document, lang, source FROM documents""")
def _(spark, d):
    return C.scan(C.flatten(doc_collection(spark, d), ["lang", "source", "id"]))


@query("scan_collection_first", """SELECT doc_id::VARCHAR AS id, text AS document, lang, source FROM documents ORDER BY doc_id::VARCHAR LIMIT 150""")
def _(spark, d):
    return C.scan(C.flatten(doc_collection(spark, d), ["lang", "source", "id"]), 150)


# Every row twice and without an id: each keeps its own.
@query("equal_rows_keep_ids", "SELECT text AS document, (count(*) * 2)::BIGINT AS n_rows, (count(*) * 2)::BIGINT AS n_ids FROM documents GROUP BY text")
def _(spark, d):
    df = documents(spark, d).select(F.col("text").alias("document"), F.array(F.lit(1.0)).alias("embedding"))
    return C.to_collection(df.unionByName(df)).groupBy("document").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"))


@query("derived_ids", "SELECT doc_id::VARCHAR AS doc_id, 1::BIGINT AS n, 'text: '||text||' | lang: '||lang AS document FROM documents")
def _(spark, d):
    df = documents(spark, d).select("text", "lang", "doc_id", F.array(F.lit(1.0)).alias("embedding"))
    return C.to_collection(df).groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.min("document").alias("document"), F.min(F.col("metadata")["doc_id"]).alias("doc_id")).drop("id")


@query("export_collection", "SELECT text AS document, lang, coalesce(n_chars::VARCHAR, '') AS n_chars, '' AS absent FROM documents")
def _(spark, d):
    path = scratch_path(spark, "export")
    store.export_collection(doc_collection(spark, d), ["lang", "n_chars", "absent"], path)
    out = tables.read_table(spark, path, "csv", "document string, lang string, n_chars string, absent string")
    return out.na.fill("")


FILTER = {"logical_operator": "or", "conditions": [
    {"name": ["lang"], "comparison_operator": "is", "value": "DE"},
    {"name": ["source"], "comparison_operator": "end with", "value": "7"},
    {"name": ["n_chars"], "comparison_operator": ">", "value": "9000"}]}


@query("metadata_filter", "SELECT doc_id::VARCHAR AS id FROM documents WHERE lang = 'de' OR source LIKE '%7' OR n_chars > 9000")
def _(spark, d):
    return metadata_filter(doc_collection(spark, d), FILTER).select("id")


@query("metadata_filter_shredded", "SELECT doc_id::VARCHAR AS id, lang, source FROM documents WHERE lang = 'de' OR source LIKE '%7' OR n_chars > 9000")
def _(spark, d):
    path = scratch_path(spark, "shredded")
    shred(doc_collection(spark, d), ["lang", "n_chars", "source"]).write.parquet(path)
    meta = F.col("metadata")
    return unshred(shredded_filter(spark.read.parquet(path), FILTER)).select("id", meta["lang"].alias("lang"), meta["source"].alias("source"))


@query("metadata_filter_columns", "SELECT doc_id FROM documents WHERE lang = 'de' OR source LIKE '%7' OR n_chars > 9000")
def _(spark, d):
    return metadata_filter(documents(spark, d), FILTER, metadata=None).select("doc_id")


@query("metadata_fields", "SELECT unnest(['lang', 'source', 'n_chars']) AS field")
def _(spark, d):
    return C.metadata_fields(doc_collection(spark, d))


@query("lookup_ids", "SELECT doc_id::VARCHAR AS id, text AS document FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def _(spark, d):
    ids = load(spark, d, "labels").where("quality = 1").select(F.col("doc_id").cast("string").alias("id"))
    return C.lookup_ids(doc_collection(spark, d).drop("metadata"), ids)


@query("update_rows", """SELECT d.doc_id::VARCHAR AS id, CASE WHEN quality = 1 THEN 'good '||lang ELSE text END AS document,
 CASE WHEN toxic = 1 THEN 'toxic' ELSE lang END AS lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(spark, d):
    c = doc_collection(spark, d)
    meta = F.create_map(F.lit("lang"), F.lit("toxic"))
    langs = documents(spark, d).select("doc_id", "lang")
    up = load(spark, d, "labels").join(langs, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"), F.when(F.col("quality") == 1, F.concat(F.lit("good "), "lang")).alias("document"),
        F.when(F.col("toxic") == 1, meta).alias("metadata"))
    return C.update_rows(c, up).select("id", "document", F.col("metadata")["lang"].alias("lang"))


@query("delete_rows", "SELECT doc_id::VARCHAR AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def _(spark, d):
    gone = load(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))
    return C.delete_rows(doc_collection(spark, d), gone).select("id")


def _bucketed(spark, d):
    path = scratch_path(spark, "bucketed")
    bucketed.write_buckets(doc_collection(spark, d), path, 16)
    return path


@query("update_buckets", """SELECT d.doc_id::VARCHAR AS id, CASE WHEN quality = 0 AND toxic = 1 THEN 'toxic '||lang ELSE text END AS document, lang
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(spark, d):
    path = _bucketed(spark, d)
    langs = documents(spark, d).select("doc_id", "lang")
    bucketed.update_buckets(spark, path, load(spark, d, "labels").where("quality = 0 AND toxic = 1").join(langs, "doc_id").select(
        F.col("doc_id").cast("string").alias("id"), F.concat(F.lit("toxic "), "lang").alias("document")))
    return bucketed.open_buckets(spark, path).select("id", "document", F.col("metadata")["lang"].alias("lang"))


@query("delete_buckets", "SELECT doc_id::VARCHAR AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def _(spark, d):
    path = _bucketed(spark, d)
    bucketed.delete_from_buckets(spark, path, load(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("id")))
    return bucketed.open_buckets(spark, path).select("id")


@query("collection_stats", "SELECT 'vectors' AS name, count(*) AS row_count, max(len(embedding))::INTEGER AS dimension, count(DISTINCT len(embedding)) AS n_dimensions FROM embeddings")
def _(spark, d):
    return C.collection_stats(embeddings(spark, d), "vectors")


@query("page", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def _(spark, d):
    return C.page(load(spark, d, "orders").select("o_orderkey", "o_custkey"), 3, 50, "o_orderkey")


@query("page_deep", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 40 OFFSET 1200")
def _(spark, d):
    return C.page(load(spark, d, "orders").select("o_orderkey", "o_custkey"), 31, 40, "o_orderkey", deep=1000)


@query("page_after", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 50")
def _(spark, d):
    return C.page_after(load(spark, d, "orders").select("o_orderkey", "o_custkey"), 5000, 50, "o_orderkey")


@query("page_counts", "SELECT count(*) AS total, greatest(1, ceil(count(*) / 64.0))::BIGINT AS pages FROM orders")
def _(spark, d):
    return C.page_counts(load(spark, d, "orders"), 64)


@query("preview", "SELECT r_regionkey::VARCHAR AS r_regionkey, r_name FROM region ORDER BY r_regionkey LIMIT 5")
def _(spark, d):
    return C.preview(load(spark, d, "region").select("r_regionkey", "r_name"), 5)


@query("preview_ordered", "SELECT p_partkey::VARCHAR AS p_partkey, p_name FROM part ORDER BY part.p_partkey DESC LIMIT 7")
def _(spark, d):
    return C.preview(load(spark, d, "part").select("p_partkey", "p_name").orderBy(F.desc("p_partkey")), 7)


@query("preview_counts", "SELECT count(*) AS total_rows, least(count(*), 5)::BIGINT AS preview_rows, 5 AS n_columns FROM documents")
def _(spark, d):
    return C.preview_counts(documents(spark, d))
