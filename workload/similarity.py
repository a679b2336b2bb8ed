"""Similarity analysis and retrieval over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorefield.functions.vectors import cosine, l2_normalize, norm
from lorefield.operators import evaluation, kept, pruned, search, similarity
from lorefield.operators.collections import order_id
from lorefield.session import scratch_path
from lorefield.sources import matrices
from workload.base import embeddings, load, query

# The matrix of the whole table with itself (A), and of its first 32 dimensions (B).
PAIRS = """
WITH v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT y.id AS y_id, x.id AS x_id, y.label AS y_label, x.label AS x_label,
      round(greatest(0, least(1, list_cosine_similarity(y.e, x.e))), 12) + 0.0 AS a,
      round(greatest(0, least(1, list_cosine_similarity(y.e[1:32], x.e[1:32]))), 12) + 0.0 AS b,
      round(greatest(-1, least(1, list_cosine_similarity(y.e, x.e))), 12) + 0.0 AS s
      FROM v y, v x)
"""
R = "round({0}, 6) + 0.0 AS {0}"
STATS_SQL = """count(*) AS total_pairs, round(avg(a), 6) AS avg_similarity, round(min(a), 6) AS min_similarity,
 round(max(a), 6) AS max_similarity, round(stddev_pop(a), 6) AS std_similarity,
 count(*) FILTER (a > 0.8) AS high_similarity_count, count(*) FILTER (a BETWEEN 0.5 AND 0.8) AS medium_similarity_count,
 count(*) FILTER (a < 0.5) AS low_similarity_count"""


def round6(name):
    """``round(name, 6)`` without a decimal per row: by millionths of a millionth, unless these say that the value may be a tie."""
    parts = F.rint(F.col(name) * 1e12).try_cast("bigint")
    rest = parts % 1000000
    up = F.when(rest > 500000, 1.0).when(rest < -500000, -1.0).otherwise(0.0)
    sure = (F.abs(name) < 1000) & (F.abs(rest) != 500000)
    return F.when(sure, ((parts - rest) / 1000000 + up) / 1e6).otherwise(F.round(name, 6))


def rounded(df, *names):
    return df.select(*[(round6(c) + F.lit(0.0)).alias(c) if c in names else F.col(c) for c in df.columns])


def side_a(spark, d):
    e = embeddings(spark, d)
    return e, e


def side_b(spark, d):
    e = embeddings(spark, d).withColumn("embedding", F.slice("embedding", 1, 32))
    return e, e


def matrix_a(spark, d, **options):
    return similarity.similarity_matrix(*side_a(spark, d), **options)


def matrix_b(spark, d):
    return similarity.similarity_matrix(*side_b(spark, d))


STAT_COLUMNS = ("avg_similarity", "min_similarity", "max_similarity", "std_similarity")


@query("similarity_matrix", PAIRS + "SELECT y_id, x_id, round(a, 6) + 0.0 AS sim FROM p")
def _(spark, d):
    return rounded(matrix_a(spark, d, by_value=True), "sim")


@query("cosine_native", """SELECT vec_id, round(greatest(0, list_cosine_similarity(embedding[1:32]::DOUBLE[],
 embedding[33:64]::DOUBLE[])), 6) + 0.0 AS floored, round(list_cosine_similarity(embedding[1:32]::DOUBLE[],
 embedding[33:64]::DOUBLE[]), 6) + 0.0 AS signed FROM embeddings""")
def _(spark, d):
    a, b = F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)
    return rounded(load(spark, d, "embeddings").select(
        "vec_id", cosine(a, b).alias("floored"), cosine(a, b, floor0=False).alias("signed")), "floored", "signed")


@query("l2_normalize", """SELECT vec_id, round(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)), 6) AS squared,
 round(embedding[1]::DOUBLE / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 6) + 0.0 AS first_part,
 1.0::DOUBLE AS length FROM embeddings""")
def _(spark, d):
    part = F.col("embedding")
    unit = load(spark, d, "embeddings").select("vec_id", (norm(part) * norm(part)).alias("squared"), l2_normalize(part).alias("u"))
    return rounded(unit.select("vec_id", "squared", F.col("u")[0].alias("first_part"), norm("u").alias("length")),
                   "squared", "first_part", "length")


@query("similarity_stats", PAIRS + f"SELECT {STATS_SQL} FROM p")
def _(spark, d):
    return rounded(similarity.collection_similarity(*side_a(spark, d)), *STAT_COLUMNS)


@query("matrix_sweep", PAIRS + """SELECT 'label'||x_label AS x_collection, 'label'||y_label AS y_collection, y_id, x_id,
 round(a, 6) + 0.0 AS sim FROM p WHERE (y_id % 7 = 0) = (x_id % 7 = 0)""")
def _(spark, d):
    # Every seventh row holds shorter vectors: such pairs of different size have no cell.
    e = embeddings(spark, d).select("id", F.concat(F.lit("label"), "label").alias("collection"), F.when(
        F.col("id") % 7 == 0, F.concat("embedding", F.array(F.lit(0.0).cast("float")))).otherwise(F.col("embedding")).alias("embedding"))
    return rounded(similarity.matrix_sweep(e, e, by_value=True), "sim")


@query("sweep_stats", PAIRS + f"""SELECT 'label'||x_label AS x_collection, 'label'||y_label AS y_collection, {STATS_SQL}
 FROM p GROUP BY 1, 2""")
def _(spark, d):
    e = embeddings(spark, d).withColumn("collection", F.concat(F.lit("label"), "label"))
    return rounded(similarity.sweep_stats(e, e), *STAT_COLUMNS)


@query("threshold_mask", PAIRS + "SELECT y_id, x_id, round(a, 6) + 0.0 AS sim FROM p WHERE a BETWEEN 0.2 AND 0.9")
def _(spark, d):
    return rounded(kept.kept_cells(*side_a(spark, d), 0.2, 0.9, by_value=True), "sim")


TOPK = """, rx AS (SELECT *, row_number() OVER (PARTITION BY y_id ORDER BY {0} DESC, x_id) AS rnk_x,
 row_number() OVER (PARTITION BY x_id ORDER BY {0} DESC, y_id) AS rnk_y FROM p)"""


@query("threshold_mask_pruned", PAIRS + "SELECT y_id, x_id, round(a, 6) + 0.0 AS sim FROM p WHERE a BETWEEN 0.2 AND 0.9")
def _(spark, d):
    e = embeddings(spark, d)
    return rounded(pruned.cells_within(pruned.build_index(e), e, 0.2, 0.9, by_value=True), "sim")


@query("topk_mask_x", PAIRS + TOPK.format("a") + "SELECT y_id, x_id, round(a, 6) + 0.0 AS sim FROM rx WHERE rnk_x <= 5")
def _(spark, d):
    return rounded(kept.kept_cells(*side_a(spark, d), k=5), "sim")


@query("topk_mask_y", PAIRS + TOPK.format("a") + "SELECT y_id, x_id, round(a, 6) + 0.0 AS sim FROM rx WHERE rnk_y <= 3")
def _(spark, d):
    return rounded(kept.kept_cells(*side_a(spark, d), k=3, axis="y"), "sim")


@query("similarity_topk", PAIRS + TOPK.format("a") + """SELECT y_id, x_id, round(a, 6) + 0.0 AS sim, rnk_y::INTEGER AS rank
 FROM rx WHERE rnk_y <= 10""")
def _(spark, d):
    e = embeddings(spark, d)
    return rounded(similarity.similarity_topk(e, e, 10, axis="y"), "sim")


@query("mask_and", PAIRS + TOPK.format("a") + "SELECT y_id, x_id FROM rx WHERE rnk_x <= 5 AND a BETWEEN 0.2 AND 0.9")
def _(spark, d):
    return kept.kept_and([kept.kept_cells(*side_a(spark, d), k=5), kept.Range(*side_a(spark, d), 0.2, 0.9)])


@query("mask_or", PAIRS + TOPK.format("a") + "SELECT y_id, x_id FROM rx WHERE rnk_y <= 2 OR b BETWEEN 0.5 AND 1")
def _(spark, d):
    return kept.kept_or([kept.kept_cells(*side_a(spark, d), k=2, axis="y"), kept.kept_cells(*side_b(spark, d), 0.5)])


@query("apply_mask", PAIRS + "SELECT y_id, x_id, round(a, 6) + 0.0 AS sim FROM p WHERE a BETWEEN 0.1 AND 0.6")
def _(spark, d):
    return rounded(kept.kept_cells(*side_a(spark, d), 0.1, 0.6, by_value=True), "sim")


COMPOSED = """, ra AS (SELECT *, row_number() OVER (PARTITION BY y_id ORDER BY a DESC, x_id) AS ax,
 row_number() OVER (PARTITION BY y_id ORDER BY b DESC, x_id) AS bx FROM p) SELECT y_id, x_id FROM ra WHERE """
CONFIGS = {"a": {"low": 0.1, "k": 8}, "b": {"low": 0.2, "high": 0.95, "k": 5}}


@query("compose_mask_filters", PAIRS + COMPOSED +
       "((a BETWEEN 0.1 AND 1 AND ax <= 8) OR (b BETWEEN 0.2 AND 0.95 AND bx <= 5)) AND a BETWEEN 0.15 AND 0.8")
def _(spark, d):
    a, b = side_a(spark, d), side_b(spark, d)
    return kept.compose_kept(a, {"a": a, "b": b}, CONFIGS, filters=["a", "b"], temporary={"low": 0.15, "high": 0.8})


@query("compose_mask_exclusive", PAIRS + COMPOSED + "b BETWEEN 0.2 AND 0.95 AND bx <= 5")
def _(spark, d):
    return kept.compose_kept(side_a(spark, d), {"b": side_b(spark, d)}, CONFIGS, exclusive="b")


@query("compose_mask_default", PAIRS + COMPOSED + "a BETWEEN 0.3 AND 1 AND ax <= 4")
def _(spark, d):
    return kept.compose_kept(side_a(spark, d), default={"low": 0.3, "k": 4})


@query("mask_stats", PAIRS + """, m AS (SELECT *, a BETWEEN 0.3 AND 0.99 AS keep FROM p),
 r AS (SELECT y_id, bool_or(keep) AS any_kept FROM m GROUP BY y_id)
 SELECT (SELECT count(*) FROM m) AS total_count, (SELECT count(*) FROM m WHERE keep) AS display_count,
 (SELECT count(*) FROM m WHERE keep AND y_id = x_id) AS diagonal_kept,
 (SELECT count(*) FROM r) AS diagonal_total, (SELECT count(*) FROM r WHERE NOT any_kept) AS missing_count""")
def _(spark, d):
    return kept.range_stats(*side_a(spark, d), 0.3, 0.99, "x")


@query("matrix_difference", PAIRS + "SELECT y_id, x_id, round(a - b, 6) + 0.0 AS sim FROM p")
def _(spark, d):
    return rounded(evaluation.matrix_difference_of_sides(side_a(spark, d), side_b(spark, d), by_value=True), "sim")


RATIOS = """ SELECT true_positive, true_negative, false_positive, false_negative,
 round(CASE WHEN true_positive + false_negative > 0 THEN true_positive / (true_positive + false_negative)::DOUBLE ELSE 0 END, 6) AS context_recall,
 round(CASE WHEN true_positive + false_positive > 0 THEN true_positive / (true_positive + false_positive)::DOUBLE ELSE 0 END, 6) AS context_precision FROM c"""
COUNTS = """, c AS (SELECT count(*) FILTER (g AND k) AS true_positive, count(*) FILTER (NOT g AND NOT k) AS true_negative,
 count(*) FILTER (NOT g AND k) AS false_positive, count(*) FILTER (g AND NOT k) AS false_negative FROM f)"""


@query("confusion", PAIRS + ", f AS (SELECT a BETWEEN 0.3 AND 1 AS g, b BETWEEN 0.35 AND 1 AS k FROM p)" + COUNTS + RATIOS)
def _(spark, d):
    out = evaluation.confusion_of_ranges(side_a(spark, d), side_b(spark, d), (0.3, 1.0), (0.35, 1.0))
    return rounded(out, "context_recall", "context_precision")


# A temporary range on the difference matrix judges the minuend's mask. Both have every cell, none of which leaves its tile.
@query("difference_confusion", PAIRS + ", f AS (SELECT a BETWEEN 0.3 AND 1 AS g, round(a - b, 12) BETWEEN 0.05 AND 1 AS k FROM p)" + COUNTS + RATIOS)
def _(spark, d):
    out = evaluation.difference_confusion_of_ranges(side_a(spark, d), side_b(spark, d), (0.3, 1.0), (0.05, 1.0))
    return rounded(out, "context_recall", "context_precision")


@query("confusion_topk", PAIRS + """, f AS (SELECT row_number() OVER (PARTITION BY y_id ORDER BY a DESC, x_id) <= 5 AS g,
 row_number() OVER (PARTITION BY y_id ORDER BY b DESC, x_id) <= 5 AS k FROM p)""" + COUNTS + RATIOS)
def _(spark, d):
    e = embeddings(spark, d)
    short = e.withColumn("embedding", F.slice("embedding", 1, 32))
    total = e.agg((F.count(F.lit(1)) * F.count(F.lit(1))).alias("cells"))
    out = evaluation.confusion_from_kept(similarity.similarity_topk(e, e, 5), similarity.similarity_topk(short, short, 5), total)
    return rounded(out, "context_recall", "context_precision")


@query("order_id", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1)::BIGINT AS order_id FROM orders")
def _(spark, d):
    return order_id(load(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("vector_search", PAIRS + """, r AS (SELECT y_id AS query_id, x_id AS id, s AS score,
 row_number() OVER (PARTITION BY y_id ORDER BY s DESC, x_id)::INTEGER AS rank FROM p)
 SELECT query_id, id, round(score, 6) + 0.0 AS score, rank FROM r WHERE rank <= 10""")
def _(spark, d):
    e = embeddings(spark, d)
    return rounded(search.vector_search(e, e.withColumnRenamed("id", "query_id"), 10), "score")


@query("vector_search_pruned", PAIRS + """, r AS (SELECT y_id AS query_id, x_id AS id, s AS score,
 row_number() OVER (PARTITION BY y_id ORDER BY s DESC, x_id)::INTEGER AS rank FROM p)
 SELECT query_id, id, round(score, 6) + 0.0 AS score, rank FROM r WHERE rank <= 10""")
def _(spark, d):
    e = embeddings(spark, d)
    return rounded(pruned.search_index(pruned.build_index(e), e.withColumnRenamed("id", "query_id"), 10), "score")


@query("score_threshold", PAIRS + "SELECT y_id, x_id, round(s, 6) + 0.0 AS score FROM p WHERE s >= 0.25")
def _(spark, d):
    e = embeddings(spark, d)
    cells = similarity.similarity_within(e, e, 0.25, floor0=False, by_value=True).withColumnRenamed("sim", "score")
    return rounded(cells, "score")


CONDITION = {"logical_operator": "and", "conditions": [{"name": ["label"], "comparison_operator": "≥", "value": "3"}]}


def vec_collection(spark, d):
    """Embeddings with their label as metadata; every third has no document, every second no title."""
    e = embeddings(spark, d)
    text = F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("vector "), F.col("id").cast("string")))
    meta = F.create_map(F.lit("label"), F.col("label").cast("string"), F.lit("path"), F.concat(F.lit("a/b/"), F.col("id").cast("string")))
    titled = F.map_concat(meta, F.create_map(F.lit("title"), F.concat(F.lit("T"), F.col("id").cast("string"))))
    return e.select("id", text.alias("document"), "embedding", F.when(F.col("id") % 2 == 0, titled).otherwise(meta).alias("metadata"))


RECORDS = """ SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY rank))::INTEGER AS rank, id,
 CASE WHEN id % 3 = 0 THEN label::VARCHAR ELSE 'vector '||id END AS content,
 round(greatest(0, least(1, score)), 6) + 0.0 AS score, CASE WHEN id % 2 = 0 THEN 'T'||id ELSE id::VARCHAR END AS title
 FROM {0} WHERE score >= 0.1 {1} QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rank) <= 5"""


def _records(df):
    return rounded(df.drop("metadata"), "score")


@query("retrieve", PAIRS + """, r AS (SELECT y_id AS query_id, x_id AS id, x_label AS label, s AS score,
 row_number() OVER (PARTITION BY y_id ORDER BY s DESC, x_id) AS rank FROM p), t AS (SELECT * FROM r WHERE rank <= 10)""" +
       RECORDS.format("t", "AND label >= 3"))
def _(spark, d):
    c = vec_collection(spark, d)
    return _records(search.retrieve(c, embeddings(spark, d).withColumnRenamed("id", "query_id"), 5, 0.1, CONDITION))


@query("retrieve_prefiltered", PAIRS + """, r AS (SELECT y_id AS query_id, x_id AS id, x_label AS label, s AS score,
 row_number() OVER (PARTITION BY y_id ORDER BY s DESC, x_id) AS rank FROM p WHERE x_label >= 3)""" + RECORDS.format("r", ""))
def _(spark, d):
    c = vec_collection(spark, d)
    return _records(search.retrieve(c, embeddings(spark, d).withColumnRenamed("id", "query_id"), 5, 0.1, CONDITION, mode="pre"))


@query("top_items", PAIRS + """, r AS (SELECT y_id AS query_id, row_number() OVER (PARTITION BY y_id ORDER BY s DESC, x_id)::INTEGER AS rank,
 x_id AS id, x_label::VARCHAR AS text, round(s, 6) + 0.0 AS similarity, round(1 - s, 6) + 0.0 AS distance FROM p)
 SELECT * FROM r WHERE rank <= 10""")
def _(spark, d):
    out = search.top_items(vec_collection(spark, d), embeddings(spark, d).withColumnRenamed("id", "query_id"), 10, "label")
    return rounded(out.drop("metadata"), "similarity", "distance")


@query("validate_matrix", """SELECT count(*) AS rows, count(*) AS cols, (count(*) * count(*))::BIGINT AS cells,
 count(*) AS y_items, count(*) AS x_items, true AS valid FROM embeddings""")
def _(spark, d):
    e = embeddings(spark, d)
    return matrices.validate_matrix(similarity.items_within(*side_a(spark, d)), e, e)


@query("export_import_matrix", PAIRS + "SELECT y_id, x_id, round(a, 6) + 0.0 AS sim, 'vectors' AS x_collection, 5 AS top_k FROM p")
def _(spark, d):
    path = scratch_path(spark, "matrix")
    matrices.export_matrix(matrix_a(spark, d, by_value=True), matrices.config_row(spark, "vectors", "vectors", {"top_k": 5}), path)
    cells, config = matrices.import_matrix(spark, path)
    return rounded(cells, "sim").select("*", config.select("x_collection").scalar().alias("x_collection"),
                                        config.select("top_k").scalar().alias("top_k"))


@query("matrix_document", PAIRS + ", o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings) "
       "SELECT y.pos::INTEGER AS y_id, x.pos::INTEGER AS x_id, round(a, 6) + 0.0 AS sim FROM p "
       "JOIN o y ON p.y_id = y.vec_id JOIN o x ON p.x_id = x.vec_id")
def _(spark, d):
    items = embeddings(spark, d).select("id", "label")
    at = matrices.placed(embeddings(spark, d), items)
    rows = similarity.similarity_matrix(at, at, block=matrices.BLOCK)
    doc = matrices.matrix_document(rows, items, items, matrices.config_row(spark, "v", "v"))
    return rounded(matrices.read_matrix_document(doc)[0], "sim")
