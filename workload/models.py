"""Model calls with stand-in models that compute their answer from the text."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from lorefield.functions.encoders import HashingEncoder
from lorefield.operators import generation as G
from lorefield.operators.evaluation import score_summary
from lorefield.operators.search import retrieve
from lorefield.plans.dataset import corpus_to_qa
from lorefield.plans.ingest import ingest_rows, ingest_table, reembed
from lorefield.session import scratch_path
from workload.base import doc_collection, documents, load, markdown, query, texts
from workload.chunks import SHAPED_CHUNKS_SQL, shaped

DIM = 64

HASHED = """WITH w AS (SELECT {key}, unnest(regexp_split_to_array(lower(trim({text}, chr(32)||chr(10)||chr(9)||chr(13))), '\\s+')) AS word FROM {table}),
 b AS (SELECT {key}, (('0x'||substr(md5(word), 1, 8))::BIGINT % 64)::INTEGER AS bucket, count(*)::DOUBLE AS n FROM w WHERE word <> '' GROUP BY 1, 2),
 e AS (SELECT {key}, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS value FROM b)"""


@query("embed_texts", HASHED.format(key="doc_id", text="text", table="documents") + " SELECT doc_id, bucket, round(value::FLOAT::DOUBLE, 4) AS value FROM e")
def _(spark, d):
    out = G.embed_texts(texts(spark, d).select("doc_id", "text"), "text", HashingEncoder(DIM))
    cells = out.select("doc_id", F.posexplode("embedding").alias("bucket", "v")).where("v > 0")
    return cells.select("doc_id", "bucket", F.round(F.col("v").cast("double"), 4).alias("value"))


# The second run over the store encodes nothing: its encoder cannot.
@query("embed_texts_stored", HASHED.format(key="doc_id", text="text", table="documents") + " SELECT doc_id, bucket, round(value::FLOAT::DOUBLE, 4) AS value FROM e")
def _(spark, d):
    rows, store = texts(spark, d).select("doc_id", "text"), scratch_path(spark, "vectors")
    G.embed_texts(rows, "text", HashingEncoder(DIM), store=store)
    out = G.embed_texts(rows, "text", no_model, store=store)
    cells = out.select("doc_id", F.posexplode("embedding").alias("bucket", "v")).where("v > 0")
    return cells.select("doc_id", "bucket", F.round(F.col("v").cast("double"), 4).alias("value"))


def no_model(texts):
    raise RuntimeError("asked again")


def pair_model(texts):
    """Two sentences as a pair; a text with a marked length gets no pair."""
    return [f"- question: What is {len(t)}?\n- answer: {t.strip()[:40]} and so on" if len(t) % 5 else "no idea" for t in texts]


@query("generate", """SELECT conv_id, turn, CASE WHEN length(text) % 5 <> 0 THEN 'What is '||length(text)||'?' ELSE '' END AS question,
 2 AS calls, 0 AS retries FROM conversations""")
def _(spark, d):
    out = G.generate(load(spark, d, "conversations"), "text", pair_model, rounds=2, delay=0.0)
    return out.select("conv_id", "turn", "question", "calls", "retries")


@query("generate_stored", """SELECT conv_id, turn, CASE WHEN length(text) % 5 <> 0 THEN 'What is '||length(text)||'?' ELSE '' END AS question,
 2 AS calls, 0 AS retries FROM conversations""")
def _(spark, d):
    rows, store = load(spark, d, "conversations"), scratch_path(spark, "answers")
    G.generate(rows.where("turn % 2 = 0"), "text", pair_model, rounds=2, delay=0.0, store=store)
    out = G.generate(rows, "text", pair_model, rounds=2, delay=0.0, store=store)
    return out.select("conv_id", "turn", "question", "calls", "retries")


@query("best_of_rounds", """WITH r AS (SELECT conv_id, turn AS round, CASE WHEN turn % 4 < 3 THEN 'Why '||turn||'?' END AS q, trim(regexp_replace(text, '[^A-Za-z .,]', ' ', 'g')) AS a FROM conversations)
 SELECT conv_id, coalesce(arg_max(q, (length(q) + length(a)) * 1000 - round) FILTER (q IS NOT NULL), '') AS question,
 coalesce(arg_max(a, (length(q) + length(a)) * 1000 - round) FILTER (q IS NOT NULL), '') AS answer FROM r GROUP BY conv_id""")
def _(spark, d):
    t = F.regexp_replace("text", "[^A-Za-z .,]", " ")
    response = F.when(F.col("turn") % 4 < 3, F.concat(F.lit("- question: Why "), F.col("turn").cast("string"), F.lit("?\n- answer: "), t)).otherwise(t)
    rounds = load(spark, d, "conversations").select("conv_id", F.col("turn").alias("round"), response.alias("response"))
    return G.best_of_rounds(rounds, "conv_id")


def echo_model(requests):
    """The answer names the length of the query; queries of some lengths fail."""
    out = []
    for r in requests:
        if len(r["query"]) % 7 == 0:
            raise RuntimeError("unavailable")
        out.append(json.dumps({"answer": f"{r['inputs']['role']} {len(r['query'])}"}))
    return out


@query("run_model_test", """SELECT conv_id, turn, CASE WHEN length(text) % 7 = 0 THEN '处理失败: unavailable' ELSE role||' '||length(text) END AS model_output,
 'echo' AS workflow_name FROM conversations""")
def _(spark, d):
    data = load(spark, d, "conversations").withColumnRenamed("text", "input")
    out = G.run_model_test(data, echo_model, "echo", retries=1, delay=0.0)
    return out.select("conv_id", "turn", "model_output", "workflow_name")


RULE = {"model_config": {"name": "stub", "temperature": 0.5}, "evaluation_rule": {
    "name": "length", "prompt": {"role": {"description": "Input: {{input}} Output: {{generated_output}}"}}}}


def length_judge(prompts):
    return [f'```json\n{{"score": {len(p) % 11}, "reason": "n={len(p)}"}}\n```' for p in prompts]


JUDGED = "SELECT conv_id, turn, role, ((length(text) + length(role) + 16) % 11)::DOUBLE AS evaluation_score, 'n='||(length(text) + length(role) + 16) AS evaluation_reason, 'length' AS evaluation_rule FROM conversations"


def _judged(spark, d):
    results = load(spark, d, "conversations").select("conv_id", "turn", "role", F.col("text").alias("input"), F.col("role").alias("model_output"))
    return G.judge(results, RULE, length_judge).select("conv_id", "turn", "role", "evaluation_score", "evaluation_reason", "evaluation_rule")


@query("judge", JUDGED)
def _(spark, d):
    return _judged(spark, d)


@query("score_summary", f"""SELECT role, round(avg(evaluation_score), 6) AS avg_score, max(evaluation_score) AS max_score, min(evaluation_score) AS min_score,
 count(*) AS total_records FROM ({JUDGED}) GROUP BY role""")
def _(spark, d):
    return score_summary(_judged(spark, d), "role").withColumn("avg_score", F.round("avg_score", 6))


@query("ingest_table", """SELECT 'docs' AS collection_name, count(*) AS total_records, count(*) AS inserted_records FROM documents""")
def _(spark, d):
    df = texts(spark, d)
    out = ingest_table(spark, df, "{text}", "{lang}: {text}", HashingEncoder(DIM), f"ingest_{uuid.uuid4().hex[:12]}",
                       "documents.parquet", scratch_path(spark, "ingest"))
    return out.withColumn("collection_name", F.lit("docs"))


@query("ingest_rows", """SELECT text AS title, trim(lang||': '||text, chr(32)||chr(10)||chr(9)||chr(13)) AS document, source, 'documents.parquet' AS source_file FROM documents""")
def _(spark, d):
    rows = ingest_rows(texts(spark, d), "{text}", "{lang}: {text}", HashingEncoder(DIM), "documents.parquet")
    meta = F.col("metadata")
    return rows.select(meta["text"].alias("title"), "document", meta["source"].alias("source"), meta["source_file"].alias("source_file"))


# Two runs over the same rows give the same ids.
@query("ingest_ids_stable", "SELECT count(*) AS n_rows, count(*) AS n_common, count(*) AS n_ids FROM documents")
def _(spark, d):
    rows = documents(spark, d).select("text", "lang")
    first, again = (ingest_rows(rows, "{text}", "{lang}: {text}", HashingEncoder(DIM), name).select("id").alias(a)
                    for name, a in (("one.csv", "a"), ("two.csv", "b")))
    both = first.join(again, F.col("a.id") == F.col("b.id"), "full_outer")
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("a.id").isNotNull() & F.col("b.id").isNotNull()).alias("n_common"),
                    F.count_distinct("a.id").alias("n_ids"))


@query("reembed", HASHED.format(key="doc_id", text="lang||' '||source", table="documents") + " SELECT doc_id, bucket, round(value::FLOAT::DOUBLE, 4) AS value FROM e")
def _(spark, d):
    updates = doc_collection(spark, d).withColumn("embedding", F.array(F.lit(0.0).cast("float")))
    out = reembed(updates, HashingEncoder(DIM), "{lang} {source}")
    cells = out.select(F.col("id").cast("bigint").alias("doc_id"), F.posexplode("embedding").alias("bucket", "v")).where("v > 0")
    return cells.select("doc_id", "bucket", F.round(F.col("v").cast("double"), 4).alias("value"))


@query("retrieve_texts", HASHED.format(key="doc_id", text="text", table="documents") +
       ", " + HASHED.format(key="item_id", text="text", table="benchmark")[5:].replace("w AS", "qw AS").replace("b AS", "qb AS").replace("e AS", "qe AS").replace("FROM w ", "FROM qw ").replace("FROM b)", "FROM qb)") +
       """, s AS (SELECT item_id AS query_id, doc_id::VARCHAR AS id, sum(e.value * qe.value) AS score FROM e JOIN qe ON e.bucket = qe.bucket GROUP BY 1, 2)
, r AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id)::INTEGER AS rank FROM s)
 SELECT query_id, rank, id, round(score, 4) + 0.0 AS score FROM r WHERE rank <= 5""")
def _(spark, d):
    c = ingest_rows(texts(spark, d).withColumn("id", F.col("doc_id").cast("string")), "{text}", "{text}", HashingEncoder(DIM), "documents.parquet")
    queries = G.embed_texts(load(spark, d, "benchmark"), "text", HashingEncoder(DIM)).withColumnRenamed("item_id", "query_id")
    return retrieve(c, queries, 5).select("query_id", "rank", "id", (F.round("score", 4) + F.lit(0.0)).alias("score"))


@query("corpus_to_qa")
def _(spark, d):
    docs = markdown(texts(spark, d)).select("file_name", F.col("md").alias("text"))
    return corpus_to_qa(docs, pair_model, rounds=2, delay=0.0, strategy="recursive", size=350, overlap=0, minimum=100)


def heading_model(prompts):
    """The end of the prompt's text as a pair; texts that end with padding get no pair."""
    asked = (p.split("\nText: ", 1)[-1].rsplit("\n\nReply", 1)[0] for p in prompts)
    return [f"- question: What is {len(t)}?\n- answer: {t[-60:]}" if t[-1] != "x" else "no idea" for t in asked]


@query("corpus_to_qa_shaped", SHAPED_CHUNKS_SQL + """ SELECT doc_id, chunk_no, text, position, CASE WHEN right(text, 1) = 'x' THEN '' ELSE right(text, 60) END AS answer,
 right(text, 1) <> 'x' AS valid FROM chunks""")
def _(spark, d):
    docs = shaped(spark, d).select("doc_id", "file_name", F.col("md").alias("text"))
    out = corpus_to_qa(docs, heading_model, rounds=2, delay=0.0, strategy="recursive", size=350, overlap=0, minimum=100)
    return out.select("doc_id", "chunk_no", "text", "position", "answer", "valid")
