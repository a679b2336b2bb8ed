"""Incremental state, roll-ups and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorefield.operators import reports as R
from lorefield.operators import states as S
from lorefield.operators.chunking import chunk_documents
from lorefield.session import scratch_path
from lorefield.plans.refresh import refresh_chunks
from lorefield.streaming.jobs import incremental_chunks, log_state, streaming_ingest
from workload.base import MD_SQL, documents, load, markdown, query, texts
from workload.chunks import SHAPED_CHUNKS_SQL, shaped

# Long runs of these marks are shortened before chunking.
CLEAN_SQL = r"regexp_replace(regexp_replace(regexp_replace(md, '\*{3,}', '**', 'g'), '-{4,}', '---', 'g'), '={4,}', '===', 'g')"

# The corpus is the documents, its state comes from the labels: quality 1 has
# finished two steps with the content of today, quality 0 failed or is older.
STATE_SQL = """WITH corpus AS (SELECT 'doc'||doc_id AS file, md5(text) AS checksum FROM documents),
 state AS (SELECT 'doc'||l.doc_id AS file, CASE WHEN quality = 1 THEN md5(text) ELSE 'old' END AS checksum,
 CASE WHEN toxic = 1 THEN 'failed' WHEN quality = 1 THEN 'complete' ELSE 'incomplete' END AS status,
 true AS s1, quality = 1 AS s2, false AS s3 FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def corpus(spark, d):
    return documents(spark, d).select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("file"), F.md5("text").alias("checksum"))


def state(spark, d):
    label = load(spark, d, "labels").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("file"), "quality", "toxic")
    good = F.col("quality") == 1
    status = F.when(F.col("toxic") == 1, F.lit("failed")).when(good, F.lit("complete")).otherwise(F.lit("incomplete"))
    return label.join(corpus(spark, d), "file").select(
        "file", F.when(good, F.col("checksum")).otherwise(F.lit("old")).alias("checksum"), status.alias("status"),
        F.lit(True).alias("step1_completed"), good.alias("step2_completed"), F.lit(False).alias("step3_completed"))


@query("classify_files", STATE_SQL + """ SELECT c.file, CASE WHEN s.file IS NULL THEN 'new' WHEN s.checksum = c.checksum THEN 'unchanged' ELSE 'modified' END AS change
 FROM corpus c LEFT JOIN state s ON c.file = s.file""")
def _(spark, d):
    return S.classify_files(corpus(spark, d), state(spark, d)).select("file", "change")


@query("files_to_process", STATE_SQL + """ SELECT c.file FROM corpus c LEFT JOIN state s ON c.file = s.file
 WHERE s.file IS NULL OR s.status IN ('failed', 'incomplete') OR NOT s.s2 OR c.checksum <> s.checksum""")
def _(spark, d):
    return S.files_to_process(corpus(spark, d), state(spark, d), 2).select("file")


@query("ready_for_qa", STATE_SQL + " SELECT c.file FROM corpus c JOIN state s ON c.file = s.file WHERE s1 AND NOT s2")
def _(spark, d):
    return S.ready_for_qa(corpus(spark, d), state(spark, d)).select("file")


@query("ready_for_merge", STATE_SQL + " SELECT bool_and(coalesce(s2, false)) AS ready FROM corpus c LEFT JOIN state s ON c.file = s.file")
def _(spark, d):
    return S.ready_for_merge(corpus(spark, d), state(spark, d))


DONE_SQL = """WITH done AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN NULL WHEN turn % 3 = 1 THEN '' ELSE text END AS question, text AS answer FROM conversations)"""
TURN = ("conv_id", "turn")


def done(spark, d):
    kind = F.col("turn") % 3
    q = F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit("")).otherwise(F.col("text"))
    return load(spark, d, "conversations").select(*TURN, q.alias("question"), F.col("text").alias("answer"))


@query("pending_rows", DONE_SQL + """ SELECT conv_id, turn, role FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM done d
 WHERE d.conv_id = c.conv_id AND d.turn = c.turn AND d.question <> '' AND d.answer <> '')""")
def _(spark, d):
    return S.pending_rows(load(spark, d, "conversations").drop("text"), done(spark, d), TURN)


@query("upsert_results", DONE_SQL + """, new AS (SELECT conv_id, turn + 1 AS turn, role AS question, NULL AS answer FROM conversations)
 SELECT coalesce(n.conv_id, d.conv_id) AS conv_id, coalesce(n.turn, d.turn) AS turn,
 CASE WHEN n.conv_id IS NOT NULL THEN n.question ELSE d.question END AS question, CASE WHEN n.conv_id IS NOT NULL THEN n.answer ELSE d.answer END AS answer
 FROM done d FULL OUTER JOIN new n ON d.conv_id = n.conv_id AND d.turn = n.turn""")
def _(spark, d):
    new = load(spark, d, "conversations").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("question"),
                                                 F.lit(None).cast("string").alias("answer"))
    return S.upsert_results(done(spark, d), new, TURN)


# Events as the log: users are files, event types statuses, values steps.
def event_log(spark, d):
    e = load(spark, d, "events")
    kind = F.col("event_id") % 4
    return e.select(F.concat(F.lit("f"), F.col("user_id").cast("string")).alias("file"), F.col("props").alias("checksum"),
                    F.col("ts").alias("processed_at"), F.col("event_type").alias("status"), kind.cast("int").alias("step"),
                    F.when(kind == 3, F.concat(F.lit("e"), F.col("event_id").cast("string"))).alias("error"),
                    F.array(F.col("event_id").cast("string")).alias("output_files"))


LOG_SQL = """SELECT 'f'||user_id AS file, arg_max(props, ts) AS checksum, arg_max(event_type, ts) AS status,
 arg_max('e'||event_id, ts) FILTER (event_id % 4 = 3) AS error, bool_or(event_id % 4 = 1) AS step1_completed, bool_or(event_id % 4 = 2) AS step2_completed,
 bool_or(event_id % 4 = 3) AS step3_completed, arg_max(event_id::VARCHAR, ts) AS output_file FROM events GROUP BY user_id"""


def _shown(log):
    return S.current_state(log).select("file", "checksum", "status", "error", "step1_completed", "step2_completed", "step3_completed",
                                       F.col("output_files")[0].alias("output_file"))


@query("current_state", LOG_SQL)
def _(spark, d):
    return _shown(event_log(spark, d))


@query("stream_state_log", LOG_SQL)
def _(spark, d):
    source, base = scratch_path(spark, "log-source"), scratch_path(spark, "log")
    event_log(spark, d).write.parquet(source)
    stream = spark.readStream.schema(event_log(spark, d).schema).parquet(source)
    log_state(stream, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    return _shown(spark.read.parquet(f"{base}/log"))


def errors(spark, d):
    e = load(spark, d, "events")
    return e.select(F.concat(F.lit("f"), F.col("user_id").cast("string")).alias("file"), (F.col("event_id") % 3 + 1).cast("int").alias("step"),
                    F.col("event_type").alias("type"), F.col("props").alias("message"), F.col("ts").alias("timestamp"),
                    (F.col("value") > 10).alias("recovered"), "event_id")


@query("select_errors", "SELECT event_id FROM events WHERE user_id = 8 AND event_id % 3 + 1 = 2")
def _(spark, d):
    return S.select_errors(errors(spark, d), "f8", 2).select("event_id")


@query("clear_errors", "SELECT event_id FROM events WHERE event_id % 3 + 1 <> 2")
def _(spark, d):
    return S.clear_errors(errors(spark, d), step=2).select("event_id")


@query("error_rollup", """SELECT event_type AS type, (event_id % 3 + 1)::INTEGER AS step, count(*) AS total, count(*) FILTER (value > 10) AS recovered_errors,
 count(*) FILTER (NOT value > 10) AS fatal_errors FROM events GROUP BY GROUPING SETS ((event_type), ((event_id % 3 + 1)::INTEGER), ())""")
def _(spark, d):
    return R.error_rollup(errors(spark, d)).drop("level")


@query("last_errors", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def _(spark, d):
    return R.last_errors(errors(spark, d), 10, tie="event_id").select("event_id")


@query("status_rollup", STATE_SQL + """ SELECT count(*) AS total_files, count(*) FILTER (status = 'complete') AS completed_files, count(*) FILTER (status = 'incomplete') AS incomplete_files,
 count(*) FILTER (status = 'failed') AS failed_files, count(*) FILTER (status NOT IN ('complete', 'incomplete', 'failed')) AS not_processed_files FROM state""")
def _(spark, d):
    return R.status_rollup(state(spark, d))


@query("step_rollup", STATE_SQL + """ SELECT 1 AS step, count(*) FILTER (s1) AS completed, count(*) FILTER (NOT s1) AS pending FROM state
 UNION ALL SELECT 2, count(*) FILTER (s2), count(*) FILTER (NOT s2) FROM state UNION ALL SELECT 3, count(*) FILTER (s3), count(*) FILTER (NOT s3) FROM state""")
def _(spark, d):
    return R.step_rollup(state(spark, d))


@query("quality_rate", """SELECT role, count(*) AS total_items, count(*) FILTER (v) AS valid_items, count(*) FILTER (NOT v) AS invalid_items,
 round(100.0 * count(*) FILTER (v) / count(*), 6) AS validation_pass_rate FROM (SELECT role, coalesce(length(trim(q)) >= 5 AND length(trim(text)) >= 10
 AND length(text) <= 50 * length(q), false) AS v FROM (SELECT *, substr(text, 1, (turn * 3)::INTEGER) AS q FROM conversations)) GROUP BY role""")
def _(spark, d):
    pairs = load(spark, d, "conversations").select(
        "role", F.substring("text", F.lit(1), (F.col("turn") * 3).cast("int")).alias("question"), F.col("text").alias("answer"))
    return R.quality_rate(pairs, "role").withColumn("validation_pass_rate", F.round("validation_pass_rate", 6))


@query("throughput", """SELECT event_type, count(*) AS items_processed, round(epoch_us(max(ts))/1e6 - epoch_us(min(ts))/1e6, 3) AS duration_seconds,
 round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) AS items_per_second FROM events GROUP BY event_type""")
def _(spark, d):
    return R.throughput(load(spark, d, "events"), "event_type").withColumns({
        "duration_seconds": F.round("duration_seconds", 3), "items_per_second": F.round("items_per_second", 6)})


@query("step_counts", """SELECT role, count(*) AS rows_processed, count(*) FILTER (turn % 2 = 0 AND text <> '') AS rows_succeeded, count(*) FILTER (NOT (turn % 2 = 0 AND text <> '')) AS rows_failed,
 sum(turn)::BIGINT AS api_calls_made, sum(turn % 3)::BIGINT AS api_retries, sum(length(text))::BIGINT AS total_tokens FROM conversations GROUP BY role""")
def _(spark, d):
    rows = load(spark, d, "conversations").select(
        "role", F.when(F.col("turn") % 2 == 0, F.col("text")).otherwise(F.lit("")).alias("question"), F.col("text").alias("answer"),
        F.col("turn").alias("calls"), (F.col("turn") % 3).alias("retries"), F.length("text").alias("tokens"))
    return R.step_counts(rows, "role")


@query("incremental_chunks")
def _(spark, d):
    source, base = scratch_path(spark, "arriving"), scratch_path(spark, "chunked")
    files = markdown(texts(spark, d)).select("file_name", F.col("md").alias("text"), F.md5("md").alias("checksum"))
    files.write.parquet(source)
    stream = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 4).parquet(source)
    incremental_chunks(stream, f"{base}/chunks", f"{base}/log", f"{base}/checkpoint",
                       strategy="recursive", size=350, overlap=0, minimum=100).awaitTermination()
    return spark.read.parquet(f"{base}/chunks").drop("batch")


@query("incremental_chunks_shaped", SHAPED_CHUNKS_SQL + " SELECT 'doc'||doc_id||'.md' AS file_name, chunk_no, text, img_url, position FROM chunks")
def _(spark, d):
    source, base = scratch_path(spark, "arriving"), scratch_path(spark, "chunked")
    files = shaped(spark, d).select("file_name", F.col("md").alias("text"), F.md5("md").alias("checksum"))
    files.write.parquet(source)
    stream = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 4).parquet(source)
    incremental_chunks(stream, f"{base}/chunks", f"{base}/log", f"{base}/checkpoint",
                       strategy="recursive", size=350, overlap=0, minimum=100).awaitTermination()
    return spark.read.parquet(f"{base}/chunks").select("file_name", "chunk_no", "text", "img_url", "position")


# The stream gives the same chunks as one batch: nothing is left on either side.
@query("incremental_equals_batch", "SELECT 0::BIGINT AS differences, count(*) AS n_files FROM documents")
def _(spark, d):
    source, base = scratch_path(spark, "arriving"), scratch_path(spark, "chunked")
    files = markdown(texts(spark, d)).select("file_name", F.col("md").alias("text"), F.md5("md").alias("checksum"))
    files.write.parquet(source)
    stream = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 3).parquet(source)
    args = dict(strategy="recursive", size=350, overlap=0, minimum=100)
    incremental_chunks(stream, f"{base}/chunks", f"{base}/log", f"{base}/checkpoint", **args).awaitTermination()
    key = ("file_name", "chunk_no")
    digest = lambda df, name: df.select(*key, F.xxhash64("text", "text_pure", "img_url", "position").alias(name))
    both = digest(spark.read.parquet(f"{base}/chunks"), "a").join(
        digest(chunk_documents(spark.read.parquet(source).select("file_name", "text"), **args), "b"), list(key), "full_outer")
    n = S.current_state(spark.read.parquet(f"{base}/log")).where("step1_completed").agg(F.count(F.lit(1)).alias("n"))
    return both.agg(F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differences")).withColumn("n_files", n.scalar())


# Two runs: in the second one every third document has changed, every fifth can no longer be read and every seventh
# is gone. Only these are worked on again, and the chunks are those of the corpus as it can be read.
MD_TRIM = r"regexp_replace({md}, '\s+', '', 'g')"


@query("incremental_modified", f"""WITH d AS (SELECT doc_id, {MD_SQL} AS md FROM documents WHERE doc_id % 7 <> 0),
 now AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 AND doc_id % 5 <> 0 THEN md||'changed' ELSE md END AS md FROM d)
 SELECT 'doc'||doc_id||'.md' AS file_name, length({MD_TRIM.format(md=CLEAN_SQL)})::BIGINT AS n_chars,
 CASE WHEN doc_id % 5 = 0 THEN 'failed' ELSE 'complete' END AS status, (doc_id % 3 = 0 OR doc_id % 5 = 0) AS again,
 CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END::BIGINT AS n_errors FROM now""")
def _(spark, d):
    base = scratch_path(spark, "refreshed")
    args = dict(strategy="recursive", size=350, overlap=0, minimum=100)
    first = markdown(texts(spark, d)).select("doc_id", "file_name", F.col("md").alias("text"))
    changed = F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("changed"))).otherwise(F.col("text"))
    second = first.where("doc_id % 7 <> 0").withColumn("text", changed)
    chunks = None
    for run, files in enumerate((first, second)):
        now = files.select("file_name", "text", F.coalesce(F.md5("text"), F.lit("?")).alias("checksum"))
        log = spark.read.parquet(f"{base}/log-0") if run else spark.createDataFrame([], S.LOG_SCHEMA)
        done = refresh_chunks(now, chunks, S.current_state(log), **args)
        done.chunks.write.parquet(f"{base}/chunks-{run}")
        done.events.write.parquet(f"{base}/log-{run}")
        done.errors.write.parquet(f"{base}/errors-{run}")
        chunks = spark.read.parquet(f"{base}/chunks-{run}")
    log = spark.read.parquet(f"{base}/log-0", f"{base}/log-1")
    sizes = chunks.groupBy("file_name").agg(F.sum(F.length(F.regexp_replace("text", r"\s+", ""))).alias("n_chars"))
    again = log.groupBy(F.col("file").alias("file_name")).agg((F.count(F.lit(1)) > 1).alias("again"))
    errors = spark.read.parquet(f"{base}/errors-1").groupBy(F.col("file").alias("file_name")).agg(F.count(F.lit(1)).alias("n_errors"))
    state = S.current_state(log).select(F.col("file").alias("file_name"), "status")
    return (sizes.join(state, "file_name").join(again, "file_name").join(errors, "file_name", "left")
            .select("file_name", "n_chars", "status", "again", F.coalesce("n_errors", F.lit(0)).cast("bigint").alias("n_errors")))


@query("streaming_ingest", "SELECT vec_id::VARCHAR AS id, 'v'||vec_id AS document, label::VARCHAR AS label FROM embeddings")
def _(spark, d):
    source, base = scratch_path(spark, "vectors"), scratch_path(spark, "ingested")
    rows = load(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.concat(F.lit("v"), "vec_id").alias("document"), "embedding", "label")
    # The copies lie in other files than the rows, so they arrive in other batches.
    rows.write.parquet(source)
    rows.withColumn("document", F.concat(F.lit("v"), "id")).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    streaming_ingest(stream, f"{base}/collection", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/collection").select("id", "document", F.col("metadata")["label"].alias("label"))
