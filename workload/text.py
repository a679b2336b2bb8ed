"""Scalar functions over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorefield.functions import answers, strings
from lorefield.functions.conditions import condition_column
from lorefield.functions.links import image_urls, mask_links, restore_links
from lorefield.functions.records import (clamp_score, coerce_metadata, fallback_document, record_content, record_title,
                                         resolve_score, strip_system_fields)
from lorefield.functions.templates import clean_values, render_prompt, render_template
from lorefield.session import scratch_path, spread
from lorefield.sources import corpus, html, tables
from workload.base import MD_SQL, documents, load, markdown, query, texts


@query("render_template", """SELECT doc_id, trim('['||source||'] '||lang||': '||text||' ('||n_chars||')', chr(32)||chr(10)||chr(9)||chr(13)) AS rendered
 FROM documents""")
def _(spark, d):
    df = documents(spark, d)
    return df.select("doc_id", render_template(df, "  [{source}] {lang}: {text} ({n_chars}){missing} ").alias("rendered"))


@query("render_prompt", """SELECT conv_id, turn, 'Q: '||text||' / '||role||' / {{unknown}} / '||'' AS prompt FROM conversations""")
def _(spark, d):
    df = load(spark, d, "conversations").withColumnRenamed("text", "input")
    return df.select("conv_id", "turn", render_prompt(df, "Q: {{input}} / {{role}} / {{unknown}} / {{group}}").alias("prompt"))


@query("clean_values", """SELECT event_id::VARCHAR AS event_id, CASE WHEN event_type = 'click' THEN '' ELSE event_type END AS kind,
 CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN '∞' WHEN event_id % 5 = 2 THEN '-∞' ELSE user_id::VARCHAR END AS score FROM events""")
def _(spark, d):
    e = load(spark, d, "events")
    score = (F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).when(F.col("event_id") % 5 == 1, F.lit(float("inf")))
             .when(F.col("event_id") % 5 == 2, F.lit(float("-inf"))).otherwise(F.col("user_id").cast("double")))
    kind = F.when(F.col("event_type") == "click", F.lit("NaN")).otherwise(F.col("event_type"))
    out = clean_values(e.select("event_id", kind.alias("kind"), score.alias("score")), "symbol")
    return out.withColumn("score", F.regexp_replace("score", r"\.0$", ""))


@query("unescape_text", "SELECT doc_id, text||chr(9)||'\"'||chr(39)||chr(13)||chr(10)||text AS plain FROM documents")
def _(spark, d):
    escaped = F.concat(F.regexp_replace("text", "\n", r"\\n"), F.lit("\\t\\\"\\'\\r\\n"), F.col("text"))
    return documents(spark, d).select("doc_id", strings.unescape_text(escaped).alias("plain"))


@query("collapse_markdown_runs", """SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(x, '\\*{3,}', '**', 'g'), '-{4,}', '---', 'g'),
 '={4,}', '===', 'g') AS short FROM (SELECT doc_id, replace(replace(replace(text, ' ', '****'), '.', '-----'), ',', '======') AS x FROM documents)""")
def _(spark, d):
    noisy = F.replace(F.replace(F.replace("text", F.lit(" "), F.lit("****")), F.lit("."), F.lit("-----")), F.lit(","), F.lit("======"))
    return documents(spark, d).select("doc_id", strings.collapse_markdown_runs(noisy).alias("short"))


MASKED = ("'# '||source||chr(10)||chr(10)||'## '||lang||chr(10)||chr(10)||text||chr(10)||chr(10)||'See <'||source||'> and <img1> again "
          "<img1> then <img3> <'||source||'2>'||chr(10)")


@query("mask_links", f"SELECT doc_id, {MASKED} AS masked, '<img1>,<img2>,<img3>,<'||source||'>,<'||source||'2>' AS keys FROM documents")
def _(spark, d):
    out = mask_links(markdown(texts(spark, d)), "md")
    return out.select("doc_id", "masked", F.array_join(F.transform("link_map", lambda e: e["key"]), ",").alias("keys"))


@query("restore_links", f"""SELECT doc_id, {MD_SQL} AS restored,
 'http://a.example/'||lang||'.png;http://a.example/'||lang||'.png;http://b.example/x.png' AS urls FROM documents""")
def _(spark, d):
    out = mask_links(markdown(texts(spark, d)), "md")
    return out.select("doc_id", restore_links("masked", "link_map").alias("restored"), image_urls("masked", "link_map").alias("urls"))


# Responses in the shapes a model endpoint returns, by turn.
RESPONSE_SQL = """WITH c AS (SELECT conv_id, turn, regexp_replace(text, '[^A-Za-z .,]', ' ', 'g') AS t FROM conversations)"""


def plain_turns(spark, d):
    return load(spark, d, "conversations").select("conv_id", "turn", F.regexp_replace("text", "[^A-Za-z .,]", " ").alias("t"))


@query("extract_answer", RESPONSE_SQL + """ SELECT conv_id, turn, CASE turn % 5 WHEN 3 THEN '{"other": "'||t||'"}'
 WHEN 4 THEN 'API调用失败: '||t ELSE t END AS answer FROM c""")
def _(spark, d):
    t = F.col("t")
    shape = lambda a, b: F.concat(F.lit(a), t, F.lit(b))
    kind = F.col("turn") % 5
    response = (F.when(kind == 0, shape('{"answer": "', '"}')).when(kind == 1, shape('{"answer": "", "data": {"answer": "', '"}}'))
                .when(kind == 2, shape('{"choices": [{"message": {"content": "', '"}}]}'))
                .when(kind == 3, shape('{"other": "', '"}')).otherwise(shape('{"error": "', '"}')))
    return plain_turns(spark, d).select("conv_id", "turn", answers.extract_answer(response).alias("answer"))


@query("parse_judgement", RESPONSE_SQL + """ SELECT conv_id, turn, CASE turn % 7 WHEN 5 THEN 0.0 WHEN 6 THEN 0.0 ELSE (length(t) % 11)::DOUBLE END AS score,
 CASE turn % 7 WHEN 3 THEN '未找到具体原因' WHEN 4 THEN '无原因' WHEN 5 THEN '无法解析评测结果: '||substr('no verdict '||t, 1, 100)||'...'
 WHEN 6 THEN '模型无回应' ELSE t END AS reason FROM c""")
def _(spark, d):
    t, n, kind = F.col("t"), (F.length("t") % 11).cast("string"), F.col("turn") % 7
    cat = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    response = (F.when(kind == 0, cat('{"score": ', n, ', "reason": "', t, '"}'))
                .when(kind == 1, cat('Verdict:\n```JSON\n{"score": ', n, ', "reason": "', t, '"}\n```'))
                .when(kind == 2, cat('so {not json} but {"score": ', n, ', "reason": "', t, '", "x": {"y": 1}} ok'))
                .when(kind == 3, cat("score: ", n, " because")).when(kind == 4, cat('{"score": ', n, "}"))
                .when(kind == 5, cat("no verdict ", t)).otherwise(F.lit("")))
    out = plain_turns(spark, d).select("conv_id", "turn", answers.parse_judgement(response).alias("j"))
    return out.select("conv_id", "turn", "j.score", "j.reason")


@query("parse_qa", RESPONSE_SQL + """ SELECT conv_id, turn, CASE WHEN turn % 3 < 2 THEN 'Is '||turn||' it?' END AS question,
 CASE WHEN turn % 3 < 2 THEN trim(t) END AS answer FROM c""")
def _(spark, d):
    pair = F.concat(F.lit("Sure.\n- question: Is "), F.col("turn").cast("string"), F.lit(" it?\n- answer:   "), F.col("t"))
    response = F.when(F.col("turn") % 3 < 2, pair).otherwise(F.concat(F.lit("none "), F.col("t")))
    out = plain_turns(spark, d).select("conv_id", "turn", answers.parse_qa(response).alias("p"))
    return out.select("conv_id", "turn", "p.question", "p.answer")


@query("valid_qa", """SELECT conv_id, turn, length(trim(q)) >= 5 AND length(trim(text)) >= 10 AND length(text) <= 50 * length(q) AS valid
 FROM (SELECT *, substr(text, 1, (turn * 3)::INTEGER) AS q FROM conversations) WHERE q IS NOT NULL""")
def _(spark, d):
    q = F.substring("text", F.lit(1), (F.col("turn") * 3).cast("int"))
    return load(spark, d, "conversations").select("conv_id", "turn", answers.valid_qa(q, "text").alias("valid"))


@query("coerce_metadata", """SELECT doc_id, unnest(['lang', 'source', 'n_chars']) AS key,
 unnest([lang, source, CASE WHEN n_chars % 2 = 0 THEN '' ELSE n_chars::VARCHAR END]) AS value FROM documents""")
def _(spark, d):
    df = documents(spark, d).withColumn("n_chars", F.when(F.col("n_chars") % 2 != 0, F.col("n_chars"))).withColumnRenamed("text", "document")
    return df.select("doc_id", F.explode(coerce_metadata(df, ("doc_id", "document"))).alias("key", "value"))


@query("fallback_document", "SELECT doc_id, 'text: '||text||' | lang: '||lang||' | source: '||source AS document FROM documents")
def _(spark, d):
    df = documents(spark, d)
    return df.select("doc_id", fallback_document(df).alias("document"))


@query("record_fields", """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN text WHEN 2 THEN lang ELSE 'No content available' END AS content,
 CASE doc_id % 4 WHEN 0 THEN source WHEN 1 THEN '' WHEN 2 THEN lang||'.md' ELSE 'Document '||doc_id END AS title FROM documents""")
def _(spark, d):
    kind = F.col("doc_id") % 4
    meta = (F.when(kind == 0, F.create_map(F.lit("title"), F.col("source"), F.lit("filename"), F.lit("f")))
            .when(kind == 1, F.create_map(F.lit("filename"), F.lit(""), F.lit("path"), F.lit("a/b")))
            .when(kind == 2, F.create_map(F.lit("path"), F.concat(F.lit("x/y/"), F.col("lang"), F.lit(".md")), F.lit("l"), F.col("lang")))
            .otherwise(F.create_map().cast("map<string,string>")))
    document = F.when(kind < 2, F.col("text")).otherwise(F.lit(""))
    return documents(spark, d).select("doc_id", record_content(document, meta).alias("content"), record_title(meta, "doc_id").alias("title"))


@query("resolve_score", """SELECT event_id, greatest(0, least(1, coalesce(CASE WHEN event_id % 3 = 0 THEN value / 10 END,
 CASE WHEN event_id % 3 = 1 THEN value / 20 END, 1 - coalesce(CASE WHEN event_id % 2 = 0 THEN value / 5 END, 1.0)))) AS score FROM events""")
def _(spark, d):
    i, v = F.col("event_id"), F.col("value")
    score = resolve_score(F.when(i % 3 == 0, v / 10), F.when(i % 3 == 1, v / 20), F.when(i % 2 == 0, v / 5))
    return load(spark, d, "events").select("event_id", clamp_score(score).alias("score"))


@query("strip_system_fields", "SELECT vec_id AS id, label FROM embeddings")
def _(spark, d):
    return strip_system_fields(load(spark, d, "embeddings").withColumnRenamed("vec_id", "id"))


@query("model_abbreviation", """SELECT p_partkey, coalesce(nullif(concat_ws('-', nullif(regexp_extract(regexp_extract(n, '([^/]*)$', 1), '([a-zA-Z]{1,3})', 1), ''),
 nullif(right(regexp_extract(n, '([0-9.]*[0-9])[^0-9]*$', 1), 3), '')), ''), 'emb') AS short
 FROM (SELECT p_partkey, lower(p_brand)||'/'||replace(p_type, ' ', '-')||'-'||p_size||'.'||(p_partkey % 10)||'b' AS n FROM part)""")
def _(spark, d):
    name = F.concat(F.lower("p_brand"), F.lit("/"), F.replace("p_type", F.lit(" "), F.lit("-")), F.lit("-"),
                    F.col("p_size").cast("string"), F.lit("."), (F.col("p_partkey") % 10).cast("string"), F.lit("b"))
    return load(spark, d, "part").select("p_partkey", strings.model_abbreviation(name).alias("short"))


@query("parse_model_id", """SELECT p_partkey, p_brand AS provider, CASE WHEN p_partkey % 2 = 0 THEN p_type||'/x' ELSE p_type END AS model FROM part""")
def _(spark, d):
    even = F.col("p_partkey") % 2 == 0
    name = F.when(even, F.concat("p_brand", F.lit(" , "), "p_type", F.lit("/x"))).otherwise(F.concat("p_brand", F.lit("/"), "p_type"))
    return load(spark, d, "part").select("p_partkey", strings.parse_model_id(name).alias("m")).select("p_partkey", "m.provider", "m.model")


@query("display_names", """SELECT doc_id, upper(lang[1])||lang[2:]||' '||upper(source[1])||source[2:] AS display, source||' '||lang||'-_9' AS safe FROM documents""")
def _(spark, d):
    raw = F.concat("lang", F.lit("_"), "source")
    odd = F.concat("source", F.lit(" "), "lang", F.lit("-_9?!/:*  "))
    return documents(spark, d).select("doc_id", strings.display_name(raw).alias("display"), strings.safe_name(odd).alias("safe"))


@query("query_kind", """SELECT conv_id, turn, text LIKE '%?' OR regexp_matches(lower(text), 'what|how|where|when|why|who|find|search|query') AS is_query,
 CASE WHEN trim(text) = '' THEN 0 ELSE len(regexp_split_to_array(trim(text, chr(32)||chr(10)||chr(9)||chr(13)), '\\s+')) END::INTEGER AS tokens FROM conversations""")
def _(spark, d):
    return load(spark, d, "conversations").select("conv_id", "turn", strings.is_query("text").alias("is_query"), strings.token_count("text").alias("tokens"))


@query("content_checksum", "SELECT doc_id, md5(text) AS checksum FROM documents")
def _(spark, d):
    return documents(spark, d).select("doc_id", strings.content_checksum("text").alias("checksum"))


CONDITIONS = [
    ("contains", ["lang", "source"], "n src1"), ("not contains", ["source"], "SRC1"), ("start with", ["source"], "Src1"),
    ("end with", ["source"], "9"), ("is", ["lang"], "EN"), ("is not", ["lang"], "en"), ("empty", ["source"], None),
    ("not empty", ["source"], None), ("=", ["n_chars"], "416"), ("≠", ["n_chars"], "416"), (">", ["n_chars"], "1e3"),
    ("<", ["n_chars"], "1000.5"), ("≥", ["n_chars"], "1000"), ("≤", ["lang"], "5"), ("before", ["n_chars"], "3"),
    ("is not", ["absent"], "x"), ("not contains", ["absent"], "x"), ("empty", ["absent"], None),
]


@query("metadata_conditions", """SELECT doc_id, contains(lang||' '||source, 'n src1') AS c0, NOT contains(source, 'src1') AS c1, starts_with(source, 'src1') AS c2,
 ends_with(source, '9') AS c3, lang = 'en' AS c4, lang <> 'en' AS c5, source = '' AS c6, source <> '' AS c7, n_chars = 416 AS c8, n_chars <> 416 AS c9,
 n_chars > 1000 AS c10, n_chars < 1000.5 AS c11, n_chars >= 1000 AS c12, false AS c13, false AS c14, true AS c15, false AS c16, true AS c17 FROM documents""")
def _(spark, d):
    df = documents(spark, d).select("doc_id", F.create_map(
        F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"), F.lit("n_chars"), F.col("n_chars").cast("string")).alias("m"))
    held = [condition_column({"name": n, "comparison_operator": op, "value": v}, lambda f: F.col("m")[f]).alias(f"c{i}")
            for i, (op, n, v) in enumerate(CONDITIONS)]
    return df.select("doc_id", *held)


@query("read_table", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(spark, d):
    path = scratch_path(spark, "table")
    tables.write_table(documents(spark, d), path, "csv")
    return tables.read_table(spark, path, "csv", "doc_id bigint, text string, lang string, source string, n_chars bigint")


def _as_arrays(batches):
    """JSON texts as the lines of one array a task, spread over lines as a printer might."""
    import pyarrow as pa

    first = True
    for b in batches:
        rows = b.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([("[" if first and k == 0 else ",") + r.replace(",", ",\n", 1) for k, r in enumerate(rows)])], names=["value"])
        first = first and not rows
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if first else "]"])], names=["value"])


@query("read_json_arrays", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(spark, d):
    path = scratch_path(spark, "arrays")
    rows = texts(spark, d).select(F.to_json(F.struct("doc_id", "text", "lang", "source", "n_chars")).alias("value"))
    rows.mapInArrow(_as_arrays, "value string").write.text(path)
    return tables.read_table(spark, path, "json", "doc_id bigint, text string, lang string, source string, n_chars bigint", ranges_from=0)


@query("read_corpus", "SELECT source, lang, sum(length(text) + 1)::BIGINT AS n_chars FROM documents GROUP BY 1, 2")
def _(spark, d):
    path = scratch_path(spark, "corpus")
    texts(spark, d).repartition("source", "lang").select("source", "lang", "text").write.partitionBy("source", "lang").text(path)
    files = corpus.read_corpus(spark, path)
    part = lambda name: F.regexp_extract("path", f"{name}=([^/]*)/", 1).alias(name)
    return files.groupBy(part("source"), part("lang")).agg(F.sum(F.length("text")).cast("bigint").alias("n_chars"))


@query("admit_files", """SELECT source, lang, sum(octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS length FROM documents GROUP BY 1, 2
 HAVING sum(octet_length(encode(coalesce(text, ''))) + 1) <= 30000""")
def _(spark, d):
    path, both = scratch_path(spark, "uploads"), documents(spark, d).repartition("source", "lang")
    both.select("source", "lang", "text").write.partitionBy("source", "lang").text(path)
    both.select("source", "lang", "doc_id").write.mode("append").partitionBy("source", "lang").json(path)
    files = corpus.admit_files(spark, path, suffixes=(".txt", ".csv"), max_bytes=30_000)
    part = lambda name: F.regexp_extract("path", f"{name}=([^/]*)/", 1).alias(name)
    return files.select(part("source"), part("lang"), "length")


def _nested(inner: str, *steps: tuple[str, str, str]) -> str:
    """``regexp_replace`` calls around ``inner``, the first step innermost."""
    for pattern, new, flags in steps:
        inner = f"regexp_replace({inner}, '{pattern}', {new}, '{flags}')"
    return inner


_LINE = "chr(10)||chr(10)"
_SHOWN = _nested("html", ("<title[^>]*>.*?</title>", "''", "s"), *((f"<{t}[^>]*>.*?</{t}>", "''", "gs") for t in ("script", "style", "nav")),
                 ("<!--.*?-->", "''", "gs"), (r"\s+", "' '", "g"), ("<br[^>]*>", "chr(10)", "g"), ("<li[^>]*>", "chr(10)||'- '", "g"),
                 ("<h1[^>]*>", _LINE + "||'# '", "g"), ("</h1>|</?(?:p|div|article|section|ul|ol|table|tr|footer|header|main)(?: [^>]*)?>", _LINE, "g"),
                 ("<[^>]*>", "''", "g"))
for _name, _char in (("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&#x27;", "chr(39)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&nbsp;", "' '"), ("&copy;", "chr(169)"),
                     ("&middot;", "chr(183)"), ("&amp;", "'&'")):
    _SHOWN = f"replace({_SHOWN}, '{_name}', {_char})"
_SHOWN = _nested(_SHOWN, (" *\n *", "chr(10)", "g"), ("\n{3,}", _LINE, "g"))


@query("html_to_markdown", f"SELECT page_id, trim({_SHOWN}, ' '||chr(10)) AS markdown, url AS filename, octet_length(encode(html))::INTEGER AS file_size, url FROM pages")
def _(spark, d):
    return html.convert_pages(spread(load(spark, d, "pages")))


@query("html_headings", """SELECT page_id, regexp_replace(replace(trim(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '\\s+', ' ', 'g')), '&quot;', '"'), '&amp;?', '&', 'g') AS heading,
 octet_length(encode(html))::INTEGER AS file_size FROM pages""")
def _(spark, d):
    out = html.convert_pages(load(spark, d, "pages"))
    return out.select("page_id", F.regexp_extract("markdown", r"(?m)^# (.*)$", 1).alias("heading"), "file_size")
