"""Chunking over the Markdown view of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorefield.functions.splitting import SEPARATORS, merge_small_chunks, split_text
from lorefield.operators.chunking import chunk_documents, chunk_positions, heading_paths, part_suffix
from lorefield.operators.merging import merge_files, with_source
from lorefield.operators.states import valid_files
from lorefield.session import scratch_path
from lorefield.sources import tables
from workload.base import MD_SQL, documents, load, markdown, query, texts

NO_SPACE = r"\s+"


def _chunks(spark, d):
    docs = markdown(texts(spark, d)).select("doc_id", "file_name", "md")
    return chunk_documents(docs, text="md", strategy="recursive", size=350, overlap=0, minimum=100)


@query("chunk_documents")
def _(spark, d):
    return _chunks(spark, d)


# Joined without white space, the chunks of a document are the document.
@query("chunks_cover_documents", f"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(md, '\\*{{3,}}', '**', 'g'),
 '-{{4,}}', '---', 'g'), '={{4,}}', '===', 'g'), '\\s+', '', 'g')) AS content, true AS numbered, 'doc'||doc_id AS first_position
 FROM (SELECT doc_id, {MD_SQL} AS md FROM documents)""")
def _(spark, d):
    c = _chunks(spark, d)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "text"))), lambda s: s["text"]), "")
    return c.groupBy("doc_id").agg(
        F.md5(F.regexp_replace(joined, NO_SPACE, "")).alias("content"),
        (F.max("chunk_no") + 1 == F.count(F.lit(1))).alias("numbered"),
        F.regexp_replace(F.min_by("position", "chunk_no"), r" \(part 1\)$", "").alias("first_position"))


@query("split_text_recursive", """SELECT doc_id, md5(regexp_replace(text, '\\s+', '', 'g')) AS content, true AS within_size FROM documents""")
def _(spark, d):
    parts = texts(spark, d).select("doc_id", split_text("text", "recursive", 350, 0).alias("c"))
    return parts.select("doc_id", F.md5(F.regexp_replace(F.array_join("c", ""), NO_SPACE, "")).alias("content"),
                        F.coalesce(F.array_max(F.transform("c", F.length)) <= 350, F.lit(True)).alias("within_size"))


@query("split_text_strategies")
def _(spark, d):
    docs = markdown(texts(spark, d))
    names = ("semantic", "markdown", "sentence", "large_context", "hierarchical", "overlap", "content_aware")
    return docs.select("doc_id", *[F.size(split_text("md", n, 800, 80)).alias(f"n_{n}") for n in names])


# Documents in blocks of a fixed shape, so that SQL can say where each chunk ends: a block is a heading, an image and
# 200 letters of the text, 300 characters in all; from three blocks on their letters follow once more, line by line.
SHAPE_SQL = """WITH b0 AS (SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9]+', '_', 'g') AS t FROM documents),
 b1 AS (SELECT doc_id, list_transform(range(greatest(1, (length(t) + 199) // 200)), lambda i: rpad(substr(t, i * 200 + 1, 200), 200, 'x')) AS bodies FROM b0),
 b AS (SELECT doc_id, list_transform(range(len(bodies)), lambda i: rpad('## part '||(i // 2)||chr(10)||'![p](http://a.example/'||i||'.png)'||chr(10)||bodies[i + 1], 300, 'x')) AS blocks,
  CASE WHEN len(bodies) < 3 THEN [] ELSE list_transform(bodies, lambda x: rpad(x, 300, 'x')) END AS lines FROM b1)"""
# Chunks of one element or of two neighbours.
PAIRS_SQL = "list_transform(range((len({0}) + 1) // 2), lambda k: array_to_string({0}[2 * k + 1 : 2 * k + 2], {1}))"
SHAPED_CHUNKS_SQL = SHAPE_SQL + """, u AS (SELECT doc_id, unnest(list_concat(blocks, lines)) AS text, unnest(range(len(blocks) + len(lines))) AS i, len(blocks) AS n FROM b),
 p AS (SELECT *, 'doc'||doc_id||CASE WHEN i = 0 THEN '' ELSE ' > ## part '||((least(i, n) - 1) // 2) END AS path FROM u),
 chunks AS (SELECT doc_id, i::INTEGER AS chunk_no, text, CASE WHEN i < n THEN 'http://a.example/'||i||'.png' ELSE '' END AS img_url,
  CASE WHEN count(*) OVER (PARTITION BY doc_id, path) > 1 THEN path||' (part '||row_number() OVER (PARTITION BY doc_id, path ORDER BY i)||')' ELSE path END AS position FROM p)"""


def shaped(spark, d):
    """``doc_id, file_name, md``: the documents in blocks of a fixed shape."""
    t = F.regexp_replace("text", "[^A-Za-z0-9]+", "_")
    docs = texts(spark, d).select("doc_id", t.alias("t"))
    n = F.greatest(F.lit(1), F.ceil(F.length("t") / 200).cast("int"))
    bodies = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.rpad(F.substring("t", i * 200 + 1, F.lit(200)), 200, "x"))

    def block(body, i):
        return F.rpad(F.concat(F.lit("## part "), F.floor(i / 2).cast("string"), F.lit("\n![p](http://a.example/"), i.cast("string"),
                               F.lit(".png)\n"), body), 300, "x")
    docs = docs.select("doc_id", bodies.alias("bodies"))
    lines = F.when(F.size("bodies") < 3, "").otherwise(F.concat(F.lit("\n\n"), F.array_join(F.transform("bodies", lambda b: F.rpad(b, 300, "x")), "\n")))
    return docs.select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_name"),
                       F.concat(F.array_join(F.transform("bodies", block), "\n\n"), lines).alias("md"))


@query("chunk_documents_shaped", SHAPED_CHUNKS_SQL + " SELECT * FROM chunks")
def _(spark, d):
    out = chunk_documents(shaped(spark, d), text="md", strategy="recursive", size=350, overlap=0, minimum=100)
    return out.select("doc_id", "chunk_no", "text", "img_url", "position")


# The chunks of every strategy: two elements fit into 800 characters, one into the halved size of 'overlap'.
@query("split_text_shaped", SHAPE_SQL + f""", s AS (SELECT doc_id, list_concat({PAIRS_SQL.format("blocks", "chr(10)||chr(10)")}, {PAIRS_SQL.format("lines", "chr(10)")}) AS pairs,
 list_concat(blocks, lines) AS singles FROM b),
 c AS (SELECT doc_id, strategy, CASE WHEN strategy = 'overlap' THEN singles ELSE pairs END AS chunks FROM s, (SELECT unnest(['recursive', 'semantic', 'markdown', 'sentence',
  'large_context', 'hierarchical', 'overlap', 'content_aware']) AS strategy))
 SELECT doc_id, strategy, len(chunks)::INTEGER AS n_chunks, md5(array_to_string(chunks, '|')) AS content FROM c""")
def _(spark, d):
    docs = shaped(spark, d)
    found = F.array(*[F.struct(F.lit(n).alias("strategy"), split_text("md", n, 800, 80).alias("c")) for n in SEPARATORS])
    return docs.select("doc_id", F.explode(found).alias("s")).select(
        "doc_id", "s.strategy", F.size("s.c").alias("n_chunks"), F.md5(F.array_join("s.c", "|")).alias("content"))


@query("merge_small_chunks", """SELECT doc_id, md5(replace(text, ' ', '')) AS content, true AS long_enough FROM documents""")
def _(spark, d):
    merged = texts(spark, d).select("doc_id", "text", merge_small_chunks(F.split("text", " "), 100).alias("c"))
    short = F.size(F.filter("c", lambda c: F.length(c) < 100))
    return merged.select("doc_id", F.md5(F.array_join("c", "")).alias("content"), ((short == 0) | (F.size("c") == 1)).alias("long_enough"))


# A chunk table with headings of every kind: one chunk per paragraph.
HEADED_SQL = """WITH m AS (SELECT doc_id, '# '||source||chr(10)||chr(10)||'intro'||chr(10)||chr(10)||lang||chr(10)||'---'||chr(10)||chr(10)||
 replace(text, chr(10), chr(10)||chr(10)||'### ')||chr(10)||chr(10)||'- end'||chr(10)||chr(10)||'last'||chr(10)||chr(10)||'Appendix'||chr(10)||'==='||chr(10)||chr(10)||'more' AS md FROM documents),
 s AS (SELECT doc_id, string_split(md, chr(10)||chr(10)) AS parts FROM m),
 c AS (SELECT doc_id, unnest(parts) AS chunk, unnest(range(0, len(parts)))::INTEGER AS chunk_no FROM s),
 l AS (SELECT doc_id, chunk_no, unnest(ls) AS raw, unnest(range(0, len(ls))) AS line_no FROM (SELECT *, regexp_split_to_array(chunk, '\\n+') AS ls FROM c)),
 t AS (SELECT *, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS line FROM l),
 k AS (SELECT *, CASE WHEN regexp_matches(line, '^=+$') THEN 0 WHEN regexp_matches(line, '^-+$') THEN 1 END AS u,
  CASE WHEN starts_with(line, '# ') THEN 0 WHEN starts_with(line, '## ') THEN 1 WHEN starts_with(line, '### ') THEN 2 WHEN starts_with(line, '#### ') THEN 3
  WHEN starts_with(line, '##### ') THEN 4 WHEN starts_with(line, '###### ') THEN 5 WHEN regexp_matches(line, '^(\\d+\\. |- |\\* )') THEN 6
  WHEN regexp_matches(line, '^\\*\\*.*\\*\\*$') THEN 6 END AS p FROM t),
 h0 AS (SELECT *, last_value(CASE WHEN u IS NULL THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id, chunk_no ORDER BY line_no
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM k),
 h AS (SELECT doc_id, chunk_no, chunk_no::BIGINT * 100000 + line_no AS pos, coalesce(u, p) AS p, CASE WHEN u IS NULL THEN line ELSE coalesce(prev, '') END AS t
  FROM h0 WHERE u IS NOT NULL OR p IS NOT NULL),
 v AS (SELECT a.doc_id, a.chunk_no, a.pos, a.t, min(b.chunk_no) AS gone, min(b.pos) AS gone_pos FROM h a
  LEFT JOIN h b ON b.doc_id = a.doc_id AND b.pos > a.pos AND b.p <= a.p GROUP BY ALL),
 paths AS (SELECT c.doc_id, c.chunk_no, concat_ws(' > ', 'doc'||c.doc_id, string_agg(v.t, ' > ' ORDER BY v.pos)) AS path FROM c
  LEFT JOIN v ON v.doc_id = c.doc_id AND v.chunk_no < c.chunk_no AND (v.gone IS NULL OR v.gone >= c.chunk_no) GROUP BY c.doc_id, c.chunk_no)"""


def _headed(spark, d):
    docs = texts(spark, d)
    md = F.concat(F.lit("# "), F.col("source"), F.lit("\n\nintro\n\n"), F.col("lang"), F.lit("\n---\n\n"),
                  F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n### ")), F.lit("\n\n- end\n\nlast\n\nAppendix\n===\n\nmore"))
    rows = docs.select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("file_name"),
                       F.posexplode_outer(F.split(md, "\n\n")).alias("chunk_no", "text"))
    return rows


@query("heading_paths", HEADED_SQL + " SELECT doc_id, chunk_no, path FROM paths")
def _(spark, d):
    return heading_paths(_headed(spark, d)).select("doc_id", "chunk_no", "path")


# Pieces of eight chunks: headings, runs and numbers cross from piece to piece.
@query("chunk_positions", HEADED_SQL + """, i AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_no) AS n,
 row_number() OVER (PARTITION BY doc_id ORDER BY chunk_no) - row_number() OVER (PARTITION BY doc_id, path ORDER BY chunk_no) AS island FROM paths)
 SELECT doc_id, chunk_no, n - 1 AS number, path, CASE WHEN count(*) OVER (PARTITION BY doc_id, path, island) > 1
 THEN path||' (part '||row_number() OVER (PARTITION BY doc_id, path, island ORDER BY chunk_no)||')' ELSE path END AS position FROM i""")
def _(spark, d):
    return chunk_positions(_headed(spark, d), span=8).select("doc_id", "chunk_no", "number", "path", "position")


@query("part_suffix", """WITH e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id)
 - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS island FROM events)
 SELECT user_id, event_id, CASE WHEN count(*) OVER (PARTITION BY user_id, event_type, island) > 1
 THEN event_type||' (part '||row_number() OVER (PARTITION BY user_id, event_type, island ORDER BY event_id)||')' ELSE event_type END AS position FROM e""")
def _(spark, d):
    out = part_suffix(load(spark, d, "events"), "user_id", "event_id", "event_type")
    return out.select("user_id", "event_id", "position")


@query("write_chunks", f"""SELECT doc_id, {MD_SQL} AS "Text", 'p' AS "Position" FROM documents""")
def _(spark, d):
    path = scratch_path(spark, "chunks")
    rows = markdown(documents(spark, d)).select("doc_id", F.col("md").alias("text"), F.lit("").alias("text_pure"),
                                                F.lit("").alias("img_url"), F.lit("p").alias("position"))
    tables.write_chunks(rows, path, "tsv")
    schema = "Text string, Text_pure string, Img_url string, Position string, doc_id bigint"
    return tables.read_table(spark, path, "tsv", schema).select("doc_id", "Text", "Position")


@query("valid_chunk_files", HEADED_SQL + " SELECT 'doc'||doc_id AS file_name, count(*) AS n_chunks FROM c GROUP BY 1")
def _(spark, d):
    rows = heading_paths(_headed(spark, d), out="position")
    return valid_files(rows.withColumns({"text_pure": F.col("text"), "img_url": F.lit("")}))


@query("merge_files", """SELECT 'customer' AS file_name1, c_name AS name, c_nationkey AS nation, c_custkey AS file_name, NULL AS phone FROM customer
 UNION ALL SELECT 'supplier', s_name, s_nationkey, NULL, s_suppkey FROM supplier
 UNION ALL SELECT 'nation', n_name, n_nationkey, NULL, NULL FROM nation""")
def _(spark, d):
    c, s, n = (load(spark, d, t) for t in ("customer", "supplier", "nation"))
    return merge_files({
        "customer": c.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("file_name")),
        "supplier": s.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("phone")),
        "nation": n.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("nation"))})


@query("merge_files_sorted", """SELECT 'customer' AS file_name, c_custkey AS a, c_name AS b, NULL AS c FROM customer
 UNION ALL SELECT 'supplier', NULL, s_name, s_suppkey FROM supplier""")
def _(spark, d):
    c, s = load(spark, d, "customer"), load(spark, d, "supplier")
    return merge_files({"customer": c.select(F.col("c_name").alias("b"), F.col("c_custkey").alias("a")),
                        "supplier": s.select(F.col("s_suppkey").alias("c"), F.col("s_name").alias("b"))}, "all_sorted")


@query("with_source", "SELECT 'region' AS file_name, r_regionkey, r_name FROM region")
def _(spark, d):
    return with_source(load(spark, d, "region")).select("file_name", "r_regionkey", "r_name")


@query("merge_files_common", """SELECT 'customer' AS source, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_name FROM supplier""")
def _(spark, d):
    c, s = load(spark, d, "customer"), load(spark, d, "supplier")
    return merge_files({"customer": c.select(F.col("c_name").alias("name"), "c_custkey"),
                        "supplier": s.select("s_suppkey", F.col("s_name").alias("name"))}, "common", "source")
