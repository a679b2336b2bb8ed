"""The queries of this package over the test tables, and their SQL where SQL can say it."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorefield.llm.clustering import CLUSTERS, DIMENSIONS, ROUNDS, SCALE, SEED as CLUSTER_SEED, cluster_vectors
from lorefield.llm.common import read
from lorefield.llm.decontaminate import MISMATCH, SCORE, SEEDS, SPAN, benchmark_overlaps
from lorefield.llm.extraction import extract_pages
from lorefield.llm.fingerprints import fingerprint_documents
from lorefield.llm.language import identify_language
from lorefield.llm.packing import pack_documents
from lorefield.llm.pii import find_pii
from lorefield.llm.quality import score_quality
from lorefield.llm.resampling import BUCKETS, LEAST_WORDS, PERCENT, SEED, resample
from lorefield.llm.revisits import FIXED_HEADERS, URL, resolve_revisits
from lorefield.llm.simhash import simhash_components
from lorefield.llm.substrings import remove_repeats
from lorefield.llm.toxicity import score_toxicity

QUERIES = {}
#: Tokenizer file of the packing queries, by name; see ``tokenizer_path``.
TOKENIZER = "word_bpe_49k.json"
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read(spark, sf_dir, "documents"))


@_query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _seed_sql(table: str, key: str) -> str:
    """Seeds of a table of word lists: the words that a mask looks at, written out."""
    return " UNION ALL ".join(
        f"SELECT {key}, i, {n} AS mask, concat_ws(' ', {', '.join(f'w[i + {k + 1}]' for k, bit in enumerate(m) if bit == '1')}) AS seed "
        f"FROM {table}, unnest(range(len(w) - {len(m) - 1})) AS r(i)" for n, m in enumerate(SEEDS))


# The operator's seeds, and every hit's diagonal; the given items all have more words than the longest seed.
# The best stretch of a diagonal ends at the first greatest rise over the lowest (latest) earlier sum of the scores.
_WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
ORACLES["op2_decontaminate"] = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents), iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
ds AS ({_seed_sql('dw', 'doc_id')}), iss AS ({_seed_sql('iw', 'item_id')}),
hits AS (SELECT DISTINCT doc_id, item_id, ds.i - iss.i AS shift FROM ds JOIN iss USING (mask, seed)),
cells AS (SELECT doc_id, item_id, shift, j, len(iw.w) AS length,
    CASE WHEN j + shift >= 0 AND j + shift < len(dw.w) AND dw.w[j + shift + 1] = iw.w[j + 1] THEN 1 ELSE {MISMATCH} END AS gain
  FROM hits JOIN dw USING (doc_id) JOIN iw USING (item_id), unnest(range(len(iw.w))) AS r(j)),
sums AS (SELECT *, sum(gain) OVER d AS total FROM cells WINDOW d AS (PARTITION BY doc_id, item_id, shift ORDER BY j)),
lows AS (SELECT *, least(0, coalesce(min(total * 1000000 - (j + 1)) OVER (PARTITION BY doc_id, item_id, shift ORDER BY j
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low FROM sums),
runs AS (SELECT *, total - ceil(low / 1000000.0) AS run, ceil(low / 1000000.0) * 1000000 - low AS first FROM lows),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY run DESC, j) = 1)
SELECT doc_id, item_id, run::INTEGER AS score, ((run - ({MISMATCH}) * (j - first + 1)) / (1 - ({MISMATCH})))::INTEGER AS equal_words,
  first::INTEGER AS item_first, j::INTEGER AS item_last, (first + shift)::INTEGER AS doc_first
FROM best WHERE CASE WHEN length < {SPAN} THEN run = length ELSE 2 * run >= least({2 * SCORE}, length) END
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY run DESC, first, first + shift, j DESC, equal_words DESC) = 1
"""


@_query
def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))


@_query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(read(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@_query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


@_query
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("spans")


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def captures(pages: DataFrame) -> DataFrame:
    """Web captures made of the pages: a full response each, a revisit before it and two after it.

    Revisits write the URL in another way and one header field twice; the first
    after the response has a weak etag. Every fifth page has changed by its last
    revisit, every third sends no etag, every seventh has no validator.
    """
    p = F.col("page_id")
    etag = F.when(p % 3 != 0, F.md5("html"))
    kinds = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("seconds")) for k, s in ((0, 0), (1, 3600), (2, 7200), (3, -3600))])
    rows = pages.select("page_id", "url", "html", F.explode(kinds).alias("kind")).select("page_id", "url", "html", "kind.*")
    again = F.col("k") > 0
    stale = (F.col("k") == 2) & (p % 5 == 0)
    bare = again & (p % 7 == 0)
    other = F.regexp_replace(F.regexp_replace("url", "^http(s?)://([^/?#]+)/", "HTTP$1://$2/%7ex/../%2e/"), "#.*$", "")
    etag = F.when(F.col("k") == 1, F.concat(F.lit("W/"), etag)).otherwise(etag)
    return rows.select(
        (p * 4 + F.col("k")).alias("record_id"), F.when(again, F.concat(other, F.lit("#r"))).otherwise(F.col("url")).alias("url"),
        F.timestamp_seconds(F.lit(1_700_000_000) + p * 60 + F.col("seconds")).alias("captured_at"), again.alias("is_revisit"),
        F.when(bare, None).when(stale, "changed").otherwise(etag).alias("etag"),
        F.when(bare, None).when(stale, "later").otherwise(F.concat(F.lit("day "), (p % 28).cast("string"))).alias("last_modified"),
        F.when(bare, None).otherwise(F.md5("html")).alias("digest"),
        F.create_map(F.lit("Date"), F.col("seconds").cast("string"), F.lit("Content-Length"), F.when(again, "0").otherwise(F.length("html").cast("string")),
                     F.when(again, "Age").otherwise("Server"), F.lit("x"), F.when(again, "AGE").otherwise("SERVER"), F.lit("y")).alias("headers"))


@_query
def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(read(spark, sf_dir, "pages")))
    fields = F.array_join(F.transform("headers", lambda h: F.concat_ws(": ", h["name"], h["value"])), "; ")
    return found.select("record_id", "canonical_url", "status", "response_id", "response_digest", fields.alias("headers"))


_FIXED = ", ".join(f"'{h}'" for h in FIXED_HEADERS)


def _decoded_sql(part: str) -> str:
    """Percent-encoding made uniform."""
    code = "upper(x[1:2])"
    char = f"chr(TRY_CAST('0x' || {code} AS INTEGER))"
    return (f"array_to_string(list_transform(string_split({part}, '%'), lambda x, i: CASE WHEN i = 1 THEN x WHEN NOT regexp_matches(x, '^[0-9A-Fa-f]{{2}}') THEN '%' || x "
            f"WHEN regexp_matches({char}, '^[A-Za-z0-9._~-]$') THEN {char} || x[3:] ELSE '%' || {code} || x[3:] END), '')")


ORACLES["op8_revisits"] = rf"""
WITH kinds(k, seconds) AS (VALUES (0, 0), (1, 3600), (2, 7200), (3, -3600)),
captures AS (
  SELECT page_id * 4 + k AS record_id,
    CASE WHEN k > 0 THEN regexp_replace(regexp_replace(url, '^http(s?)://([^/?#]+)/', 'HTTP\1://\2/%7ex/../%2e/'), '#.*$', '') || '#r' ELSE url END AS url,
    1700000000 + page_id * 60 + seconds AS ts, k > 0 AS is_revisit,
    CASE WHEN k > 0 AND page_id % 7 = 0 THEN NULL WHEN k = 2 AND page_id % 5 = 0 THEN 'changed' WHEN page_id % 3 <> 0 THEN CASE WHEN k = 1 THEN 'W/' ELSE '' END || md5(html) END AS etag,
    CASE WHEN k > 0 AND page_id % 7 = 0 THEN NULL WHEN k = 2 AND page_id % 5 = 0 THEN 'later' ELSE 'day ' || (page_id % 28) END AS last_modified,
    CASE WHEN k > 0 AND page_id % 7 = 0 THEN NULL ELSE md5(html) END AS digest,
    CASE WHEN k > 0 THEN [('age', 'y'), ('content-length', '0'), ('date', seconds::VARCHAR)]
         ELSE [('content-length', length(html)::VARCHAR), ('date', seconds::VARCHAR), ('server', 'y')] END AS fields
  FROM pages, kinds),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url, '{URL}', 2)), '^.*@', ''),
      CASE lower(regexp_extract(url, '{URL}', 1)) WHEN 'http' THEN ':(80)?$' WHEN 'https' THEN ':(443)?$' ELSE ':$' END, '') AS host,
    {_decoded_sql(f"regexp_extract(url, '{URL}', 3)")} AS dotted,
    array_to_string(list_sort(list_filter(string_split({_decoded_sql(f"substr(regexp_extract(url, '{URL}', 4), 2)")}, '&'), lambda x: x <> '')), '&') AS query
  FROM captures),
pathed AS (
  SELECT * EXCLUDE (dotted), CASE WHEN regexp_matches(dotted, '/\.\.?(/|$)') THEN '/' || array_to_string(list_concat(
      list_reduce(list_prepend([]::VARCHAR[], list_transform(string_split(dotted, '/')[2:], lambda s: [s])), lambda acc, s:
        CASE s[1] WHEN '..' THEN acc[1:len(acc) - 1] WHEN '.' THEN acc ELSE list_concat(acc, s) END),
      CASE WHEN regexp_matches(dotted, '/\.\.?$') THEN [''] ELSE [] END), '/') ELSE dotted END AS path
  FROM parts),
named AS (
  SELECT * EXCLUDE (host, path, query), CASE WHEN host <> '' THEN
    host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canonical_url
  FROM pathed),
full_ AS (SELECT canonical_url, ts, arg_max(struct_pack(record_id := record_id, etag := etag, last_modified := last_modified, digest := digest, fields := fields), record_id) AS hit
  FROM named WHERE NOT is_revisit GROUP BY ALL),
found AS (SELECT r.*, f.hit FROM (SELECT * FROM named WHERE is_revisit) r
  ASOF LEFT JOIN full_ f ON r.canonical_url = f.canonical_url AND r.ts > f.ts),
judged AS (
  SELECT *, CASE WHEN hit IS NULL THEN 'no_response'
    WHEN CASE WHEN etag IS NOT NULL AND hit.etag IS NOT NULL THEN regexp_replace(etag, '^W/', '') = regexp_replace(hit.etag, '^W/', '')
              WHEN last_modified IS NOT NULL AND hit.last_modified IS NOT NULL THEN last_modified = hit.last_modified
              WHEN digest IS NOT NULL AND hit.digest IS NOT NULL THEN digest = hit.digest ELSE false END THEN 'resolved'
    ELSE 'mismatch' END AS status
  FROM found),
changing AS (SELECT *, list_filter(fields, lambda f: f[1] NOT IN ({_FIXED})) AS fresh FROM judged)
SELECT record_id, canonical_url, status, hit.record_id AS response_id, hit.digest AS response_digest,
  CASE WHEN status = 'resolved' THEN array_to_string(list_transform(list_sort(list_concat(
    list_filter(hit.fields, lambda f: NOT list_contains(list_transform(fresh, lambda g: g[1]), f[1])), fresh)), lambda f: f[1] || ': ' || f[2]), '; ') END AS headers
FROM changing
"""


@_query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


@_query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read(spark, sf_dir, "documents"))


@_query
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _runs_sql(table: str, key: str) -> str:
    """Words and runs of one to three words of every text."""
    words = (r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
    return (f"SELECT {key}, len(w) AS n_words, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), "
            "list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS runs "
            f"FROM (SELECT {key}, {words} AS w FROM {table})")


# CRC-32 by the byte table, over the hexadecimal digits of the UTF-8 bytes.
ORACLES["op11_resampling"] = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, * FROM ({_runs_sql('documents', 'doc_id')})), b AS ({_runs_sql('benchmark', 'item_id')}),
slots AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
  ORDER BY i) AS slot FROM range(256) AS r(i)),
dt AS (SELECT row_id, unnest(runs) AS term FROM d), bt AS (SELECT unnest(runs) AS term FROM b),
terms AS (SELECT DISTINCT term, hex(encode(term)) AS digits FROM (SELECT term FROM dt UNION ALL SELECT term FROM bt)),
codes AS (SELECT term, list_transform(range(strlen(term)), lambda i: strpos('123456789ABCDEF', digits[2 * i + 1]) * 16
  + strpos('123456789ABCDEF', digits[2 * i + 2])) AS codes FROM terms),
hashed AS (SELECT term, xor(list_reduce(list_prepend(4294967295, codes), lambda c, x: xor(c >> 8, slot[(xor(c, x) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM codes, slots),
s AS (SELECT bucket, count(*) AS s FROM dt JOIN hashed USING (term) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bt JOIN hashed USING (term) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM dt)::DOUBLE AS all_s, (SELECT count(*) FROM bt)::DOUBLE AS all_t),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + {BUCKETS}) / ((s::DOUBLE + 1) * (all_t + {BUCKETS}))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket), totals),
weights AS (SELECT row_id, sum(gain)::BIGINT AS weight FROM dt JOIN hashed USING (term) JOIN gains USING (bucket) GROUP BY row_id),
scored AS (SELECT row_id, doc_id, n_words, len(runs)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((
    ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (row_id)),
ranks AS (SELECT row_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranks USING (row_id)
"""


@_query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@_query
def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read(spark, sf_dir, "embeddings"))


def _rounds_sql() -> str:
    """Assignments ``a0`` to the centroids ``c0``, then ``c1`` and so on, one table after the other."""
    def nearest(n):
        return (f"a{n} AS MATERIALIZED (SELECT row_id, vec_id, v, min(struct_pack(far := list_sum(list_transform(range(1, {DIMENSIONS + 1}), "
                f"lambda j: (v[j] - c[j]) * (v[j] - c[j])))::BIGINT, cluster := cluster)) AS hit FROM kept, c{n} GROUP BY ALL)")

    def moved(n):
        # Floor of sum / count for whole numbers of either sign.
        return (f"c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(new, c) AS c FROM c{n} LEFT JOIN (SELECT cluster, list(mean ORDER BY j) AS new FROM ("
                "SELECT hit.cluster AS cluster, j, ((sum(v[j]) - ((sum(v[j]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean "
                f"FROM a{n}, range(1, {DIMENSIONS + 1}) AS r(j) GROUP BY ALL) GROUP BY cluster) USING (cluster))")

    return ",\n".join(part for n in range(ROUNDS) for part in (nearest(n), moved(n))) + ",\n" + nearest(ROUNDS)


ORACLES["op13_clustering"] = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{CLUSTER_SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS cluster, v AS c
  FROM kept ORDER BY cluster LIMIT {CLUSTERS}),
{_rounds_sql()}
SELECT vec_id, hit.cluster::INTEGER AS cluster, hit.far AS distance, (sum(hit.far) OVER (PARTITION BY hit.cluster))::BIGINT AS cluster_inertia,
  (sum(hit.far) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} ON cluster = hit.cluster
"""
