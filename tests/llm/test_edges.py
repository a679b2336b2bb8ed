"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns for every operator and stage."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lorefield.llm import decontaminate, extraction, fingerprints, language, packing, pii, revisits, simhash, substrings, toxicity

from . import edges

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PER_ROW = {
    "fingerprints": lambda s, d: fingerprints.fingerprint_documents(d),
    "language": lambda s, d: language.identify_language(d),
    "substrings": lambda s, d: substrings.remove_repeats(d),
    "toxicity": lambda s, d: toxicity.score_toxicity(d, edges.labels(s)),
    "simhash": lambda s, d: simhash.simhash_components(d),
    "pii": lambda s, d: pii.find_pii(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_each_row(spark, name):
    d = edges.docs(spark)
    got = PER_ROW[name](spark, d).cache()
    assert edges.rows_of(got.select("doc_id")) == edges.rows_of(d.select("doc_id"))
    assert got.select([c for c in got.columns if c not in ("doc_id", "spans", "component_id")]).dropna("any").count() == d.count()
    assert PER_ROW[name](spark, d.limit(0)).count() == 0


def test_packing_edges(spark):
    d = edges.docs(spark)
    got = packing.pack_documents(d, TOKENIZER)
    rows = got.collect()
    assert sum(r.piece == 0 for r in rows) == d.count()
    assert {r.length for r in rows if r.doc_id in (2, 3, 6)} == {1}
    assert max(r.offset + r.length for r in rows) <= packing.CAPACITY
    assert packing.pack_documents(d.limit(0), TOKENIZER).count() == 0


def test_decontamination_edges(spark):
    d = edges.docs(spark)
    assert decontaminate.benchmark_overlaps(d, edges.items(spark)).count() == 0
    item = [(9, " ".join(edges.LONG.split()[40:80])), (9, " ".join(edges.LONG.split()[40:80]))]
    found = decontaminate.benchmark_overlaps(d, edges.items(spark, item))
    assert edges.rows_of(found.select("doc_id", "item_id", "equal_words")) == [(4, 9, 40), (5, 9, 40)]
    assert decontaminate.drop_contaminated(d, edges.items(spark, item)).count() == d.count() - 2
    assert decontaminate.benchmark_overlaps(d.limit(0), edges.items(spark, item)).count() == 0
    assert decontaminate.benchmark_overlaps(d, edges.items(spark, item).limit(0)).count() == 0


def test_decontamination_judges_rows_that_share_an_id_one_by_one(spark):
    item = " ".join(edges.LONG.split()[40:60])
    other = " ".join(f"other{i}" for i in range(30))
    rows = [(None, "clean text"), (None, f"so {item} it is"), (None, None), (1, other), (1, f"{other} {item}"), (2, item), (2, item)]
    d = edges.docs(spark, rows)
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        kept = decontaminate.drop_contaminated(d, edges.items(spark, [(9, item)]), broadcast_bytes=limit)
        assert edges.rows_of(kept.select("doc_id", "text")) == edges.rows_of(d.select("doc_id", "text").where("text is null or text in ('clean text')").unionByName(
            d.select("doc_id", "text").where(F.col("text") == other)))
        found = decontaminate.benchmark_overlaps(d, edges.items(spark, [(9, item)]), broadcast_bytes=limit)
        assert {(r.doc_id, r.doc_first) for r in found.collect()} == {(None, 1), (1, 30), (2, 0)}


def test_extraction_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>One &amp; two.</p>"), (3, "u", "<nav>x"), (3, "u", "<nav>x"),
            (4, "u", "<article>" + "<p>Some words here.</p>" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = {(r.page_id, r.text[:20]) for r in extraction.extract_pages(pages).collect()}
    assert got == {(1, ""), (2, ""), (None, "One & two."), (3, ""), (4, "Some words here.\n\nSo")}
    assert extraction.extract_pages(pages).count() == 6
    assert extraction.extract_pages(pages.limit(0)).count() == 0


def test_canonical_urls(spark):
    want = {"HTTP://u@A.com:80/%7Ea/%2e%2E/b/./c/..": "a.com/b/", "https://a.com:80": "a.com:80/", "https://a.com:443?b&a%2D&": "a.com/?a-&b",
            "http://a.com/../x//y/%zz%2f%": "a.com/x//y/%zz%2F%", "http://a.com/.": "a.com/", "ftp://a.com:21/..a/.b": "a.com:21/..a/.b",
            "a.com/x": None, "": None, None: None}
    df = spark.createDataFrame([(u,) for u in want], "url string")
    assert {r.url: r.c for r in df.select("url", revisits.canonical_url(F.col("url")).alias("c")).collect()} == want


def test_revisit_edges(spark):
    fields = ("record_id long, url string, captured_at timestamp, is_revisit boolean, etag string, last_modified string, digest string, "
              "headers map<string,string>, range string")
    stamp = "2024-01-01 00:00:0"
    raw = [(1, "http://A.com", stamp + "1", False, "e", None, None, {"Server": "s", "Age": "1"}), (2, "https://a.com/#x", stamp + "2", True, "e", None, None, {"age": "2", "Content-Type": "t"}),
           (3, "http://a.com:80/", stamp + "1", True, "e", None, None, None), (4, None, stamp + "5", True, None, None, None, None),
           (5, "http://a.com/", None, True, None, None, None, None), (6, "a.com", stamp + "5", True, None, None, None, None),
           (7, "http://a.com/?", stamp + "6", True, "f", "same", None, None), (7, "http://a.com/?", stamp + "6", True, "f", "same", None, None),
           (8, "http://a.com/", stamp + "7", True, None, None, "d", None)]
    rows = spark.createDataFrame([(*r, "x") for r in raw], fields.replace("captured_at timestamp", "captured_at string")).withColumn(
        "captured_at", F.col("captured_at").cast("timestamp"))
    for ranges in (1, 3):
        got = sorted(((r.record_id, r.status, r.response_id) for r in revisits.resolve_revisits(rows, ranges).collect()))
        assert got == [(2, "resolved", 1), (3, "no_response", None), (4, "no_response", None), (5, "no_response", None),
                       (6, "no_response", None), (7, "mismatch", 1), (7, "mismatch", 1), (8, "mismatch", 1)]
    weak = spark.createDataFrame([(1, "https://a.com:443/b/~c?x=%c3%a9", stamp + "1", False, '"e"', None, None, {"AGE": "1", "age": "0", "Age": None}),
                                  (2, "https://a.com/./b/d/../%7Ec?x=%C3%A9", stamp + "2", True, 'W/"e"', None, None, {"Via": "1", "VIA": "2"}),
                                  (3, "http://a.com:443/b/~c?x=%C3%A9", stamp + "2", True, 'W/"e"', None, None, None)],
                                 fields.replace("captured_at timestamp", "captured_at string").replace(", range string", "")).withColumn(
        "captured_at", F.col("captured_at").cast("timestamp"))
    found = {r.record_id: r for r in revisits.resolve_revisits(weak).collect()}
    assert (found[2].status, found[3].status) == ("resolved", "no_response")
    assert [(h.name, h.value) for h in found[2].headers] == [("age", "1"), ("via", "2")]
    merged = {r.record_id: r.headers for r in revisits.resolve_revisits(rows).collect()}[2]
    assert [(h.name, h.value) for h in merged] == [("age", "2"), ("server", "s")]
    assert revisits.resolve_revisits(rows.limit(0)).count() == 0


def test_side_tables_that_are_empty_or_have_other_columns(spark, tmp_path):
    d = edges.docs(spark)
    crowded = lambda df: df.select("*", *[F.lit("x").alias(c) for c in (*edges.CLASHES, "text", "lang") if c not in df.columns])
    labels, items = edges.labels(spark), edges.items(spark, [(9, " ".join(edges.LONG.split()[40:80])), (1, None)])
    want = edges.rows_of(toxicity.score_toxicity(d, labels))
    assert edges.rows_of(toxicity.score_toxicity(d, crowded(labels))) == want
    found = decontaminate.benchmark_overlaps(d, items)
    assert edges.rows_of(decontaminate.benchmark_overlaps(d, crowded(items))) == edges.rows_of(found)
    assert decontaminate.drop_contaminated(d, items.limit(0)).count() == d.count()
    assert decontaminate.drop_contaminated(d, crowded(items)).columns == d.columns
    labels.limit(0).withColumn("quality", F.lit(1)).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.toxicity(spark, d, str(tmp_path)).count() == d.count()


def test_pipeline_stages(spark, tmp_path):
    d = edges.docs(spark)
    edges.labels(spark).withColumn("quality", F.lit(1)).write.parquet(f"{tmp_path}/labels.parquet")
    edges.items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        got = stage(spark, d, str(tmp_path))
        assert got.columns == d.columns and got.dtypes == d.dtypes, name
        kept = got.count()
        # Of the equal rows, of those without a word and of the two long ones one each stays.
        assert kept == {"near_duplicates": 6}.get(name, d.count()), name
        assert stage(spark, d.limit(0), str(tmp_path)).count() == 0
    masked = {r.doc_id: (r.text, r.n_chars) for r in got.collect()}
    assert masked[1] == ("The same text twice. Call [PHONE] now.", 38) and masked[2] == (None, 0)
    assert corpus_pipeline.STAGES[-1][1](spark, d, str(tmp_path)).where("piece = 0").count() == d.count()
