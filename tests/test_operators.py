"""Operators on small data against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorefield.functions.encoders import HashingEncoder
from lorefield.operators import collections as C
from lorefield.operators import evaluation, generation, masks, search, similarity, states
from lorefield.operators.chunking import chunk_documents, chunk_positions, heading_paths, part_suffix
from lorefield.operators.merging import merge_files
from lorefield.plans.dataset import corpus_to_qa
from lorefield.plans.ingest import ingest_rows, reembed
from lorefield.session import scratch_path
from lorefield.sources import collections as store
from lorefield.sources import corpus, html, matrices, tables
from lorefield.streaming.jobs import incremental_chunks, streaming_ingest


def vectors(spark, n, dim, seed, name="id"):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dim)).round(1)
    rows[0] = 0
    rows[n // 2] = rows[n // 3]
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], f"{name} int, embedding array<double>"), rows


def brute(y, x, low):
    norm = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    return np.clip(norm(y) @ norm(x).T, low, 1)


LIMITS = [{}, {"broadcast_bytes": 1, "stripe_bytes": 400}, {"broadcast_bytes": 1200}]


@pytest.mark.parametrize("limits", LIMITS)
def test_matrix_topk_and_stats_agree_with_brute_force(spark, limits):
    (x, xr), (y, yr) = vectors(spark, 30, 5, 1), vectors(spark, 20, 5, 2)
    want = brute(yr, xr, 0)
    got = similarity.similarity_matrix(x, y, **limits).collect()
    assert len(got) == 600
    for r in got:
        assert abs(r["sim"] - want[r["y_id"], r["x_id"]]) < 1e-9
    rounded = np.round(want, 12)
    for axis, m in (("x", rounded), ("y", rounded.T)):
        best = similarity.similarity_topk(x, y, 4, axis, **limits).collect()
        got = {(r["y_id"], r["x_id"], r["rank"]) for r in best}
        order = {(i, int(j), n + 1) for i, row in enumerate(m) for n, j in enumerate(np.lexsort((np.arange(len(row)), -row))[:4])}
        assert got == (order if axis == "x" else {(b, a, n) for a, b, n in order})
    s = similarity.sweep_stats(x.withColumn("collection", F.lit("p")), y.withColumn("collection", F.lit("q")), **limits).collect()
    assert len(s) == 1 and s[0]["total_pairs"] == 600 and s[0]["x_collection"] == "p"
    assert abs(s[0]["avg_similarity"] - want.mean()) < 1e-9 and abs(s[0]["std_similarity"] - want.std()) < 1e-9
    assert s[0]["high_similarity_count"] == (rounded > 0.8).sum() and s[0]["low_similarity_count"] == (rounded < 0.5).sum()
    stats = similarity.similarity_stats(similarity.similarity_matrix(x, y, **limits)).first()
    assert abs(stats["std_similarity"] - want.std()) < 1e-9


@pytest.mark.parametrize("limits", LIMITS)
def test_sizes(spark, limits):
    (x, _), (y, _) = vectors(spark, 12, 5, 1), vectors(spark, 9, 4, 2)
    with pytest.raises(Exception, match="vector sizes differ"):
        similarity.similarity_matrix(x, y, **limits).collect()
    mixed = x.withColumn("collection", F.lit("five")).unionByName(y.withColumn("collection", F.lit("four")))
    cells = similarity.matrix_sweep(mixed, mixed, **limits).groupBy("x_collection", "y_collection").count().collect()
    assert {tuple(c) for c in cells} == {("five", "five", 144), ("four", "four", 81)}
    with pytest.raises(ValueError, match="no rows"):
        similarity.similarity_matrix(x.limit(0), x)


def test_string_ids_and_hot_collection(spark):
    x, rows = vectors(spark, 40, 6, 3)
    named = x.select(F.concat(F.lit("n"), "id").alias("id"), "embedding", F.when(F.col("id") < 30, "big").otherwise("small").alias("collection"))
    a = {tuple(r) for r in similarity.matrix_sweep(named, named).collect()}
    b = {tuple(r) for r in similarity.matrix_sweep(named, named, broadcast_bytes=1, stripe_bytes=300).collect()}
    assert a == b and len(a) == 1600


@pytest.mark.parametrize("limits", LIMITS)
def test_copies_tie_by_id(spark, limits):
    rows = [(i, [1.0, 0.1 * (i % 7)] if i % 3 else [0.3, 0.4]) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, embedding array<double>").repartition(4)
    q = spark.createDataFrame([(1, [3.0, 4.0])], "query_id int, embedding array<double>")
    got = search.vector_search(df, q, 5, **limits).orderBy("rank").collect()
    assert [r["id"] for r in got] == [0, 3, 6, 9, 12] and {r["score"] for r in got} == {1.0}


def test_topk_mask_golden(spark):
    m = spark.createDataFrame([(0, 0, 0.2), (0, 1, 0.9), (0, 2, 0.9), (0, 3, None)], "y_id int, x_id int, sim double")
    assert [r["x_id"] for r in masks.topk_mask(m, 1).where("keep").collect()] == [1]
    assert masks.topk_mask(m, 0).where("keep").count() == 4
    assert masks.threshold_mask(m, 0.2, 0.9).where("keep").count() == 3


def test_mask_algebra_and_confusion(spark):
    rng = random.Random(3)
    cells = [(y, x, rng.random()) for y in range(6) for x in range(5)]
    m = spark.createDataFrame(cells, "y_id int, x_id int, sim double")
    a, b = masks.threshold_mask(m, 0.3, 1), masks.topk_mask(m, 2)
    kept = lambda d: {(r["y_id"], r["x_id"]) for r in d.where("keep").collect()}
    assert kept(masks.mask_and([a, b])) == kept(a) & kept(b)
    assert kept(masks.mask_or([a, b])) == kept(a) | kept(b)
    assert kept(masks.final_mask(m, 0.3, 1, 2)) == kept(a) & kept(b)
    c = evaluation.confusion(a, b).first()
    assert c["true_positive"] + c["true_negative"] + c["false_positive"] + c["false_negative"] == 30
    assert c["context_recall"] == len(kept(a) & kept(b)) / len(kept(a))
    total = m.agg(F.count(F.lit(1)))
    assert evaluation.confusion_from_kept(a.where("keep"), b.where("keep"), total).first() == c
    none = masks.threshold_mask(m, 2, 3)
    assert evaluation.confusion(a, none).first()["context_precision"] == 0 and evaluation.confusion(none, b).first()["context_recall"] == 0
    s = masks.mask_stats(b, "y").first()
    rows = {x for _, x in kept(b)}
    assert (s["total_count"], s["display_count"], s["diagonal_total"], s["missing_count"]) == (30, 12, 5, 5 - len(rows))
    with pytest.raises(Exception, match="differ in shape"):
        evaluation.matrix_difference(m, m.where("y_id < 5")).collect()
    temporary = masks.compose_mask(m, {"m": m}, {"m": {"k": 2}}, filters=["m"], temporary={"low": 0.3})
    assert kept(temporary) == kept(a) & kept(b)


def test_order_id(spark):
    n = 30_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("id")).repartition(5)
    assert C.order_id(df, parts=16).where("order_id <> id").count() == 0
    assert C.order_id(df, parts=16).count() == n
    words = df.select(F.lpad(F.col("id").cast("string"), 6, "0").alias("id"), F.col("id").alias("n"))
    assert C.order_id(words, parts=9).where("order_id <> n").count() == 0
    assert C.order_id(df.limit(10)).agg(F.max("order_id")).first()[0] == 9


def _paths_model(chunks, root):
    import re
    rules = [(r"# ", 0), (r"## ", 1), (r"### ", 2), (r"#### ", 3), (r"##### ", 4), (r"###### ", 5), (r"\d+\. ", 6), (r"- ", 6), (r"\* ", 6), (r"\*\*.*\*\*$", 6)]
    stack, out = [(-1, root)], []
    for text in chunks:
        out.append(" > ".join(t for _, t in stack))
        before = ""
        for line in re.split(r"\n+", text):
            found = next((p for r, p in rules if re.match(r, line.strip())), None)
            under = next((p for r, p in ((r"\s*=+\s*$", 0), (r"\s*-+\s*$", 1)) if re.match(r, line.strip())), None)
            if under is not None:
                found, line = under, before
            if found is not None:
                stack = [s for s in stack if s[0] < found] + [(found, line.strip())]
            before = line
    labelled, i = [], 0
    while i < len(out):
        j = i
        while j < len(out) and out[j] == out[i]:
            j += 1
        labelled += [out[i]] if j - i == 1 else [f"{out[i]} (part {n + 1})" for n in range(j - i)]
        i = j
    return labelled


def test_positions_match_stack_model(spark):
    rng = random.Random(11)
    lines = ["# A", "## B", "### C", "#### D", "##### E", "###### F", "1. one", "- li", "* st", "**bold**", "text", "===", "---", "", "  ## sp ", "#no", "Title", "a\n===", "b\n---"]
    docs = {f"d{i}.md": ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))] for i in range(60)}
    rows = [(d, n, t) for d, chunks in docs.items() for n, t in enumerate(chunks)]
    df = spark.createDataFrame(rows, "file_name string, chunk_no int, text string")
    want = {d: _paths_model(c, d[:-3]) for d, c in docs.items()}
    # Small pieces: documents are cut, and runs and headings cross the cuts.
    for span in (65536, 1, 3):
        got = part_suffix(heading_paths(df, span=span), span=span).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["position"] == want[r["file_name"]][r["chunk_no"]], (span, docs[r["file_name"]], r)
        # The same in one pass; places count from 0 whatever the order values are.
        spread = df.withColumn("chunk_no", F.col("chunk_no") * 2 + 5).withColumn("position", F.lit("replaced"))
        once = chunk_positions(spread, span=span).collect()
        assert len(once) == len(rows)
        for r in once:
            assert (r["number"] * 2 + 5, r["position"]) == (r["chunk_no"], want[r["file_name"]][r["number"]]), (span, r)


def test_chunk_positions_move_texts_once(spark, capsys):
    df = spark.createDataFrame([("a", 0, "# A"), ("a", 1, None), ("a", 2, "x")], "file_name string, chunk_no int, text string")
    out = chunk_positions(df)
    assert [(r["number"], r["position"]) for r in out.orderBy("chunk_no").collect()] == [(0, "a"), (1, "a > # A (part 1)"), (2, "a > # A (part 2)")]
    assert chunk_positions(df.limit(0)).count() == 0
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        chunk_positions(df).explain("formatted")
        plan = capsys.readouterr().out
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[[^\]]*\btext#", plan)
    assert len(moved) == 1, plan


def test_runs_in_one_hot_document(spark):
    rng = random.Random(4)
    paths = [rng.choice("aab") for _ in range(300)]
    rows = [("hot", 10 * i, p) for i, p in enumerate(paths)] + [(f"d{i}", 0, "a") for i in range(50)]
    df = spark.createDataFrame(rows, "file_name string, chunk_no int, path string")
    whole, cut = (part_suffix(df, span=s).select("file_name", "chunk_no", "position") for s in (10**6, 40))
    assert whole.exceptAll(cut).count() == 0 and cut.count() == 350


@pytest.mark.parametrize("run", [512, 3])
def test_chunk_documents_agrees_with_chunk_table(spark, monkeypatch, run):
    monkeypatch.setattr("lorefield.operators.chunking.RUN", run)
    rng = random.Random(2)
    bits = ["# T", "## U", "some words here", "[l](u)", "![i](v)", "- x", "", "x\n===", "*****", "------"]
    docs = [(f"f{i}.md", "\n".join(rng.choice(bits) for _ in range(40))) for i in range(30)] + [("empty.md", ""), ("blank.md", " \n")]
    df = spark.createDataFrame(docs, "file_name string, text string")
    chunks = chunk_documents(df, strategy="recursive", size=60, overlap=0, minimum=20).cache()
    again = part_suffix(heading_paths(chunks.withColumnRenamed("position", "expected")))
    assert again.where("position <> expected").count() == 0 and chunks.count() > 100
    assert chunks.where("file_name in ('empty.md', 'blank.md')").count() == 0
    lengths = chunks.groupBy("file_name").agg(F.max("chunk_no").alias("m"), F.count(F.lit(1)).alias("n"))
    assert lengths.where("m + 1 <> n").count() == 0


def test_retrieve_modes(spark):
    df = spark.createDataFrame([(i, f"d{i}", [1.0, float(i)], {"even": str(i % 2 == 0)}) for i in range(10)],
                               "id int, document string, embedding array<double>, metadata map<string,string>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<double>")
    even = {"conditions": [{"name": ["even"], "comparison_operator": "is", "value": "true"}]}
    post = search.retrieve(df, q, 3, 0.0, even).orderBy("rank").collect()
    assert [r["id"] for r in post] == [0, 2, 4]
    assert [r["id"] for r in search.retrieve(df, q, 2, 0.0, even).orderBy("rank").collect()] == [0, 2]
    odd = {"conditions": [{"name": ["even"], "comparison_operator": "is", "value": "false"}]}
    assert [r["id"] for r in search.retrieve(df, q, 1, 0.9, odd, "post").collect()] == []
    assert [r["id"] for r in search.retrieve(df, q, 1, 0.0, odd, "pre").collect()] == [1]
    with pytest.raises(ValueError):
        search.retrieve(df, q, 0)


def test_updates_and_deletes(spark):
    c = spark.createDataFrame([("a", "x", [1.0], {"k": "1"}), ("b", "y", [2.0], {"k": "2"})], "id string, document string, embedding array<float>, metadata map<string,string>")
    up = spark.createDataFrame([("a", None, {"z": "9"}), ("q", "new", None)], "id string, document string, metadata map<string,string>")
    rows = {r["id"]: r for r in C.update_rows(c, up).collect()}
    assert set(rows) == {"a", "b"} and rows["a"]["document"] == "x" and rows["a"]["metadata"] == {"z": "9"} and rows["b"]["metadata"] == {"k": "2"}
    assert [r["id"] for r in C.delete_rows(c, up).collect()] == ["b"]
    assert [r["id"] for r in C.lookup_ids(c, ["b", "zz"]).collect()] == ["b"]
    assert C.page_counts(c.limit(0), 5).first()["pages"] == 1
    fresh = reembed(up.where("id = 'a'"), HashingEncoder(8), "{z}").first()
    assert len(fresh["embedding"]) == 8 and set(fresh.asDict()) == {"id", "document", "metadata", "embedding"}


def test_collection_store(spark):
    rows = spark.createDataFrame([("1", "t", [1.0, 0.0])], "id string, text string, dense_vector array<double>")
    store.create_collection(rows, "c_test")
    store.append_collection(rows.withColumn("id", F.lit("2")), "c_test")
    assert store.has_collection(spark, "c_test") and "c_test" in store.list_collections(spark)
    got = store.scan_collection(spark, "c_test").collect()
    assert [(r["id"], r["document"], r["metadata"]) for r in got] == [("1", "text: t", {"text": "t"}), ("2", "text: t", {"text": "t"})]
    store.create_collection(rows, "c_test")
    assert store.open_collection(spark, "c_test").count() == 1
    store.drop_collection(spark, "c_test")
    with pytest.raises(ValueError):
        store.open_collection(spark, "c_test")
    with pytest.raises(ValueError):
        C.to_collection(rows.drop("dense_vector"))


def test_csv_round_trip_and_encodings(spark):
    path = scratch_path(spark, "enc")
    df = spark.createDataFrame([(" a,\"q\"\nline \n", "中文"), ("b", "")], "t string, u string")
    tables.write_table(df, path, "csv")
    back = tables.read_table(spark, path, "csv", "t string, u string").na.fill("")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    folder = scratch_path(spark, "gbk")
    import os
    os.makedirs(folder)
    for name, enc in (("g.csv", "gbk"), ("u.csv", "utf-8"), ("b.csv", "utf-8-sig")):
        with open(f"{folder}/{name}", "w", encoding=enc) as f:
            f.write("名,n\n中文内容,1\n")
        got = tables.read_table(spark, f"{folder}/{name}")
        assert got.columns == ["名", "n"] and tuple(got.first()) == ("中文内容", 1)
    with open(f"{folder}/j.json", "w") as f:
        f.write('[{"a": 1}, {"a": 2}]')
    assert tables.read_table(spark, f"{folder}/j.json").count() == 2
    with pytest.raises(ValueError):
        tables.read_table(spark, f"{folder}/x.xlsx")
    with open(f"{folder}/n.md", "w", encoding="utf-8-sig") as f:
        f.write("# hi\nthere")
    os.makedirs(f"{folder}/sub")
    with open(f"{folder}/sub/m.txt", "w") as f:
        f.write("x")
    texts = {r["file_name"]: r["text"] for r in corpus.read_corpus(spark, folder).collect()}
    assert texts == {"n.md": "# hi\nthere", "m.txt": "x"}
    assert {r["path"].rsplit("/", 1)[1] for r in corpus.admit_files(spark, folder).collect()} == {"g.csv", "u.csv", "b.csv", "j.json"}
    assert corpus.admit_files(spark, folder, max_bytes=5).count() == 0


def test_html():
    page = ("<html><head><title>t</title><script>var t='</p>';</script></head><body><nav><a href='/x'>n</a></nav><h1>A &amp; B</h1>"
            "<p>one<br>two <a href='u'>l</a><ul><li>x<li>y</ul><img src='i.png' alt='p'></body>")
    assert html.page_markdown(page) == "# A & B\n\none\ntwo [l](u)\n\n- x\n- y\n\n![p](i.png)"
    assert html.page_markdown(None) is None and html.page_markdown("") == ""


def test_matrix_document(spark):
    m = spark.createDataFrame([(y, x, y / 10 + x / 100) for y in (3, 5) for x in (1, 2, 4)], "y_id int, x_id int, sim double")
    y, x = m.select(F.col("y_id").alias("id")).distinct(), m.select(F.col("x_id").alias("id")).distinct()
    assert matrices.validate_matrix(m, y, x).first()["valid"]
    assert not matrices.validate_matrix(m, y.limit(1), x).first()["valid"]
    doc = matrices.matrix_document(m, y, x, matrices.config_row(spark, "X", "Y", {"top_k": 2}))
    cells, config = matrices.read_matrix_document(doc)
    assert {(r[0], r[1], round(r[2], 9)) for r in cells.collect()} == {(0, 0, 0.31), (0, 1, 0.32), (0, 2, 0.34), (1, 0, 0.51), (1, 1, 0.52), (1, 2, 0.54)}
    assert config.first()["top_k"] == 2 and config.first()["x_collection"] == "X"
    bare = spark.createDataFrame([('{"version": "1.0", "exportedMatrix": {"xCollection": "x", "yCollection": "y", "matrix": [[0.5]], "xData": [{}], "yData": [{}], '
                                   '"xAvailableFields": ["f"], "yAvailableFields": []}}',)], "document string")
    assert tuple(matrices.read_matrix_document(bare)[1].first()) == ("1.0", "x", "y", "f", "document", 0.0, 1.0, 0, "x", "none")
    broken = spark.createDataFrame([('{"version": "1.0", "exportedMatrix": {"xCollection": "x", "yCollection": "y", "matrix": [[1], [2]], "xData": [{}], "yData": [{}], '
                                     '"xAvailableFields": [], "yAvailableFields": []}}',)], "document string")
    with pytest.raises(Exception, match="differ in length"):
        matrices.read_matrix_document(broken)[0].collect()


def test_matrix_document_in_parts(spark, monkeypatch):
    monkeypatch.setattr(matrices, "BLOCK", 2)
    m = spark.createDataFrame([(y, x, y / 10 + x / 100) for y in (3, 5, 6) for x in (1, 2, 4, 7, 8)], "y_id int, x_id int, sim double")
    y, x = m.select(F.col("y_id").alias("id")).distinct(), m.select(F.col("x_id").alias("id"), F.lit("n").alias("position_name")).distinct()
    doc = matrices.matrix_document(m, y, x, matrices.config_row(spark, "X", "Y", {"top_k": 2})).cache()
    assert {r["part"]: r["count"] for r in doc.groupBy("part").count().collect()} == {"header": 1, "x": 5, "y": 3, "cells": 9}
    cells, config = matrices.read_matrix_document(doc)
    want = {(i, j, y / 10 + x / 100) for i, y in enumerate((3, 5, 6)) for j, x in enumerate((1, 2, 4, 7, 8))}
    assert set(map(tuple, cells.collect())) == want and config.first()["x_field"] == "document" and config.first()["top_k"] == 2
    for broken, why in ((doc.where("not (part = 'cells' and document like '%from\":2%')"), "columns and xData differ"),
                        (doc.where("not (part = 'y' and position = 0)"), "rows and yData differ"), (doc.where("part != 'header'"), "no header")):
        with pytest.raises(Exception, match=why):
            matrices.read_matrix_document(broken)[0].collect()


def test_merge_strategies(spark):
    a = spark.createDataFrame([(1, "x")], "n int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, a double")
    assert merge_files({"a": a, "b": b}).columns == ["file_name", "n", "b", "a"]
    assert merge_files({"a": a, "b": b}, "all_sorted", "b").columns == ["b1", "a", "b", "n"]
    assert merge_files({"a": a, "b": b}, "common").columns == ["file_name", "b"]


def test_file_state(spark):
    log = spark.createDataFrame([("f", "c1", 1, "failed", None, "boom", []), ("f", "c2", 2, "complete", 1, None, ["f.csv"]), ("f", "c2", 3, "incomplete", 2, None, [])],
                                "file string, checksum string, t int, status string, step int, error string, output_files array<string>")
    state = states.current_state(log.withColumn("processed_at", F.timestamp_seconds("t"))).first()
    assert (state["checksum"], state["status"], state["error"], state["output_files"]) == ("c2", "incomplete", "boom", ["f.csv"])
    assert (state["step1_completed"], state["step2_completed"], state["step3_completed"]) == (True, True, False)


def test_generation(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "fail"), (3, "none")], "i int, p string").coalesce(1)

    def model(texts):
        seen = model.__dict__.setdefault("seen", {})
        seen[texts[0]] = seen.get(texts[0], 0) + 1
        if texts[0] == "fail" or seen[texts[0]] == 1:
            raise RuntimeError("down")
        return ["nothing"] if texts[0] == "none" else [f"- question: q{'x' * (seen[texts[0]] % 3)}\n- answer: a"]

    rows = {r["i"]: r for r in generation.generate(df, "p", model, rounds=3, retries=1, delay=0.0, batch=1).collect()}
    assert (rows[1]["question"], rows[1]["answer"], rows[1]["calls"], rows[1]["retries"]) == ("qxx", "a", 4, 1)
    assert (rows[2]["question"], rows[2]["answer"], rows[2]["calls"]) == ("", "", 6)
    assert rows[3]["question"] == ""


def test_model_test_and_judge(spark):
    with pytest.raises(ValueError, match="input"):
        generation.run_model_test(spark.range(1), lambda r: r, "m")
    data = spark.createDataFrame([("hi", "r")], "input string, reference_output string")
    out = generation.run_model_test(data, lambda rs: ['{"answer": "%s/%s"}' % (r["query"], r["inputs"]["reference_output"]) for r in rs], "m")
    assert out.first()["model_output"] == "hi/r"
    rule = {"evaluation_rule": {"name": "n", "prompt": {"role": {"description": "{{input}}:{{generated_output}}:{{reference_output}}"}}}}

    def judge(prompts):
        if prompts != ["hi:hi/r:r"]:
            raise ValueError(prompts)
        return ['{"score": 0.5, "reason": "fine"}']

    good = generation.judge(out, rule, judge).first()
    assert (good["evaluation_score"], good["evaluation_reason"], good["evaluation_rule"]) == (0.5, "fine", "n")
    bad = generation.judge(data, rule, judge).first()
    assert bad["evaluation_score"] == 0.0 and bad["evaluation_reason"].startswith(generation.JUDGE_FAILED)
    with pytest.raises(ValueError):
        generation.judge(out, {}, judge)


def test_embedding_options(spark):
    df = spark.createDataFrame([("a b",), (None,), ("",)], "t string").coalesce(1)
    rows = [r[0] for r in df.select(generation.embed("t", load=lambda: HashingEncoder(16), batch=2)).collect()]
    assert [round(sum(v * v for v in r), 5) for r in rows] == [1.0, 0.0, 0.0]

    def broken(texts):
        raise RuntimeError("out of memory")

    assert df.select(generation.embed("t", broken, on_error="zero", dim=3)).first()[0] == [0.0, 0.0, 0.0]
    with pytest.raises(Exception, match="out of memory"):
        df.select(generation.embed("t", broken)).collect()


def test_ingest_checks_templates(spark):
    df = spark.createDataFrame([("q", 1)], "question string, n int")
    with pytest.raises(ValueError, match="available"):
        ingest_rows(df, "{Text}", "{n}", HashingEncoder(4), "f.csv")
    row = ingest_rows(df, "{question}", "{n}: {question}", HashingEncoder(4), "f.csv").first()
    assert row["document"] == "1: q" and row["metadata"]["source_file"] == "f.csv" and float(row["metadata"]["upload_time"]) > 1e9


def test_resume_skips_finished_rows(spark):
    docs = spark.createDataFrame([("a.md", "one two three " * 20)], "file_name string, text string")
    args = dict(rounds=1, delay=0.0, strategy="recursive", size=60, overlap=0, minimum=0)
    ask = lambda ts: ["- question: Which words?\n- answer: one two three" for _ in ts]
    first = corpus_to_qa(docs, ask, **args).cache()
    assert first.where("valid").count() == first.count() > 3
    rest = corpus_to_qa(docs, ask, done=first.where("chunk_no < 2"), **args)
    assert rest.count() == first.count() - 2


def test_streams_are_idempotent(spark):
    base = scratch_path(spark, "stream")
    files = spark.createDataFrame([(f"f{i}.md", f"# h{i}\n\ntext {i}", str(i)) for i in range(6)], "file_name string, text string, checksum string")
    files.repartition(3).write.parquet(f"{base}/in")
    for _ in range(2):
        stream = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        incremental_chunks(stream, f"{base}/out", f"{base}/log", f"{base}/cp", strategy="recursive", size=50, overlap=0, minimum=0).awaitTermination()
    chunks = chunk_documents(files.select("file_name", "text"), strategy="recursive", size=50, overlap=0, minimum=0)
    got = spark.read.parquet(f"{base}/out").select(*[c for c in chunks.columns if c != "checksum"])
    assert got.exceptAll(chunks.select(got.columns)).count() == 0 and got.count() == chunks.count()
    assert states.current_state(spark.read.parquet(f"{base}/log")).where("step1_completed").count() == 6
    rows = spark.createDataFrame([("a", "t"), ("a", "t"), ("b", "u")], "id string, t string")
    rows.coalesce(1).write.parquet(f"{base}/rows")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/rows")
    streaming_ingest(stream, f"{base}/coll", f"{base}/cp2", "{t}", encoder=HashingEncoder(4)).awaitTermination()
    assert spark.read.parquet(f"{base}/coll").count() == 2
