"""Readers, reports and other small parts."""

import os

import pytest
from pyspark.sql import functions as F

from lorefield.operators import collections as C
from lorefield.operators import reports
from lorefield.operators.masks import apply_mask, with_mask
from lorefield.operators.merging import with_source
from lorefield.operators.states import clear_errors, select_errors, valid_files
from lorefield.session import scratch_path, shared_dir, spread
from lorefield.sources.corpus import stream_corpus
from lorefield.sources.tables import read_table, write_chunks
from lorefield.streaming.jobs import incremental_chunks


def test_merge_reader_names_its_files(spark):
    folder = scratch_path(spark, "merge")
    os.makedirs(folder)
    for name in ("a.x", "b"):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(f"file_name,n\n{name},1\n")
    out = with_source(read_table(spark, folder, "csv", encoding="utf-8"))
    assert out.columns == ["file_name1", "file_name", "n"]
    assert {r["file_name1"] for r in out.collect()} == {"a.x", "b"}


def test_text_files_as_a_stream(spark):
    base = scratch_path(spark, "files")
    os.makedirs(f"{base}/in/sub")
    for name, text in (("a.md", "﻿# A\n\none"), ("sub/b.txt", "two"), ("c.bin", "no")):
        with open(f"{base}/in/{name}", "w", encoding="utf-8") as f:
            f.write(text)

    def run():
        files = stream_corpus(spark, f"{base}/in")
        incremental_chunks(files, f"{base}/out", f"{base}/log", f"{base}/cp", strategy="recursive", size=20, overlap=0,
                           minimum=0).awaitTermination()
        return {(r["file_name"], r["text"], r["position"]) for r in spark.read.parquet(f"{base}/out").collect()}

    first = run()
    assert first == {("a.md", "# A\n\none", "a"), ("b.txt", "two", "b")}
    with open(f"{base}/in/d.md", "w") as f:
        f.write("late")
    assert run() - first == {("d.md", "late", "d")}


def test_reports(spark):
    rows = spark.createDataFrame([("q long", "an answer text", 3, 1, 10), ("", "", 1, 0, 5)],
                                 "question string, answer string, calls int, retries int, tokens int")
    counts = reports.step_counts(rows).first()
    assert (counts["rows_succeeded"], counts["rows_failed"], counts["api_calls_made"], counts["total_tokens"]) == (1, 1, 4, 15)
    assert reports.quality_rate(rows).first()["validation_pass_rate"] == 50.0
    assert reports.quality_rate(rows.limit(0)).first()["validation_pass_rate"] == 0.0
    seen, observation = reports.observed_counts(rows, "rows")
    path = scratch_path(spark, "report")
    reports.write_report(seen, path)
    assert observation.get["rows"] == 2 and spark.read.json(path).count() == 2
    one = spark.createDataFrame([("a",)], "k string").withColumn("ts", F.timestamp_seconds(F.lit(5)))
    assert reports.throughput(one).first()["items_per_second"] is None


def test_errors(spark):
    errors = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "file string, step int")
    assert select_errors(errors, "a", 2).count() == 1 and select_errors(errors).count() == 3
    assert clear_errors(errors, "a", 2).count() == 1 and clear_errors(errors, step=2).count() == 1 and clear_errors(errors).count() == 0


def test_chunk_files(spark):
    rows = spark.createDataFrame([("f", "a\n\"b\" ", "p", "", "x")], "file_name string, text string, text_pure string, img_url string, position string")
    for fmt in ("csv", "tsv", "json", "parquet"):
        path = scratch_path(spark, fmt)
        write_chunks(rows, path, fmt)
        schema = "Text string, Text_pure string, Img_url string, Position string, file_name string"
        back = read_table(spark, path, fmt, schema, json_lines=True).na.fill("")
        assert tuple(back.select("Text", "Position").first()) == ("a\n\"b\" ", "x")
    assert valid_files(rows).first()["n_chunks"] == 1
    with pytest.raises(ValueError, match="missing required"):
        valid_files(rows.drop("position"))


def test_pages_and_masks(spark):
    c = spark.createDataFrame([(i, f"d{i}", [1.0]) for i in range(7)], "id int, document string, embedding array<double>")
    assert [r["id"] for r in C.page(c, 2, 3).collect()] == [3, 4, 5] and C.page(c, 3, 3).columns == ["id", "document"]
    assert [r["id"] for r in C.page_after(c, 3, 2).collect()] == [4, 5]
    m = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.7)], "y_id int, x_id int, sim double")
    mask = m.where("x_id = 1").select("y_id", "x_id", F.lit(True).alias("keep"))
    assert {tuple(r) for r in apply_mask(with_mask(m, mask)).collect()} == {(0, 0, None), (0, 1, 0.7)}


def test_session_helpers(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")

    class Bare:
        """A session without the setting."""

        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "local[2]"

    assert shared_dir(Bare) == shared_dir(Bare) and os.path.isdir(shared_dir(Bare))
    Bare.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Bare)
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 8
    assert spread(spark.range(10).repartition(40)).rdd.getNumPartitions() == 40


def test_long_nested_judgement(spark):
    """A response with very many inner braces is read without deep recursion."""
    from lorefield.functions.answers import parse_judgement

    inner = "{}" * 20_000
    rows = spark.createDataFrame([('{"x" ' + inner + '} {"score": 4, "reason": "fine"}',), ("{" + inner,)], "r string")
    got = [r[0] for r in rows.select(parse_judgement("r")).collect()]
    assert (got[0]["score"], got[0]["reason"]) == (4.0, "fine") and got[1]["score"] == 0.0


def test_html_keeps_text():
    from lorefield.sources.html import page_markdown

    assert page_markdown("<nav>menu<article><p>text</p>") == "text"
    assert page_markdown("<template>x<h1>T</h1><p>a") == "# T\n\na"
    assert page_markdown("<table><tr><td>1</td><td>2</td></tr></table>") == "1 2"
    assert page_markdown("<pre>a\nb</pre>") == "a\nb"
    assert page_markdown('<a href="k">v <a href="l">w</a>') == "[v ](k)[w](l)"
    assert page_markdown("<nav>menu</nav><p>a</p><script>x</script><p>b</p>") == "a\n\nb"


def test_prompts_go_in_lists(spark):
    from pyspark.sql import functions as F

    from lorefield.operators.generation import call_model

    calls = spark.sparkContext.accumulator(0)

    def model(prompts):
        calls.add(1)
        if any(p == "p7" for p in prompts):
            raise RuntimeError("no")
        return [p.upper() for p in prompts]

    rows = spark.range(64).coalesce(1).select(F.concat(F.lit("p"), "id").alias("p"))
    got = {r.p: r.response[0] for r in call_model(rows, "p", model, batch=16).collect()}
    assert got["p7"]["error"] == "no" and all(v["response"] == k.upper() for k, v in got.items() if k != "p7")
    assert calls.value == 4 + 16  # four lists, and the prompts of the failed one alone


def test_streamed_ids_and_equal_rows(spark, tmp_path):
    from lorefield.streaming.jobs import streaming_ingest

    given = "id string, document string, embedding array<float>"
    for k, ids in enumerate((["a", "b", "b"], ["b", "c"], ["a"])):
        spark.createDataFrame([(i, f"d{k}", [1.0]) for i in ids], given).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for name, fields in (("ids", given), ("none", "document string, embedding array<float>")):
        stream = spark.readStream.schema(fields).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        streaming_ingest(stream, f"{tmp_path}/{name}", f"{tmp_path}/{name}-checkpoint").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/ids").collect()) == ["a", "b", "c"]
    kept = [r.id for r in spark.read.parquet(f"{tmp_path}/none").collect()]
    assert len(kept) == len(set(kept)) == 6


def test_both_forms_of_a_page(spark):
    from lorefield.operators.collections import page

    rows = spark.range(50_000).selectExpr("(id * 7919) % 50000 AS id", "'x' AS document")
    for number in (1, 3, 500):
        assert page(rows, number, 100).collect() == page(rows, number, 100, deep=0).collect()


def test_probe_of_tables(spark, tmp_path):
    from lorefield.sources.tables import probe_table, read_table

    (tmp_path / "a.csv").write_bytes('a,b\n1,"x ""q"" y"\n'.encode())
    (tmp_path / "b.csv").write_bytes('a,b\n1,"x\ny"\n'.encode())
    (tmp_path / "c.csv").write_bytes("a,b\n1,中文\n".encode("gbk"))
    assert probe_table(spark, str(tmp_path / "a.csv")) == ("utf-8", False)
    assert probe_table(spark, str(tmp_path / "b.csv")) == ("utf-8", True)
    assert probe_table(spark, str(tmp_path / "c.csv")) == ("gbk", False)
    assert [r.b for n in "abc" for r in read_table(spark, str(tmp_path / f"{n}.csv")).collect()] == ['x "q" y', "x\ny", "中文"]


def test_kept_cells_are_the_masks(spark):
    import numpy as np

    from lorefield.operators import kept, masks, similarity

    rng = np.random.default_rng(3)
    side = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(40)], "id long, embedding array<double>")
    other = spark.createDataFrame([(i, rng.normal(size=6).tolist()) for i in range(25)], "id long, embedding array<double>")
    matrix = similarity.similarity_matrix(side, other).cache()
    cells = lambda m: {(r.y_id, r.x_id) for r in m.where("keep").collect()}
    pairs = lambda m: {(r.y_id, r.x_id) for r in m.collect()}
    for limits in ({}, {"broadcast_bytes": 0, "stripe_bytes": 400}):  # one side sent, or both in stripes
        for config in ({"low": 0.3, "high": 0.8}, {"k": 3}, {"k": 2, "axis": "y", "low": 0.2}):
            assert pairs(kept.kept_cells(side, other, **config, **limits)) == cells(masks.final_mask(matrix, **config))
        for axis in ("x", "y", "none"):
            assert kept.range_stats(side, other, 0.3, 0.8, axis, **limits).first() == masks.mask_stats(
                masks.threshold_mask(matrix, 0.3, 0.8), axis).first()
        plain, folded = (d.first().asDict() for d in (similarity.similarity_stats(matrix), similarity.collection_similarity(side, other, **limits)))
        assert all(abs(plain[k] - folded[k]) < 1e-9 for k in plain)
    assert kept.cell_count(side, other).first()[0] == 1000


def test_refreshed_chunks(spark):
    from lorefield.operators.states import LOG_SCHEMA, current_state
    from lorefield.plans.refresh import refresh_chunks

    def files(*rows):
        return spark.createDataFrame([(n, t, str(hash(t))) for n, t in rows], "file_name string, text string, checksum string")

    empty = spark.createDataFrame([], LOG_SCHEMA)
    first = refresh_chunks(files(("a", "# A\n\none"), ("b", "# B\n\ntwo"), ("c", "# C\n\nthree")), None, current_state(empty))
    chunks, log = first.chunks.cache(), first.events.cache()
    assert chunks.count() == 3 and {r.status for r in log.collect()} == {"complete"} and first.errors.count() == 0
    second = refresh_chunks(files(("a", "# A\n\none"), ("b", "# B\n\nnew"), ("d", None)), chunks, current_state(log))
    assert {r.file: r.status for r in second.events.collect()} == {"b": "complete", "d": "failed"}
    assert [r.file for r in second.errors.collect()] == ["d"]
    texts = {r.file_name: r.text for r in second.chunks.collect()}
    assert set(texts) == {"a", "b"} and "new" in texts["b"]
