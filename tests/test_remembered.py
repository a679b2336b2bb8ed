"""Answers and vectors that are asked for once."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lorefield.functions.encoders import HashingEncoder
from lorefield.operators import generation as G, remembered
from lorefield.plans.ingest import ingest_rows


def logged(path):
    """A model that notes its prompts and dies, worker and all, at prompt ``kill`` the first time."""
    def model(texts):
        for t in texts:
            with open(f"{path}/log", "a") as f:
                f.write(t + "\n")
            if t == "p57" and not os.path.exists(f"{path}/killed"):
                open(f"{path}/killed", "w").close()
                os._exit(1)
        return [t.upper() for t in texts]
    return model


def calls(path):
    return Counter(open(f"{path}/log").read().split())


def test_a_killed_task_costs_open_lists_only(spark, tmp_path):
    rows = spark.range(200).select("id", F.concat(F.lit("p"), (F.col("id") % 150).cast("string")).alias("prompt"))
    store, batch = f"{tmp_path}/store", 4
    with pytest.raises(Exception):
        G.call_model(rows, "prompt", logged(tmp_path), batch=batch, store=store)
    before = calls(tmp_path)
    kept = remembered.stored_answers(spark, store).count()
    got = G.call_model(rows, "prompt", logged(tmp_path), batch=batch, store=store).collect()
    assert len(got) == 200 and all(r.response[0].response == r.prompt.upper() and len(r.response) == 1 for r in got)
    after = calls(tmp_path)
    assert set(after) == {f"p{i}" for i in range(150)} and max(after.values()) <= 2
    twice = [p for p, n in after.items() if n == 2]
    # At most the lists that the tasks running then had open.
    assert 0 < len(twice) <= 8 * batch and kept >= len(before) - 8 * batch
    G.call_model(rows, "prompt", logged(tmp_path), batch=batch, store=store).collect()
    assert calls(tmp_path) == after
    remembered.compact_answers(spark, store)
    assert not [f for f in os.listdir(f"{store}/lists") if f.endswith(".parquet") and not f.startswith(".")]
    assert G.call_model(rows, "prompt", logged(tmp_path), store=store).count() == 200 and calls(tmp_path) == after


def test_stored_results_equal_those_without_a_store(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "bb"), (3, None), (4, "a"), (5, "")], "id int, prompt string")

    def fragile(texts):
        if "bb" in texts:
            raise RuntimeError("no bb")
        return [f"- question: Q{t}?\n- answer: A{t}" for t in texts]

    for workers in (1, 3):
        stored = G.call_model(rows, "prompt", fragile, rounds=2, retries=1, batch=2, workers=workers, store=f"{tmp_path}/{workers}")
        assert stored.columns == [*rows.columns, "response"]
        assert sorted(map(str, stored.collect())) == sorted(map(str, G.call_model(rows, "prompt", fragile, rounds=2, retries=1, batch=2).collect()))
    # More rounds than are stored are asked for, fewer are taken from the store.
    store = f"{tmp_path}/1"
    assert {len(r.response) for r in G.call_model(rows, "prompt", fragile, rounds=3, store=store).collect()} == {3}
    assert {len(r.response) for r in G.call_model(rows, "prompt", fragile, rounds=1, store=store).collect()} == {1}
    assert G.call_model(rows.limit(0), "prompt", fragile, store=f"{tmp_path}/none").count() == 0
    data = spark.createDataFrame([("q", "x"), ("q", "x")], "input string, role string")
    test = G.run_model_test(data, lambda ds: ['{"answer": "' + d["inputs"]["role"] + '"}' for d in ds], "m", store=f"{tmp_path}/test")
    assert [r.model_output for r in test.collect()] == ["x", "x"]


def test_equal_texts_are_encoded_once_over_runs(spark, tmp_path):
    def encoder(texts):
        with open(f"{tmp_path}/log", "a") as f:
            f.write("".join(f"<{t}>\n" for t in texts))
        return HashingEncoder(8)(texts)

    rows = spark.range(300).select("id", F.concat(F.lit("t"), (F.col("id") % 40).cast("string")).alias("text"))
    rows = rows.unionByName(spark.createDataFrame([(900, None), (901, "")], "id long, text string"))
    store = f"{tmp_path}/store"
    first = G.embed_texts(rows.where("id < 100"), "text", encoder, store=store)
    assert first.count() == 100 and set(calls(tmp_path).values()) == {1}
    got = {r.id: r.embedding for r in G.embed_texts(rows, "text", encoder, store=store).collect()}
    assert got == {r.id: r.embedding for r in G.embed_texts(rows, "text", HashingEncoder(8)).collect()}
    assert set(calls(tmp_path).values()) == {1} and len(calls(tmp_path)) == 41
    assert G.embed_texts(rows.limit(0), "text", encoder, store=f"{tmp_path}/none").count() == 0
    made = ingest_rows(rows.drop("id"), "{text}", "{text}", encoder, "f", store=store)
    assert made.count() == 302 and set(calls(tmp_path).values()) == {1}


def test_hot_keys_are_spread(spark, monkeypatch):
    monkeypatch.setattr(remembered, "HOT_SHARE", 4)
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    known = rows.select("k").distinct().withColumn("v", F.concat("k", F.lit("!")))
    got = remembered.spread_join(rows, known, "k")
    assert got.columns == ["k", "id", "v"] and got.count() == 40_000 and got.where("v <> concat(k, '!')").isEmpty()
    assert "_turn" in got._jdf.queryExecution().toString()
