"""Pruned search, shredded metadata, bucketed collections and streams that remember ids."""

import glob
import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorefield.functions import conditions
from lorefield.operators import collections as C, pruned, search, shredded, similarity
from lorefield.sources import bucketed
from lorefield.streaming import jobs


def table(spark, rows, kind="array<double>", id_kind="int", name="id"):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], f"{name} {id_kind}, embedding {kind}")


def clustered(n, dim, centres, spread, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    return middle[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dim))


def plain(df, digits=9):
    return sorted(tuple(round(v, digits) + 0.0 if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def vectors(spark):
    rows = clustered(5000, 24, 40, 0.1, 3)
    rows[7], rows[8], rows[9][2] = 0, rows[10], np.nan
    rows[200:900] = rows[200]  # a large group of copies
    return table(spark, enumerate(rows)).cache()


@pytest.mark.parametrize("options", [{}, {"pivots": 24, "rings": 24, "slab_rows": 64}, {"pivots": 1, "rings": 1, "slab_rows": 7}])
def test_pruned_search_equals_the_full_one(spark, vectors, options):
    index = pruned.build_index(vectors, **options)
    assert index.rows.agg(F.sum("n")).first()[0] == vectors.count() == index.parts.agg(F.sum("n")).first()[0]
    queries = vectors.where("id % 50 = 0 or id in (7, 9, 10)").withColumnRenamed("id", "query_id")
    for k in (1, 6):
        assert plain(pruned.search_index(index, queries, k)) == plain(search.vector_search(vectors, queries, k))


def test_pruned_cells_equal_the_full_matrix(spark, vectors):
    index = pruned.build_index(vectors, pivots=16, rings=12, slab_rows=100)
    some = vectors.where("id % 40 = 0 or id in (7, 9, 10)")
    for low, high, floor0 in ((0.95, 1.0, True), (0.5, 0.9, False), (0.0, 0.02, True), (-1.0, -0.4, False)):
        assert plain(pruned.cells_within(index, some, low, high, floor0=floor0)) == plain(similarity.similarity_within(vectors, some, low, high, floor0=floor0))


def test_most_cells_of_clustered_vectors_are_skipped(spark):
    rows = clustered(6000, 32, 50, 0.1, 9)
    df = table(spark, enumerate(rows), "array<float>")
    index = pruned.build_index(df, pivots=32)
    queries = df.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    met = pruned.searched_parts(index, queries, 10).join(index.parts, "part").agg(F.sum("n")).first()[0]
    assert met < 0.2 * 6000 * 300
    within = pruned.reached_parts(index, pruned._asked(index, queries, "query_id", "embedding", float(np.arccos(0.9))))
    assert within.join(index.parts, "part").agg(F.sum("n")).first()[0] < 0.2 * 6000 * 300
    plan = index.rows.where(F.col("part").isin([3, 5]))._jdf.queryExecution().toString()
    assert "PushedFilters: [In(part, [3,5])]" in plan


def test_pruned_edges(spark):
    few = table(spark, [(1, [1, 0]), (2, [1, 0]), (3, [0, 0])])
    asked = table(spark, [(5, [2, 0]), (6, [0, 0]), (7, [-1, 0])], name="query_id")
    index = pruned.build_index(few)
    assert plain(pruned.search_index(index, asked, 5)) == plain(search.vector_search(few, asked, 5))
    assert pruned.search_index(index, asked.limit(0), 3).count() == 0
    empty = pruned.build_index(few.limit(0))
    assert pruned.search_index(empty, asked, 3).count() == 0 and pruned.cells_within(empty, few, 0.5).count() == 0
    with pytest.raises(ValueError):
        pruned.search_index(index, asked, 0)
    with pytest.raises(Exception, match="vector sizes differ"):
        pruned.search_index(index, table(spark, [(1, [1, 2, 3])], name="query_id"), 1).collect()
    with pytest.raises(Exception, match="vector sizes differ"):
        pruned.build_index(table(spark, [(1, [1, 2]), (2, [1, 2, 3])]))
    named = table(spark, [("a", [1, 0]), ("b", [0, 1])], id_kind="string")
    assert [tuple(r) for r in pruned.search_index(pruned.build_index(named), named.withColumnRenamed("id", "query_id"), 1).orderBy("query_id").collect()] == [
        ("a", "a", 1.0, 1), ("b", "b", 1.0, 1)]


VALUES = [None, "", " ", "De", "de", "x de y", "12", "3.5", " 7 ", "nan", "inf", "-1e3", "1_000", "İ", "Straße", "a.b"]


@pytest.fixture(scope="module")
def described(spark, tmp_path_factory):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        meta = {k: rng.choice(VALUES) for k in ("lang", "n.chars", "Key 3", "rare") if rng.random() < {"rare": 0.05}.get(k, 0.8)}
        rows.append((str(i), f"d{i}", [1.0], None if i % 97 == 0 else meta))
    plain_rows = spark.createDataFrame(rows, "id string, document string, embedding array<float>, metadata map<string,string>")
    path = f"{tmp_path_factory.mktemp('shredded')}/rows"
    shredded.shred(plain_rows).write.parquet(path)
    return plain_rows.cache(), spark.read.parquet(path)


def test_shredding_loses_nothing(described):
    rows, stored = described
    assert set(shredded.shredded_keys(stored)) == {"lang", "n.chars", "Key 3"} and shredded.frequent_keys(rows, 0.01) != []
    assert {f.name for f in stored.schema} >= {"key0_value", "key0_text", "key0_number", "metadata"}
    back = {r.id: r.metadata for r in shredded.unshred(stored).collect()}
    assert back == {r.id: r.metadata for r in rows.collect()}
    assert shredded.unshred(rows).columns == rows.columns


@pytest.mark.parametrize("op", conditions.TEXT_OPERATORS + conditions.NUMBER_OPERATORS + conditions.DATE_OPERATORS)
def test_both_layouts_keep_the_same_rows(described, op):
    rows, stored = described
    for names, value in itertools.product((["lang"], ["n.chars"], ["rare"], ["lang", "Key 3"], ["nowhere"], []), ("de", "12", "", "nan", "-5", "STRASSE", None)):
        spec = {"logical_operator": "and", "conditions": [{"name": names, "comparison_operator": op, "value": value}]}
        want = sorted(r.id for r in conditions.metadata_filter(rows, spec).select("id").collect())
        assert sorted(r.id for r in shredded.shredded_filter(stored, spec).select("id").collect()) == want, spec


def test_joined_conditions_agree(described):
    rows, stored = described
    rng = random.Random(6)
    ops = conditions.TEXT_OPERATORS + conditions.NUMBER_OPERATORS
    for logical in ("and", "or"):
        for _ in range(12):
            spec = {"logical_operator": logical, "conditions": [{"name": [rng.choice(["lang", "n.chars", "rare"])], "comparison_operator": rng.choice(ops),
                                                                 "value": rng.choice(["de", "7", "x", ""])} for _ in range(rng.randint(0, 3))]}
            want = sorted(r.id for r in conditions.metadata_filter(rows, spec).select("id").collect())
            assert sorted(r.id for r in shredded.shredded_filter(stored, spec).select("id").collect()) == want, spec


@pytest.mark.parametrize("op, value, pushed", [("is", "de", "EqualTo(key{0}_text,de)"), (">", "5", "GreaterThan(key{0}_number,5.0)"), ("≤", "5", "LessThanOrEqual(key{0}_number,5.0)"),
                                               ("start with", "d", "StringStartsWith(key{0}_text,d)"), ("contains", "e", "StringContains(key{0}_text,e)"),
                                               ("is not", "de", "Or(IsNull(key{0}_text),Not(EqualTo(key{0}_text,de)))")])
def test_conditions_reach_the_scan(described, op, value, pushed):
    stored = described[1]
    stem = shredded.shredded_keys(stored)["lang"].removeprefix("key")
    spec = {"logical_operator": "and", "conditions": [{"name": ["lang"], "comparison_operator": op, "value": value}]}
    plan = shredded.shredded_filter(stored, spec).select("id")._jdf.queryExecution().executedPlan().toString()
    assert pushed.format(stem) in plan[plan.index("PushedFilters"):]
    read = plan[plan.index("ReadSchema"):]
    assert "metadata" not in read and "embedding" not in read


def partition_files(path):
    return {p: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{p}/*.parquet")} for p in glob.glob(f"{path}/rows/bucket=*")}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = f"{tmp_path}/c"
    rows = spark.createDataFrame([(str(i), f"d{i}", {"k": str(i)}) for i in range(300)] + [(None, "none", None)], "id string, document string, metadata map<string,string>")
    bucketed.write_buckets(rows, path, 32)
    assert plain_rows(bucketed.open_buckets(spark, path)) == plain_rows(rows)
    before = partition_files(path)
    updates = spark.createDataFrame([("5", "new", None), ("77", None, {"z": "1"}), ("unknown", "x", None)], "id string, document string, metadata map<string,string>")
    done = bucketed.update_buckets(spark, path, updates)
    want = C.update_rows(rows, updates)
    assert plain_rows(bucketed.open_buckets(spark, path)) == plain_rows(want)
    after = partition_files(path)
    changed = {p for p in before if before[p] != after[p]}
    assert 1 <= len(done) <= 2 and changed == {f"{path}/rows/bucket={b}" for b in done}
    gone = spark.createDataFrame([("9",), ("5",), ("nobody",)], "id string")
    done = bucketed.delete_from_buckets(spark, path, gone)
    assert plain_rows(bucketed.open_buckets(spark, path)) == plain_rows(C.delete_rows(want, gone))
    last = partition_files(path)
    assert {p for p in after if after[p] != last.get(p)} == {f"{path}/rows/bucket={b}" for b in done}
    assert bucketed.update_buckets(spark, path, updates.where("id = 'unknown'")) == [] and partition_files(path) == last
    assert [r.document for r in bucketed.lookup_in_buckets(spark, path, ["77", "9", "zz"]).collect()] == ["d77"]


def test_a_bucket_can_become_empty(spark, tmp_path):
    path = f"{tmp_path}/c"
    rows = spark.createDataFrame([(str(i), f"d{i}") for i in range(20)], "id string, document string")
    bucketed.write_buckets(rows, path, 4)
    one = bucketed.touched_buckets(spark, path, rows.where("id = '3'"))[0]
    gone = rows.where(bucketed.bucket_of("id", 4) == one).select("id")
    assert bucketed.delete_from_buckets(spark, path, gone) == [one]
    assert plain_rows(bucketed.open_buckets(spark, path)) == plain_rows(rows.where(bucketed.bucket_of("id", 4) != one))


def plain_rows(df):
    return sorted(str(r.asDict()) for r in df.collect())


GIVEN = "id string, document string, embedding array<float>, seen timestamp"


def arrive(spark, path, rows):
    spark.createDataFrame(rows, GIVEN.replace("timestamp", "string")).withColumn("seen", F.col("seen").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def ingest(spark, tmp_path, **options):
    stream = spark.readStream.schema(GIVEN).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = jobs.streaming_ingest(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", **options)
    query.awaitTermination()
    return query


def test_ids_seen_are_state_of_the_stream(spark, tmp_path):
    for k, ids in enumerate((["a", "b", "b"], ["b", "c", None], ["a", None], ["d"])):
        arrive(spark, f"{tmp_path}/in", [(i, f"d{k}", [1.0], "2024-01-01 00:00:00") for i in ids])
        query = ingest(spark, tmp_path)
    assert spark.conf.get(jobs.PROVIDER, None) != jobs.ROCKSDB  # the session's own setting is back
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((str(r.id), r.document) for r in rows) == [("None", "d1"), ("a", "d0"), ("b", "d0"), ("c", "d1"), ("d", "d3")]
    state = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]][-1][0]
    assert state["numRowsTotal"] == 5 and "rocksdb" in str(state["customMetrics"]).lower()
    # A batch reads what it brings and nothing that was written before.
    assert query.recentProgress[-1]["sources"][0]["numInputRows"] <= 1


def test_a_replayed_batch_gives_the_same_rows(spark, tmp_path):
    arrive(spark, f"{tmp_path}/in", [("a", "d0", [1.0], "2024-01-01 00:00:00")])
    ingest(spark, tmp_path)
    arrive(spark, f"{tmp_path}/in", [("a", "d1", [1.0], "2024-01-01 00:00:00"), ("b", "d1", [1.0], "2024-01-01 00:00:00")])
    ingest(spark, tmp_path)
    before = plain_rows(spark.read.parquet(f"{tmp_path}/out"))
    last = max(int(f) for f in os.listdir(f"{tmp_path}/checkpoint/commits") if f.isdigit())
    for f in (f"{tmp_path}/checkpoint/commits/{last}", f"{tmp_path}/checkpoint/commits/.{last}.crc"):
        os.remove(f)  # as if the run had failed before its commit
    ingest(spark, tmp_path)
    assert plain_rows(spark.read.parquet(f"{tmp_path}/out")) == before and len(before) == 2


def test_ids_are_forgotten_after_their_time(spark, tmp_path):
    for day in ("01", "03", "20", "21"):
        arrive(spark, f"{tmp_path}/in", [("a", day, [1.0], f"2024-01-{day} 00:00:00"), (day, day, [1.0], f"2024-01-{day} 00:00:00")])
        ingest(spark, tmp_path, event_time="seen", keep_for="7 days")
    rows = spark.read.parquet(f"{tmp_path}/out").where("id = 'a'").collect()
    assert "01" in {r.document for r in rows} and "03" not in {r.document for r in rows} and len(rows) == 2
    with pytest.raises(ValueError):
        jobs.first_arrivals(spark.readStream.schema(GIVEN).parquet(f"{tmp_path}/in"), keep_for="1 day")
