"""What steps hold and move: bounds that do not grow with the tables."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lorefield.functions import splitting
from lorefield.operators import evaluation, kept, masks, pruned, search, similarity
from lorefield.session import TEXT_BYTES, TEXT_ROWS
from lorefield.sources import matrices
from workload import QUERIES
from workload.similarity import round6


def test_split_text_bounds_what_a_task_holds(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "10000")
    rows = spark.range(3000).select("id", F.when(F.col("id") % 7 != 0, F.concat(F.lit("words\n\n"), F.col("id").cast("string"))).alias("t"))
    got = {r["id"]: r["c"] for r in rows.select("id", splitting.split_text("t", "recursive", 6, 0).alias("c")).collect()}
    assert got == {i: None if i % 7 == 0 else ["words", str(i)] for i in range(3000)}
    assert int(spark.conf.get(key)) == TEXT_ROWS
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= TEXT_BYTES
    spark.conf.set(key, "100")
    splitting.split_text("t")
    assert spark.conf.get(key) == "100"
    spark.conf.set(key, "4096")


def test_chunks_leave_the_slices_as_arrow_data():
    most = []

    def made(text):
        most.append(text)
        return [text] * 2

    out = splitting._by_slices(pa.array(["a", None, "b"] * splitting.SLICE), made)
    assert out.to_pylist() == [["a"] * 2, None, ["b"] * 2] * splitting.SLICE and len(most) == 2 * splitting.SLICE
    assert splitting._by_slices(pa.array([], pa.string()), made).to_pylist() == []


def vectors(spark, n=120, dim=6):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=dim).tolist()) for i in range(n)]
    rows += [(3, rows[7][1]), (3, rows[3][1]), (None, rows[9][1]), (500, [0.0] * dim), (501, [float("nan")] * dim)]
    return spark.createDataFrame(rows, "id bigint, embedding array<double>")


def shown(df):
    return sorted(map(str, df.collect()))


def test_a_range_is_looked_up_where_other_masks_keep_cells(spark):
    e = vectors(spark).where("id IS NOT NULL")
    best = kept.kept_cells(e, e, k=4)
    want = kept.kept_and([best, kept.kept_cells(e, e, 0.2, 0.9)])
    got = kept.kept_and([best, kept.Range(e, e, 0.2, 0.9)])
    assert shown(got) == shown(want) and got.count() > 100
    assert shown(kept.kept_and([kept.Range(e, e, 0.2, 0.9), kept.Range(e, e, 0.5)])) == shown(
        kept.kept_and([kept.kept_cells(e, e, 0.2, 0.9), kept.kept_cells(e, e, 0.5)]))
    plan = kept.compose_kept((e, e), {"a": (e, e)}, {"a": {"k": 3}}, filters=["a"], temporary={"low": 0.1})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in text and "LeftSemi" in text


def test_cells_of_a_document_are_not_sent(spark):
    e = vectors(spark, 20).where("id < 20").dropDuplicates(["id"])
    doc = matrices.matrix_document(similarity.similarity_matrix(e, e), e.select("id"), e.select("id"), matrices.config_row(spark, "v", "v"))
    text = doc._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in text and "BuildRight" in text
    assert matrices.read_matrix_document(doc)[0].count() == 400


def test_folds_over_several_tiles(spark, monkeypatch):
    e = vectors(spark).where("id IS NOT NULL")
    whole = [shown(f) for f in _folds(e)]
    for rows, cells in ((1, 1), (7, 35), (64, 640)):
        block = similarity.Block
        x = block("", pa.array(range(120)), np.asarray([r["embedding"] for r in e.where("id < 120").dropDuplicates(["id"]).orderBy("id").collect()]))
        x.rows /= np.sqrt((x.rows ** 2).sum(1))[:, None]
        monkeypatch.setattr(similarity, "TILE_ROWS", rows)
        monkeypatch.setattr(similarity, "TILE_CELLS", cells)
        fold = similarity.Best(True, 5, "x")
        list(fold.add(x, x))
        best = {}
        for r in pa.Table.from_batches(list(fold.end())).to_pylist():
            best.setdefault(r["y_id"], []).append((-r["sim"], r["x_id"]))
        sim = np.round(np.clip(x.rows @ x.rows.T, 0, 1), 12) + 0.0
        for i in range(120):
            assert [j for _, j in sorted(best[i])] == sorted(range(120), key=lambda j: (-sim[i, j], j))[:5]
        assert sum(len(b) for b in similarity.Within(True, 0.2, 0.9).add(x, x)) == ((sim >= 0.2) & (sim <= 0.9)).sum()
    assert whole == [shown(f) for f in _folds(e, broadcast_bytes=0, stripe_bytes=500)]


def _folds(e, **limits):
    return [similarity.similarity_topk(e, e, 4, **limits), similarity.similarity_within(e, e, 0.2, 0.9, **limits),
            similarity.items_within(e.where("id <> 3"), e.where("id <> 3"), 0.2, 0.9, **limits)]


def test_folded_rows_validate_like_the_matrix(spark):
    e = vectors(spark)
    for y in (e, e.limit(7)):
        want = matrices.validate_matrix(similarity.similarity_matrix(e, y), e, e)
        assert shown(matrices.validate_matrix(similarity.items_within(e, y), e, e)) == shown(want)


def test_tasks_of_a_sent_side_grow_with_the_cells(spark, monkeypatch):
    monkeypatch.setattr(similarity, "TILE_CELLS", 100)
    monkeypatch.setattr(similarity, "TASK_CELLS", 1000)
    e = vectors(spark)
    assert similarity.sweep_stats(e.withColumn("collection", F.lit("a")), e.withColumn("collection", F.lit("a"))).count() == 1
    assert similarity.similarity_within(e, e, 0.2).rdd.getNumPartitions() >= 15


def test_paired_matrices_are_judged_where_pairs_are_formed(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    twice = vectors(spark, 30).where("id IS NOT NULL").coalesce(1).cache()
    short = lambda e: e.withColumn("embedding", F.slice("embedding", 1, 3))
    a, few = (twice, twice), (short(twice.where("id < 20")), short(twice))
    want = evaluation.confusion_from_kept(kept.kept_cells(*a, 0.3), kept.kept_cells(*few, 0.35), kept.cell_count(*a))
    assert shown(evaluation.confusion_of_ranges(a, few, (0.3, 1.0), (0.35, 1.0))) == shown(want)
    for e in (twice.where("id <> 3"), twice):
        a, b = (e, e), (short(e), short(e))
        m, n = similarity.similarity_matrix(*a), similarity.similarity_matrix(*b)
        diff = evaluation.matrix_difference(m, n).withColumn("sim", F.round("sim", 12))
        want = evaluation.difference_confusion(masks.threshold_mask(m, 0.3), n, masks.threshold_mask(diff, 0.05))
        assert shown(evaluation.difference_confusion_of_ranges(a, b, (0.3, 1.0), (0.05, 1.0))) == shown(want)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_matrices_are_subtracted_where_pairs_are_formed(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    twice = vectors(spark, 30).where("id IS NOT NULL").coalesce(1).cache()
    short = lambda e: e.withColumn("embedding", F.slice("embedding", 1, 3))
    once = twice.where("id <> 3")
    for x, y in ((once, once), (twice, twice), (twice, once.where("id < 9"))):
        a, b = (x, y), (short(x), short(y))
        want = evaluation.matrix_difference(similarity.similarity_matrix(*a), similarity.similarity_matrix(*b))
        assert shown(evaluation.matrix_difference_of_sides(a, b)) == shown(want)
    text = evaluation.matrix_difference_of_sides((once, once), (short(once), short(once)))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text
    one = similarity.paired(once, short(once))
    whole = shown(similarity.paired_difference(one, one))
    assert shown(similarity.paired_difference(one, one, broadcast_bytes=0, stripe_bytes=1000)) == whole
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_queries_are_copied_once_per_stripe(spark, monkeypatch):
    monkeypatch.setattr(pruned, "CHUNK", 7)
    e = vectors(spark).where("id IS NOT NULL AND id <> 3")
    asked, index = e.withColumnRenamed("id", "query_id"), pruned.build_index(e, pivots=8, rings=6, slab_rows=4)
    want = shown(search.vector_search(e, asked, 5))
    for limits in ({}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "stripe_bytes": 2000}):
        assert shown(pruned.search_index(index, asked, 5, **limits)) == want
        assert shown(pruned.cells_within(index, e, 0.2, 0.9, **limits)) == shown(similarity.similarity_within(e, e, 0.2, 0.9))
    parts, every = pruned._parts(index), pruned._asked(index, asked, "query_id", "embedding", np.inf)
    first, several, n = pruned._spans(parts.rows, 60)
    stripes = [np.flatnonzero((first <= s) & (s < first + several)) for s in range(n)]
    assert n <= 4 < len(parts.number) and sorted(np.concatenate(stripes)) == list(range(len(parts.number)))
    assert pruned._copies(every, parts, stripes, 0).count() == n * asked.count()
    assert pruned.reached_parts(index, every).count() == len(parts.number) * asked.count()


def test_large_parts_have_stripes_of_their_own():
    first, several, n = pruned._spans(np.array([3, 4, 25, 2, 9, 10]), 10)
    assert first.tolist() == [0, 0, 1, 4, 5, 6] and several.tolist() == [1, 1, 3, 1, 1, 1] and n == 7


def test_held_hits_narrow_the_radius():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    x[40:80] = x[40]
    x /= np.sqrt((x ** 2).sum(1))[:, None]
    want = np.round(x @ x.T, 12) + 0.0
    for held in (1, 50, 10 ** 6):
        pruned.HELD, before = held, pruned.HELD
        slabs = ((0, True, pa.array(range(a, a + 60)), x[a:a + 60], np.zeros((60, 0))) for a in range(0, 300, 60))
        asked = pa.array(range(300)), x, np.zeros((300, 0)), np.full(300, np.inf), np.ones((300, 1), bool)
        got = {}
        for r in pa.Table.from_batches(list(pruned._matched(asked, slabs, np.arange(8), False, 5, "id"))).to_pylist():
            got.setdefault(r["query_id"], []).append(r["id"])
        pruned.HELD = before
        assert got == {i: sorted(range(300), key=lambda j: (-want[i, j], j))[:5] for i in range(300)}


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "stripe_bytes": 1000}, {"broadcast_bytes": 6000, "stripe_bytes": 1000}])
def test_rows_of_a_matrix_are_formed_with_its_pairs(spark, limits, monkeypatch):
    monkeypatch.setattr(matrices, "BLOCK", 16)
    monkeypatch.setattr(similarity, "TILE_CELLS", 100)
    e = vectors(spark, 70).where("id IS NOT NULL").dropDuplicates(["id"]).withColumn("id", F.col("id") * 3 + 1)
    few = e.where("id % 2 = 1")
    x_at, y_at = matrices.placed(e, e.select("id")), matrices.placed(few, few.select("id"))
    rows = similarity.similarity_matrix(x_at, y_at, block=matrices.BLOCK, **limits)
    args = few.select("id"), e.select("id"), matrices.config_row(spark, "v", "v")
    got, want = matrices.matrix_document(rows, *args), matrices.matrix_document(similarity.similarity_matrix(e, few), *args)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    # No cell is moved, and none is a row before it is read.
    assert "collect_list" not in got._jdf.queryExecution().executedPlan().toString()
    cells = matrices.read_matrix_document(got)[0].collect()
    assert len(cells) == e.count() * few.count()


def test_the_document_query_moves_no_cells(spark, tmp_path):
    vectors(spark, 40).where("id IS NOT NULL").dropDuplicates(["id"]).selectExpr("id AS vec_id", "embedding", "id % 3 AS label").write.parquet(
        str(tmp_path / "embeddings.parquet"))
    df = QUERIES["matrix_document"](spark, str(tmp_path))
    assert "collect_list" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("other", [3, None])
def test_a_document_of_repeated_or_missing_ids_fails(spark, other):
    e = vectors(spark, 20).where("id < 20").dropDuplicates(["id"])
    e = e.unionByName(e.where("id = 4").withColumn("id", F.lit(other).cast(e.schema["id"].dataType)))
    at, items = matrices.placed(e, e.select("id")), e.select("id")
    doc = matrices.matrix_document(similarity.similarity_matrix(at, at, block=8), items, items, matrices.config_row(spark, "v", "v"))
    with pytest.raises(Exception, match="differ in length"):
        matrices.read_matrix_document(doc)[0].collect()


def test_values_are_rounded_as_by_decimals(spark):
    rng = np.random.default_rng(3)
    sims = np.round(rng.uniform(-1, 1, 5000), 12)
    ties = np.round(np.arange(-2000, 2000) / 1e6 + 5e-7, 12)
    values = [*sims, *ties, *(sims[:2500] - sims[2500:]), *(ties[1:] - ties[:-1] + 0.1234565), *rng.uniform(-2000, 2000, 500), *(rng.uniform(-1, 1, 500) * 1e-6),
              0.0, -0.0, 0.5e-6, -0.5e-6, 1.4999999999e-6, 1e300, -1e19, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    got = df.select(F.col("v"), (round6("v") + F.lit(0.0)).alias("a"), (F.round("v", 6) + F.lit(0.0)).alias("b"))
    assert got.where("NOT (a <=> b)").collect() == [] and got.count() == len(values)
    plan = got.select("a")._jdf.queryExecution().optimizedPlan().toString()
    assert "rint" in plan.lower()


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0, "stripe_bytes": 3000}])
def test_pruned_cells_leave_in_runs_by_value(spark, limits, monkeypatch):
    e = vectors(spark, 80).where("id IS NOT NULL")
    index = pruned.build_index(e, pivots=4)
    want = sorted(map(tuple, pruned.cells_within(index, e, 0.3, 0.9, **limits).collect()))
    for run in (1, 40, 1 << 20):
        monkeypatch.setattr(pruned, "ORDERED_CELLS", run)
        assert sorted(map(tuple, pruned.cells_within(index, e, 0.3, 0.9, by_value=True, **limits).collect())) == want and len(want) > 100


def test_a_run_of_hits_is_by_value(monkeypatch):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(60, 6))
    v /= np.linalg.norm(v, axis=1)[:, None]
    ids, angles, reach = pa.array(range(60)), np.zeros((60, 0)), np.ones((60, 3), bool)
    slabs = [(p, False, ids.slice(20 * p, 20), v[20 * p:20 * p + 20], np.zeros((20, 0))) for p in range(3)]
    found = lambda **how: list(pruned._matched((ids, v, angles, np.full(60, np.arccos(0.2)), reach), iter(slabs), np.arange(6), True, None, "x_id", **how))
    rows = lambda batches: sorted(tuple(r.values()) for b in batches for r in b.to_pylist())
    plain = found()
    monkeypatch.setattr(pruned, "ORDERED_CELLS", 300)
    got = found(by_value=True)
    assert rows(got) == rows(plain) and len(got) > 2
    assert all(np.all(np.diff(b.column("score")) >= 0) for b in got[:-1]) and sum(b.num_rows for b in plain) > 600
