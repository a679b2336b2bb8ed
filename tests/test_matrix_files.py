"""What the cells of a matrix take on disk, and that a smaller form holds the same cells."""

import glob
import math
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lorefield.operators import evaluation, kept, similarity
from lorefield.sources import matrices


def size(path) -> int:
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def stored(spark, at, n: int) -> str:
    """An embeddings table of random vectors."""
    made = np.random.default_rng(7).normal(size=(n, 64)).astype(np.float32)
    table = [(i, v.tolist(), i % 10) for i, v in enumerate(made)]
    spark.createDataFrame(table, "vec_id bigint, embedding array<float>, label int").coalesce(1).write.parquet(f"{at}/embeddings.parquet")
    return str(at)


@pytest.mark.parametrize("name, n, most", [("apply_mask", 7000, 7.0), ("similarity_matrix", 4000, 4.2)])
def test_results_take_less_room(spark, tmp_path, name, n, most):
    out = str(tmp_path / "out")
    entry.queries()[name](spark, stored(spark, tmp_path, n)).write.parquet(out)
    cells = spark.read.parquet(out).count()
    assert cells == n * n if name == "similarity_matrix" else cells > n * n / 10
    assert size(out) / cells < most


def test_cells_by_value_are_the_same_cells(spark):
    made = np.random.default_rng(3).normal(size=(60, 8)).round(1)
    made[7] = made[3]
    made[11] = 0.0
    e = spark.createDataFrame([(i % 55 if i < 58 else None, v.tolist(), f"c{i % 3}") for i, v in enumerate(made)],
                              "id bigint, embedding array<double>, collection string").cache()
    half = e.withColumn("embedding", F.slice("embedding", 1, 4))
    forms = [lambda **o: similarity.similarity_matrix(e, e, **o), lambda **o: kept.kept_cells(e, e, 0.1, 0.6, **o),
             lambda **o: similarity.matrix_sweep(e, e, **o), lambda **o: similarity.similarity_within(e, e, 0.2, floor0=False, **o)]
    want = [rows(f()) for f in forms]
    for limits in ({}, {"broadcast_bytes": 1, "stripe_bytes": 1500}):
        assert [rows(f(by_value=True, **limits)) for f in forms] == want
    alone, short = (d.where("id >= 5") for d in (e, half))
    apart = [rows(evaluation.matrix_difference_of_sides((alone, alone), (short, short), by_value=v)) for v in (False, True)]
    assert apart[0] == apart[1]


@pytest.mark.parametrize("run, square, tile", [(1 << 22, 4096, 1 << 20), (40, 7, 12), (8, 16, 1 << 20), (400, 5, 1 << 20)])
def test_runs_by_value_hold_every_cell_once(monkeypatch, run, square, tile):
    for name, value in (("ORDERED_CELLS", run), ("SQUARE_ROWS", square), ("TILE_CELLS", tile)):
        monkeypatch.setattr(similarity, name, value)
    made = np.random.default_rng(5).normal(size=(31, 8))
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    x, y = (similarity.Block("c", pa.array(range(at, at + len(part))), part) for at, part in ((0, made), (100, made[:23])))
    for form in (similarity.Cells, lambda *a: similarity.Within(a[0], 0.1, 0.6, *a[1:]), lambda *a: similarity.Apart(a[0], 4, *a[1:])):
        plain, ordered = ([b.to_pydict() for b in form(*a).add(x, y)] for a in ((True,), (True, True)))
        cells = [sorted((i, j, v) for b in part for i, j, v in zip(b["y_id"], b["x_id"], b["sim"])) for part in (plain, ordered)]
        assert [c[:2] for c in cells[0]] == [c[:2] for c in cells[1]] and len(cells[0]) == len(set(c[:2] for c in cells[0]))
        assert np.allclose([c[2] for c in cells[0]], [c[2] for c in cells[1]], atol=1e-12, rtol=0)
    if run < 1 << 22 and tile == 1 << 20:
        assert any(b["sim"] == sorted(b["sim"]) and len(b["sim"]) > 1 for b in ordered)


def test_export_holds_every_value(spark, tmp_path):
    values = [0.0, 1.0, 0.123456789012, 0.1 + 0.2, 1 / 3, -0.25, 1e300, -1e-13, math.inf, math.nan, None, 5e6]
    matrix = spark.createDataFrame([(i, i + 1, v) for i, v in enumerate(values)], "y_id bigint, x_id bigint, sim double")
    matrices.export_matrix(matrix, matrices.config_row(spark, "a", "b"), str(tmp_path / "m"))
    cells, config = matrices.import_matrix(spark, str(tmp_path / "m"))
    assert cells.schema.simpleString() == matrix.schema.simpleString()
    assert repr(rows(cells)) == repr(rows(matrix))
    assert config.first()["x_collection"] == "a"


def test_earlier_exports_are_read(spark, tmp_path):
    matrix = spark.createDataFrame([(0, 1, 0.5), (1, 0, None)], "y_id bigint, x_id bigint, sim double")
    matrix.write.parquet(str(tmp_path / "m/cells"))
    matrices.config_row(spark, "a", "b").write.parquet(str(tmp_path / "m/config"))
    assert rows(matrices.import_matrix(spark, str(tmp_path / "m"))[0]) == rows(matrix)


def test_export_takes_less_room(spark, tmp_path):
    e = spark.read.parquet(f"{stored(spark, tmp_path, 4000)}/embeddings.parquet").withColumnRenamed("vec_id", "id")
    matrices.export_matrix(similarity.similarity_matrix(e, e, by_value=True), matrices.config_row(spark, "a", "b"), str(tmp_path / "m"))
    assert size(tmp_path / "m/cells") / 4000 ** 2 < 4.4
