"""Resampling, quality and clustering against brute force, and on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from lorefield.llm import clustering, quality, queries, resampling

from . import edges


def runs_of(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return words, [b" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute_resample(docs, target, percent=5, least=20):
    count = lambda texts: Counter(zlib.crc32(r) % 10_000 for t in texts for r in runs_of(t)[1])
    s, t = count(x for _, x in docs), count(target)
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10_000) / ((s[b] + 1) * (n_t + 10_000))))
    rows, able = [], []
    for i, x in docs:
        words, runs = runs_of(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(zlib.crc32(r) % 10_000) for r in runs)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(runs), weight, score, None])
        if len(words) >= least:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=str)


def test_matrix_crc_equals_zlib():
    random.seed(3)
    words = [bytes(random.choices(range(256), k=n)) for n in [*range(1, 40)] * 20 + [5000, 5000, 1]]
    sizes = np.array([len(w) for w in words])
    got = resampling.slice_crcs(b"".join(words), np.cumsum(sizes) - sizes, sizes)
    assert got.tolist() == [zlib.crc32(w) for w in words]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_blocks_hold_every_feature_of_every_text(block):
    random.seed(block)
    texts = [" ".join(random.choices(["a", "b", "Ça", "x9", "--"], k=n)) for n in (0, 1, 2, 3, 4, 50, 0, 13)] + [None, "one,two", ""]
    want = Counter((i, zlib.crc32(r) % 10_000) for i, t in enumerate(texts) for r in runs_of(t)[1])
    got = Counter(p for _, owners, buckets in resampling.text_buckets(texts, block=block) for p in zip(owners.tolist(), buckets.tolist()))
    assert got == want


def test_resampling_equals_brute_force(spark):
    docs = spark.read.parquet(f"{edges.SF}/documents.parquet").select("doc_id", "text").collect()
    target = [r.text for r in spark.read.parquet(f"{edges.SF}/benchmark.parquet").collect()]
    got = queries.QUERIES["op11_resampling"](spark, edges.SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample([tuple(r) for r in docs], target)


def test_resampling_edges(spark):
    d = edges.docs(spark)
    rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    for target in (edges.items(spark), edges.items(spark).limit(0)):
        got = resampling.resample(d, target.withColumn("bucket", F.lit("x")), percent=100, least_words=1)
        want = brute_resample(rows, [r.text for r in target.collect()], 100, 1)
        assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == sorted((r[:4] for r in want), key=str)
        ranks = sorted(r.rank for r in got.collect() if r.rank is not None)
        assert ranks == list(range(1, sum(len(runs_of(t)[0]) > 0 for _, t in rows) + 1))
    assert resampling.resample(d.limit(0), edges.items(spark)).count() == 0


def test_ranks_over_many_ranges(spark):
    n = 5000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("id"), (F.col("id") % 3).alias("score"), F.lit("x").alias("place"))
    got = resampling.ranked(rows, [F.col("score").desc(), F.col("id").asc()])
    assert got.columns == ["id", "score", "place", "rank"]
    assert [(r.score, r.id) for r in got.orderBy("rank").collect()] == sorted(((r.score, r.id) for r in rows.collect()), key=lambda x: (-x[0], x[1]))
    assert [r.rank for r in got.select("rank").orderBy("rank").collect()] == list(range(1, n + 1))


def brute_clusters(rows, clusters, rounds, size):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    named = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(kept, key=named)[:clusters]]
    place = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        of = {}
        for _, v in kept:
            of.setdefault(place(v)[1], []).append(v)
        centres = [[sum(x) // len(of[k]) for x in zip(*of[k])] if k in of else c for k, c in enumerate(centres)]
    found = [(i, *place(v)) for i, v in kept]
    each = Counter()
    for _, far, k in found:
        each[k] += far
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, far, each[k], sum(each.values()), digest[k]) for i, far, k in found), key=str)


def test_clusters_equal_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{edges.SF}/embeddings.parquet").collect()]
    got = queries.QUERIES["op13_clustering"](spark, edges.SF)
    assert got.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"),
                          ("centroid_sha256", "string")]
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows, 40, 5, 64)


def test_cluster_edges(spark):
    random.seed(4)
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [nan, 1.0, 2.0]), (5, [1.0, -inf, 2.0]), (6, [1.0, 2.0]), (None, [0.1, 0.2, 0.3]), (None, [0.5, 0.2, -0.3])]
    same = [(7, [0.25, 0.5, -0.75])] * 9 + [(8, [-300.0, 400.7, 0.0]), (9, [3e5, -2e5, 1e5])]
    rows = odd + same + [(i, [random.uniform(-1, 1) for _ in range(3)]) for i in range(10, 90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("cluster", "chunk", "n", "ids", "v", "block", "distance"):
        df = df.withColumn(name, F.lit("x"))
    for clusters, rounds, blocks, chunk in ((40, 5, 4, 1024), (7, 3, 2, 5), (1, 0, 1, 1), (200, 2, 3, 16)):
        got = clustering.cluster_vectors(df, clusters, rounds, 3, blocks=blocks, chunk=chunk)
        assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows, clusters, rounds, 3)
    assert clustering.cluster_vectors(df.limit(0)).count() == clustering.cluster_vectors(df, dimensions=64).count() == 0


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.QUERIES["op12_quality"](spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.quality, r.predicted) for r in rows if r.held_out]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert sum(p == 0 for q, p in held if q == 0) >= 0.95 * sum(q == 0 for q, _ in held)
    # Calibrated: the mean score is the share of good rows.
    assert abs(np.mean([r.score for r in rows if r.held_out]) - np.mean([q for q, _ in held])) < 0.03


def test_labels_of_held_out_rows_are_not_learnt_from(spark):
    docs, labels = (spark.read.parquet(f"{edges.SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (edges.rows_of(quality.score_quality(docs, x).select("doc_id", "score")) for x in (labels, turned))
    assert a == b
    other = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y"))
    assert edges.rows_of(quality.score_quality(other.repartition(5), labels).select("doc_id", "score")) == a


def test_differences_cover_whole_texts():
    good, bad = b"the quick brown fox jumps over it. " * 40, b"BUY!! NOW!! CHEAP!! $$$ " * 40
    both = quality.Compressors(good, bad)
    plain = lambda data, d: sum(len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False,
                                                             write_content_size=False, write_dict_id=False).compress(data[i:i + 1024])) for i in range(0, len(data), 1024))
    for text in ("the quick fox " * 3, "CHEAP!! NOW!! " * 500, "é" * 3000, "x"):
        data = text.encode()
        assert both.difference(text) == (plain(data, bad) - plain(data, good)) / len(data)
    assert both.difference(None) == both.difference("") == 0
    long = "jumps over it. " * 1000
    assert both.difference(long + "NOW!! CHEAP!! " * 2000) < both.difference(long)


def test_curve_finds_the_weighted_logistic_fit():
    random.seed(8)
    x = [random.gauss(0, 1) for _ in range(4000)]
    y = [random.random() < 1 / (1 + math.exp(-(2 * v - 0.5))) for v in x]
    slope, offset = quality.fit_curve(x, y, [1.0] * len(x))
    assert abs(slope - 2) < 0.2 and abs(offset + 0.5) < 0.15
    p = 1 / (1 + np.exp(-(slope * np.array(x) + offset)))
    assert abs(p.mean() - np.mean(y)) < 0.01
    assert quality.fit_curve([], [], []) == (0.0, 0.0)
    doubled = quality.fit_curve(x + x, y + y, [1.0] * 8000)
    assert np.allclose(doubled, quality.fit_curve(x, y, [2.0] * 4000), atol=1e-6)


def test_quality_edges(spark):
    d = edges.docs(spark)
    one = spark.createDataFrame([(1, 1, "x"), (3, 0, "x"), (None, 1, "x"), (4, None, "x"), (4, 1, "x"), (5, 0, "x"), (5, 1, "x")], "doc_id long, quality int, text string")
    for labels in (one, one.limit(0), one.where("quality = 1")):
        got = quality.score_quality(d, labels)
        assert edges.rows_of(got.select("doc_id")) == edges.rows_of(d.select("doc_id"))
        assert got.dropna("any", subset=["held_out", "score", "predicted"]).count() == d.count()
        assert quality.score_quality(d.limit(0), labels).count() == 0
    empty = {r.score for r in quality.score_quality(d, one).where("doc_id in (2, 3)").collect()}
    assert len(empty) == 1
