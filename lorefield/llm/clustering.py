"""Dimension-sharded Lloyd clustering over whole-number vectors.

Vectors are dealt out as column blocks: a shard row holds some of the components
of a thousand vectors and never meets the others. A round has two passes. Every
shard computes exact partial distances to its slice of the centroids; these are
added up by chunk of vectors, and the sum's least entry is the assignment. The
assignments go back to the shards, which add up their own columns by cluster and
so renew their own slice of the centroids. Only the centroids, clusters times
dimensions whole numbers, reach the driver.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lorefield.llm.common import batch_rows, stored

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SEED = 2
#: Column blocks, and vectors of a shard row at most.
BLOCKS = 4
CHUNK = 1024
#: Components beyond this have squared distances beyond a long.
LARGEST = 1 << 27


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: whole-number components of the vectors of full length without null or non-finite components."""
    x = F.col("embedding")
    whole = F.transform(x, lambda c: F.floor(scale * c.cast("double")))
    ok = (F.size(x) == dimensions) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return vectors.where(F.coalesce(ok, F.lit(False))).select("vec_id", whole.alias("v"))


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the least id hashes, in hash order; equal ids in the order of their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(digest.alias("digest"), "v").orderBy("digest", "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _narrow(values: np.ndarray, *kinds) -> bytes:
    """The bytes of the first kind of number that holds all values."""
    for kind in kinds:
        if not values.size or np.iinfo(kind).min <= values.min() and values.max() <= np.iinfo(kind).max:
            return values.astype(kind).tobytes()
    raise ValueError(f"components beyond {LARGEST} have no exact distances")


def _widened(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // max(count, 1)}").astype(np.int64) if count else np.zeros(0, np.int64)


def deal_out(kept: DataFrame, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """``chunk, n, ids, slices``: the vectors of a chunk as one byte string per column block."""
    id_kind = kept.schema["vec_id"].dataType.simpleString()

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                part = b.slice(at, chunk)
                values = np.array(part.column(1).flatten(), np.int64).reshape(part.num_rows, -1)
                if np.abs(values).max() > LARGEST:
                    raise ValueError(f"components beyond {LARGEST} have no exact distances")
                slices = [_narrow(v, np.int16, np.int32) for v in np.array_split(values, blocks, axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int64()), pa.array([part.column(0).to_pylist()], pa.list_(part.schema.field(0).type)),
                     pa.array([slices], pa.list_(pa.binary()))], names=["n", "ids", "slices"])

    return kept.mapInArrow(dealt, f"n bigint, ids array<{id_kind}>, slices array<binary>").withColumn(
        "chunk", F.monotonically_increasing_id())


def partial_distances(shards: DataFrame, centroids: np.ndarray, blocks: int = BLOCKS) -> DataFrame:
    """``chunk, n, part``: squared distances of a shard's columns to its slice of every centroid."""
    slices = np.array_split(centroids, blocks, axis=1)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chunks, counts, numbers, data = batch_rows(b, "chunk", "n", "block", "slice")
            for key, n, block, values in zip(chunks, counts, numbers, data):
                c = slices[block]
                x = _widened(values, n * c.shape[1]).reshape(n, -1)
                most = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
                # Doubles are exact as long as every sum stays below 2^53.
                kind = np.float64 if int(most) ** 2 * 4 * c.shape[1] < 1 << 53 else np.int64
                x, c = x.astype(kind), c.astype(kind)
                d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
                part = _narrow(d.astype(np.int64), np.int32, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([n], pa.int64()), pa.array([part], pa.binary())],
                                                 names=["chunk", "n", "part"])

    return shards.select("chunk", "n", "block", "slice").mapInArrow(measured, "chunk bigint, n bigint, part binary")


def nearest(partial: DataFrame, clusters: int) -> DataFrame:
    """``chunk, clusters, distances``: the blocks of a chunk added up, and the least sum of every vector (ties: the smaller number)."""
    def added(table: pa.Table) -> pa.Table:
        n = table.column("n")[0].as_py()
        total = sum(_widened(p, n * clusters) for p in table.column("part").to_pylist()).reshape(n, clusters)
        best = total.argmin(1)
        return pa.table({"chunk": table.column("chunk")[:1], "clusters": pa.array([best.astype(np.int32).tobytes()], pa.binary()),
                         "distances": pa.array([total[np.arange(n), best].tobytes()], pa.binary())})

    return partial.groupBy("chunk").applyInArrow(added, "chunk bigint, clusters binary, distances binary")


def renewed(shards: DataFrame, assigned: DataFrame, centroids: np.ndarray, blocks: int = BLOCKS) -> np.ndarray:
    """New centroids: every shard adds up its own columns by cluster; a cluster without a vector stays."""
    k, edges = len(centroids), [s[0] for s in np.array_split(np.arange(centroids.shape[1]), blocks) if len(s)]
    widths = [s.shape[1] for s in np.array_split(centroids, blocks, axis=1)]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((k, w), np.int64) for w in widths]
        rows = [np.zeros(k, np.int64) for _ in widths]
        for b in batches:
            for n, block, values, best in zip(*batch_rows(b, "n", "block", "slice", "clusters")):
                cluster = np.frombuffer(best, np.int32)
                order = np.argsort(cluster, kind="stable")
                found, first = np.unique(cluster[order], return_index=True)
                x = _widened(values, n * widths[block]).reshape(n, -1)[order]
                sums[block][found] += np.add.reduceat(x, first, axis=0)
                rows[block] += np.bincount(cluster, minlength=k)
        for block, (s, r) in enumerate(zip(sums, rows)):
            c, j = np.nonzero(np.repeat(r[:, None] > 0, widths[block], 1))
            if len(c):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in ((j + edges[block]), c, s[c, j], r[c])], names=["dimension", "cluster", "total", "n"])

    totals = (shards.select("chunk", "n", "block", "slice").join(assigned.select("chunk", "clusters"), "chunk")
              .mapInArrow(added, "dimension bigint, cluster bigint, total bigint, n bigint")
              .groupBy("dimension", "cluster").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    new = centroids.copy()
    for r in totals.select("dimension", "cluster", F.expr("(total - pmod(total, n)) div n").alias("mean")).collect():
        new[r["cluster"], r["dimension"]] = r["mean"]
    return new


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
                    scale: int = SCALE, seed: int = SEED, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """One row per kept row of ``vectors(vec_id, embedding)``: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Rows with a null embedding, another length, or a null or non-finite component
    are left out. Fewer kept rows than ``clusters`` make fewer clusters, none
    give an empty table. Repeated rows are rows of their own; a null ``vec_id``
    is kept and hashes as empty text. Other columns are ignored. Components
    beyond 2^27 after scaling raise an error, as distances would leave a long.
    """
    spark, id_kind = vectors.sparkSession, vectors.schema["vec_id"].dataType.simpleString()
    kept = kept_vectors(vectors, dimensions, scale)
    centroids = first_centroids(kept, clusters, seed)
    k, blocks = len(centroids), min(blocks, dimensions)
    if not k:
        return spark.createDataFrame([], f"vec_id {id_kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    dealt = stored(deal_out(kept, blocks, chunk), "chunks")
    shards = stored(dealt.select("chunk", "n", F.posexplode("slices").alias("block", "slice")).repartitionByRange("block", "chunk"), "shards")
    for _ in range(rounds):
        assigned = stored(nearest(partial_distances(shards, centroids, blocks), k), "assigned")
        centroids = renewed(shards, assigned, centroids, blocks)
    assigned = stored(nearest(partial_distances(shards, centroids, blocks), k), "assigned")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).flatten()
            best, far = (np.frombuffer(b"".join(x), kind) for x, kind in zip(batch_rows(b, "clusters", "distances"), (np.int32, np.int64)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(best), pa.array(far)], names=["vec_id", "cluster", "distance"])

    rows = stored(dealt.select("chunk", "ids").join(assigned, "chunk").select("ids", "clusters", "distances")
                  .mapInArrow(told, f"vec_id {id_kind}, cluster int, distance bigint"), "clusters")
    inertia = {r["cluster"]: r["n"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    # One row per cluster.
    facts = spark.createDataFrame([(i, inertia.get(i), ",".join(map(str, c))) for i, c in enumerate(centroids.tolist())],
                                  "cluster int, cluster_inertia long, components string")
    facts = facts.select("cluster", "cluster_inertia", F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), F.sha2("components", 256).alias("centroid_sha256"))
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
