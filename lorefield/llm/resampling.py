"""Importance resampling towards a target corpus over hashed word runs.

A feature is a run of one to three words; its bucket is the CRC-32 of its bytes.
A block of texts is one buffer of words joined by single spaces, in which every
feature is a slice. The block's distinct features are grouped by length into
two-dimensional byte matrices, the CRCs of a matrix are updated column by
column, and the buckets go back to the places of the features. Bucket counts are
added up by Spark; only the gains, one number a bucket, reach the driver.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lorefield.llm.common import batch_rows, fresh, stored

BUCKETS = 10_000
RUN = 3
SEED = 42
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
PERCENT = 5
#: Words of a block; a longer text spans blocks.
BLOCK = 1 << 17
#: A length with fewer distinct features takes no matrix: a column step costs more than a call per feature.
MATRIX_ROWS = 8

_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
#: Bytes of words as they are, A-Z in lower case, others as a space.
TO_WORDS = bytes(b if b in _WORD else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TO_WORDS).split()


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (table & np.uint32(1)))
    return table


CRC_TABLE = _crc_table()


def matrix_crc(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a byte matrix, one column at a time."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for j in range(rows.shape[1]):
        crc = CRC_TABLE[(crc ^ rows[:, j]) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return ~crc


def slice_crcs(buffer: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the slices of ``buffer``, by matrices of equal length."""
    out = np.zeros(len(starts), np.uint32)
    flat = np.frombuffer(buffer, np.uint8)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        n = int(lengths[rows[0]])
        if len(rows) < MATRIX_ROWS:
            out[rows] = [zlib.crc32(buffer[a:a + n]) for a in starts[rows].tolist()]
            continue
        windows, each = np.lib.stride_tricks.sliding_window_view(flat, n), max(1, (1 << 22) // n)
        for i in range(0, len(rows), each):
            out[rows[i:i + each]] = matrix_crc(windows[starts[rows[i:i + each]]])
    return out


def block_buckets(words: list[bytes], owner: np.ndarray, own: int, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(k, owners, buckets)`` of the runs of k = one, two and three words that start at the first ``own`` words.

    ``owner`` tells the document of each word; runs stay within a document.
    """
    buffer = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    runs = ids
    for k in range(1, RUN + 1):
        if k > 1:  # a run of k is the number of its first k - 1 words and its last word
            runs = runs[:len(words) - k + 1] * len(number) + ids[k - 1:]
        if not len(runs):
            return
        _, first, runs = np.unique(runs, return_index=True, return_inverse=True)
        crcs = slice_crcs(buffer, starts[first], ends[first + k - 1] - starts[first])
        at = np.flatnonzero(owner[:len(runs)] == owner[k - 1:])
        at = at[at < own]
        yield k, owner[at], (crcs % np.uint32(buckets)).astype(np.int64)[runs[at]]


def text_buckets(texts: list, buckets: int = BUCKETS, block: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(words, text numbers, buckets)`` of all features of ``texts``, block by block; a block holds whole texts or part of a long one."""
    words: list[bytes] = []
    owner: list[int] = []

    def cut(ready: int):
        ahead = min(len(words), ready + RUN - 1)
        yield from block_buckets(words[:ahead], np.array(owner[:ahead], np.int64), ready, buckets)
        del words[:ready], owner[:ready]

    for i, text in enumerate(texts):
        more = words_of(text)
        for a in range(0, len(more), block):
            part = more[a:a + block]
            words.extend(part)
            owner.extend([i] * len(part))
            if len(words) >= block + RUN:
                # The last words stay for the runs that reach over the cut.
                yield from cut(len(words) - RUN + 1)
    if words:
        yield from cut(len(words))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all features of ``texts(text)``; every task sends one row a bucket at most."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, got in text_buckets(batch_rows(b, "text")[0], buckets):
                total += np.bincount(got, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(counted, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, gain`` for every bucket: the floored log ratio of target to corpus shares, in thousandths."""
    every, total = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")), {}
    for name, df in (("s", docs), ("t", target)):
        counts = stored(bucket_counts(df, buckets), f"buckets-{name}")
        total[name] = float(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        every = every.join(F.broadcast(counts.select("bucket", F.col("n").alias(name))), "bucket", "left").fillna(0, [name])
    s, t = (F.col(c).cast("double") for c in "st")
    ratio = (t + 1) * F.lit(total["s"] + buckets) / ((s + 1) * F.lit(total["t"] + buckets))
    return every.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def document_weights(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row of ``docs``."""
    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = batch_rows(b, "text")[0]
            words, features, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for k, owners, got in text_buckets(texts, len(gains)):
                n = np.bincount(owners, minlength=len(texts))
                features += n
                # Sums of whole numbers far below 2^53: doubles are exact.
                weight += np.bincount(owners, gains[got].astype(np.float64), len(texts)).astype(np.int64)
                if k == 1:
                    words += n
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (words, features, weight))],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(weighed, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel_noise(doc_id: Column, seed: int = SEED) -> Column:
    """Floored Gumbel noise in thousandths, from the hash of seed and id; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """``rows`` with their place (from 1) in ``order``: sorted ranges, and the sizes of the ranges before.

    No task holds more than a range; one row per range reaches the driver. Rows
    must differ in ``order``, so that a run of equal rows can be cut.
    """
    spark, place = rows.sparkSession, fresh(rows, "place")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn(place, F.monotonically_increasing_id()), "ranges")
    part = F.shiftright(place, 33)
    sizes = sorted(map(tuple, ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()))
    before, at = [], 0
    for p, n in sizes:
        before.append((p, at))
        at += n
    offsets = F.broadcast(spark.createDataFrame(before, f"{place}_part bigint, {place}_before bigint"))
    index = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(offsets, part == F.col(f"{place}_part")).withColumn(out, F.col(f"{place}_before") + index + 1).drop(
        place, f"{place}_part", f"{place}_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
             seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_features, weight, score, rank``; ``rank`` is null for rows not drawn.

    Of the N rows with ``least_words`` words, ``percent * N div 100`` are drawn
    by the highest score, ties by the smaller ``doc_id`` (null last). Null and
    empty texts have no feature and weight 0; long texts are counted whole, in
    blocks. Repeated rows count, score and rank one by one; other columns are
    ignored. Empty ``docs`` give an empty table, an empty ``target`` counts no
    feature.
    """
    gains = np.zeros(buckets, np.int64)
    for bucket, gain in bucket_gains(docs, target, buckets).collect():
        gains[bucket] = gain
    rows = stored(document_weights(docs, gains).select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + gumbel_noise(F.col("doc_id"), seed)).alias("score"),
        F.monotonically_increasing_id().alias("turn")), "weights")
    able = F.col("n_words") >= least_words
    drawn = rows.where(able).count() * percent // 100
    placed = ranked(rows.where(able), [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("turn").asc()])
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*columns, rank.alias("rank")).unionByName(
        rows.where(~able).select(*columns, F.lit(None).cast("bigint").alias("rank")))
