"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A document is a multiset of paragraphs. Each paragraph gives a 64-bit digest
that is added to three cells of a sketch (count, xor of digests, xor of check
hashes). Two sketches of equal size subtract cell by cell; what both documents
share cancels, and peeling cells of count +1 or -1 recovers the digests of the
paragraphs in which they differ. When peeling stops early both documents are
sketched anew at twice the size, so a comparison always ends with the exact
difference.
"""

import re
from base64 import b64encode
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lorefield.llm.common import batch_rows, same, stored

CELLS = 24  # of the smallest sketch; a multiple of the three parts
PARTS = 3
#: Longest paragraph; a longer line is cut after the last word before that.
PARAGRAPH = 64
#: Ids from which the bounds of the ordering are taken, on average.
RANGE_SAMPLE = 20_000
#: Comparisons made together.
TOGETHER = 256

_PIECE = re.compile(r"[^\n]{1,%d}(?=[ \n]|\Z)|[^\n]{1,%d}" % (PARAGRAPH, PARAGRAPH))
_SALTS = [np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1) for k in range(PARTS + 1)]
_CELL = np.dtype([("count", "<i4"), ("digest", "<u8"), ("check", "<u4")])


def paragraphs(text: str) -> list[str]:
    """Lines of a text, long ones cut between words; outer spaces and empty ones left out."""
    return [p for p in (m.strip(" ") for m in _PIECE.findall(text)) if p]


def digests(text: str) -> np.ndarray:
    """A digest per paragraph; a further copy of a paragraph has a digest of its own."""
    seen, out = Counter(), []
    for p in paragraphs(text):
        n = seen[p]
        seen[p] = n + 1
        raw = p.encode("utf-8", "surrogatepass")
        out.append(blake2b(raw, digest_size=8, salt=n.to_bytes(8, "little") if n else b"").digest())
    return np.frombuffer(b"".join(out), "<u8").astype(np.uint64)


def _mixed(x: np.ndarray, salt: np.uint64) -> np.ndarray:
    x = x + salt
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _check(items: np.ndarray) -> np.ndarray:
    return _mixed(items, _SALTS[PARTS]) >> np.uint64(32)


class Sketches:
    """One sketch per row, all of one size."""

    def __init__(self, rows: int, cells: int):
        self.cells = cells
        self.count = np.zeros(rows * cells, np.int64)
        self.digest = np.zeros(rows * cells, np.uint64)
        self.check = np.zeros(rows * cells, np.uint64)

    def add(self, row: np.ndarray, items: np.ndarray, signs: np.ndarray | int) -> None:
        """Add (sign 1) or subtract (-1) items in their rows' sketches."""
        part = self.cells // PARTS
        check = _check(items)
        for k in range(PARTS):
            at = row * self.cells + k * part + (_mixed(items, _SALTS[k]) % np.uint64(part)).astype(np.int64)
            np.add.at(self.count, at, signs)
            np.bitwise_xor.at(self.digest, at, items)
            np.bitwise_xor.at(self.check, at, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(row, digest, sign)`` of the recovered items, and by row whether nothing is left."""
        found = []
        look = np.flatnonzero(self.count)
        while len(look):
            look = look[np.abs(self.count[look]) == 1]
            look = look[_check(self.digest[look]) == self.check[look]]
            if not len(look):
                break
            row, items = look // self.cells, self.digest[look]
            order = np.lexsort((items, row))  # an item may be alone in several of its cells
            row, items = row[order], items[order]
            new = np.append(True, (row[1:] != row[:-1]) | (items[1:] != items[:-1]))
            row, items, signs = row[new], items[new], self.count[look[order[new]]]
            found.append((row, items, signs))
            self.add(row, items, -signs)
            part = self.cells // PARTS
            look = np.unique(np.concatenate([row * self.cells + k * part + (_mixed(items, _SALTS[k]) % np.uint64(part)).astype(np.int64)
                                             for k in range(PARTS)]))
        left = ((self.count != 0) | (self.digest != 0)).reshape(-1, self.cells).any(1)
        parts = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, (np.int64, np.uint64, np.int64)[i]) for i in range(3)]
        return (*parts, ~left)

    def texts(self) -> list[str]:
        """The cells of each row in base 64."""
        raw = np.empty(len(self.count), _CELL)
        raw["count"], raw["digest"], raw["check"] = self.count, self.digest, self.check
        return [b64encode(r.tobytes()).decode() for r in raw.reshape(-1, self.cells)]


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return row, np.concatenate(lists) if lists else np.zeros(0, np.uint64)


def differences(left: list[np.ndarray], right: list[np.ndarray], cells: int = CELLS) -> list[tuple[list[int], list[int]]]:
    """Per pair the digests on the left only and on the right only, from subtracted sketches that grow until all peel."""
    out: list = [None] * len(left)
    open_ = np.arange(len(left))
    while len(open_):
        diff = Sketches(len(open_), cells)
        diff.add(*_flat([left[i] for i in open_]), 1)
        diff.add(*_flat([right[i] for i in open_]), -1)
        row, items, signs, whole = diff.peel()
        for side, sign in ((0, 1), (1, -1)):
            mine = signs == sign
            order = np.argsort(row[mine], kind="stable")
            ends = np.searchsorted(row[mine][order], np.arange(len(open_) + 1))
            values = items[mine][order]
            for k in np.flatnonzero(whole):
                out[open_[k]] = out[open_[k]] or ([], [])
                out[open_[k]][side].extend(values[ends[k]:ends[k + 1]].tolist())
        open_, cells = open_[~whole], cells * 2
    return out


def likeness(left: list[np.ndarray], right: list[np.ndarray], cells: int = CELLS) -> list[float]:
    """Share of common paragraphs, 2 |common| / (|a| + |b|); 1 for two empty documents."""
    out = []
    for a, b, (x, y) in zip(left, right, differences(left, right, cells)):
        total = len(a) + len(b)
        out.append((total - len(x) - len(y)) / total if total else 1.0)
    return out


def sketch_texts(lists: list[np.ndarray], cells: int = CELLS) -> list[str]:
    """Fingerprints: number of paragraphs, a digest of all of them and the sketch of the smallest size."""
    sketches = Sketches(len(lists), cells)
    sketches.add(*_flat(lists), 1)
    return [f"{len(x)}/{sha256(np.sort(x).tobytes()).hexdigest()[:16]}/{t}" for x, t in zip(lists, sketches.texts())]


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much of the beginning of ``following``."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def _bounds(rows: DataFrame, wanted: int) -> list:
    """Bounds that cut the ids into about ``wanted`` ranges, from a bounded sample; results do not depend on them."""
    n = rows.count()
    drawn = rows.where(F.col("doc_id").isNotNull() & (F.rand(3) < RANGE_SAMPLE / max(n, 1))).select("doc_id")
    ids = sorted(drawn.toArrow().column(0).to_pylist())
    return sorted({ids[i * len(ids) // wanted] for i in range(1, wanted)}) if ids else []


def fingerprint_documents(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row.

    The next document is the one with the next smaller ``doc_id`` (after the
    last: the first); equal ids follow one another by text, rows without an id
    come last, in an order of their texts. A single row is its own next
    document. The edited text has its last third replaced by the beginning of
    the next one. Null texts are empty; two empty texts have likeness 1. Other
    columns are ignored; an empty table gives an empty table.

    The ids are cut into ranges that are sorted and read in order; of every
    range only the first row is copied, to the end of the range before it.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    bounds = _bounds(rows, wanted)
    last = len(bounds)
    kind = docs.schema["doc_id"].dataType
    cuts = F.array(*[F.lit(b) for b in bounds]).cast(f"array<{kind.simpleString()}>")
    unnamed = F.lit(last + 1) + F.pmod(F.xxhash64("text"), F.lit(wanted))
    spot = F.when(F.col("doc_id").isNull(), unnamed).otherwise(F.lit(last) - F.size(F.filter(cuts, lambda c: c <= F.col("doc_id"))))
    placed = rows.withColumn("range", spot.cast("int"))
    firsts = stored(placed.groupBy("range").agg(F.max("doc_id").alias("first_id")), "firsts")  # a row per range
    known = sorted(r["range"] for r in firsts.select("range").toLocalIterator())
    before = spark.createDataFrame([(a, b) for a, b in zip(known, known[-1:] + known[:-1])], "first_range int, range int")
    heads = stored(placed.withColumnRenamed("range", "first_range").join(
        F.broadcast(firsts.withColumnRenamed("range", "at")),
        (F.col("first_range") == F.col("at")) & same(F.col("doc_id"), F.col("first_id")))
        .groupBy("first_range").agg(F.first("doc_id").alias("doc_id"), F.min("text").alias("text")), "heads")
    copies = heads.join(F.broadcast(before), "first_range").select("doc_id", "text", "range", F.lit(True).alias("head"))
    ordered = (placed.withColumn("head", F.lit(False)).unionByName(copies).repartition("range")
               .sortWithinPartitions("range", "head", F.desc_nulls_last("doc_id"), "text"))
    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                        ("near_next", pa.float64())])

    def compared(group: list) -> pa.RecordBatch:
        ids, texts, own, following, nexts = zip(*group)
        new = [edited(t, n) for t, n in zip(texts, nexts)]
        changed = [digests(t) for t in new]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, schema.field(0).type), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], pa.string()),
             pa.array(sketch_texts(own, cells), pa.string()), pa.array(sketch_texts(changed, cells), pa.string()),
             pa.array(likeness(own, changed, cells), pa.float64()), pa.array(likeness(own, following, cells), pa.float64())],
            schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, group = None, []
        for b in batches:
            for doc_id, text, head in zip(*batch_rows(b, "doc_id", "text", "head")):
                items = digests(text)
                if last:
                    group.append((*last, items, text))
                last = None if head else (doc_id, text, items)
                if len(group) >= TOGETHER:
                    yield compared(group)
                    group = []
        if group:
            yield compared(group)

    return ordered.mapInArrow(read, f"doc_id {kind.simpleString()}, n_chars bigint, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")
