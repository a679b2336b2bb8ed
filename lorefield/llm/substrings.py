"""Removal of repeated byte strings by column-wise suffix sorting.

Every 200-byte string is assigned to its minimizer, the least-hashed 24-byte gram
in it. Neighbouring strings with one minimizer form a segment; equal strings have
equal minimizers at equal places, so only segments with a common minimizer are
compared, and aligned at it.

The segments of a group of minimizers are one document collection. Its suffix
order is built column by column from the right: each round reads one symbol of
every segment from a sequential file, the symbols in the present suffix order
being the Burrows-Wheeler transform of the column; a stable sort by symbol gives
the order of the suffixes that are one symbol longer, and the common prefixes
of neighbours follow from range minima of the last round's. A string is repeated
where a neighbour shares 200 symbols with it; these marks go to a second file.

Segments that are equal as a whole are collapsed before. A minimizer with very
many segments is split: each part is sorted as above, and one fingerprint per
different string of a part is then counted over the parts.
"""

from collections.abc import Iterator
from hashlib import sha256
from tempfile import TemporaryFile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lorefield.llm.common import batch_rows, same, stored

LENGTH = 200
GRAM = 24
SPAN = LENGTH - GRAM + 1  # grams of a string
COLUMNS = 2 * LENGTH - GRAM  # of segments aligned at their minimizer
#: Segments sorted together; groups beyond it are split.
TOGETHER = 1 << 14
#: Measured size up to which spans or ids of documents are broadcast.
SMALL = 32 << 20

_A = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes from each place on."""
    with np.errstate(over="ignore"):
        h, factor = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9), _A
        size, parts = 1, {}
        while size < GRAM:
            parts[size] = (h, factor)
            h = h[:-size] * factor + h[size:]
            factor, size = factor * factor, size * 2
            if size == 16:
                break
        eight, by = parts[8]
        h = h[:len(data) - GRAM + 1] * by + eight[16:16 + len(data) - GRAM + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def segments(data: bytes) -> tuple[list, list]:
    """Segments of a text and the spans of strings that repeat within it.

    A segment is ``(minimizer, segment hash, start, strings, place of the
    minimizer, times)``; one that occurs more than once is listed once.
    """
    if len(data) < LENGTH:
        return [], []
    hashes = _gram_hashes(np.frombuffer(data, np.uint8))
    keys = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    least, size = keys, 1
    while size * 2 <= SPAN:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    least = np.minimum(least[:len(keys) - SPAN + 1], least[SPAN - size:])
    starts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    places = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    counts = np.diff(np.append(starts, len(least)))
    digest = xxhash.xxh64_intdigest
    names = np.fromiter((digest(data[s:s + n + LENGTH - 1], p - s) for s, n, p in zip(starts.tolist(), counts.tolist(), places.tolist())),
                        np.uint64, len(starts)).view(np.int64)
    _, first, inverse, times = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
    again = times[inverse] > 1
    spans = merged(list(zip(starts[again].tolist(), (starts + counts + LENGTH - 1)[again].tolist())))
    mins = hashes[places].view(np.int64)
    rows = [(int(mins[i]), int(names[i]), int(starts[i]), int(counts[i]), int(places[i] - starts[i]), int(t)) for i, t in zip(first, times)]
    return rows, spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Touching and overlapping spans put together, in order."""
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``values[low:high]`` for each pair, low < high."""
    levels, size = [values], 1
    while size * 2 <= int((high - low).max(initial=1)):
        levels.append(np.minimum(levels[-1][:-size], levels[-1][size:]))
        size *= 2
    k = np.frexp(high - low)[1] - 1
    out = np.empty(len(low), values.dtype)
    for level in np.unique(k):
        mine = k == level
        table = levels[level]
        out[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << int(level))])
    return out


def column_sort(texts: list[bytes], places: np.ndarray, groups: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rounds ``(column, order, common)`` of the collection, from the last column to the first.

    ``order`` are the segments in the order of their suffixes from the column
    on, group by group, and ``common`` the symbols that each one shares with the
    one before. The collection lies in a file by columns and is read once, in
    its order.
    """
    n = len(texts)
    shift = LENGTH - GRAM
    with TemporaryFile() as columns:
        square = np.zeros((n, COLUMNS), np.uint16)  # 0: outside the segment
        for i, (t, p) in enumerate(zip(texts, places)):
            square[i, shift - p:shift - p + len(t)] = np.frombuffer(t, np.uint8)
        for i, (t, p) in enumerate(zip(texts, places)):
            square[i, shift - p:shift - p + len(t)] += 1
        np.ascontiguousarray(square.T[::-1]).tofile(columns)
        del square
        columns.seek(0)
        order = np.argsort(groups, kind="stable")
        common = np.zeros(n, np.int16)
        base = groups.astype(np.int64) << 9
        for column in range(COLUMNS - 1, -1, -1):
            symbols = np.fromfile(columns, np.uint16, n)
            transform = symbols[order]
            keys = base[order] | transform
            move = np.argsort(keys, kind="stable")
            keys = keys[move]
            alike = np.flatnonzero((keys[1:] == keys[:-1]) & (transform[move[1:]] > 0)) + 1
            longer = np.zeros(n, np.int16)
            if len(alike):
                longer[alike] = _between(common, move[alike - 1] + 1, move[alike] + 1) + 1
            order, common = order[move], longer
            yield column, order, common


def repeated_strings(rows: list[tuple[int, int, int, bytes]], split: list[bool]) -> Iterator[tuple[list, list]]:
    """Repeated strings of ``(minimizer, segment, place, bytes)`` rows.

    Yields column by column, for rows of ``split`` groups, one
    ``(fingerprint, times, segment, start)`` per different string, with the
    place of a string that was seen once; then all spans of string starts
    ``(segment, first, end)``.
    """
    _, groups = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)
    places = np.array([r[2] for r in rows])
    texts = [r[3] for r in rows]
    shift = LENGTH - GRAM
    divided = np.array(split)
    with TemporaryFile() as file:
        for column, order, common in column_sort(texts, places, groups):
            marks = np.zeros(len(rows), bool)
            equal = np.flatnonzero(common >= LENGTH)
            marks[order[equal]] = marks[order[equal - 1]] = True
            marks.tofile(file)
            if divided.any():
                partial = []
                begin = np.flatnonzero(common < LENGTH)
                times = np.diff(np.append(begin, len(order)))
                for i, n in zip(order[begin].tolist(), times.tolist()):
                    at = column - shift + int(places[i])
                    if divided[i] and 0 <= at <= len(texts[i]) - LENGTH:
                        partial.append((xxhash.xxh3_128_digest(texts[i][at:at + LENGTH]), n, rows[i][1], at))
                if partial:
                    yield [], partial
        file.seek(0)
        marks = np.fromfile(file, bool, COLUMNS * len(rows)).reshape(COLUMNS, len(rows))[::-1].T
    spans = []
    for i in np.flatnonzero(marks.any(1)).tolist():
        edges = np.flatnonzero(np.diff(np.concatenate([[0], marks[i].view(np.int8), [0]])))
        own = edges - shift + places[i]
        spans += [(rows[i][1], int(a), int(b)) for a, b in zip(own[::2], own[1::2])]
    yield spans, []


def _segments(docs: DataFrame) -> DataFrame:
    """Segments of all documents; rows of no ``times`` are spans known from one document, under any minimizer."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, rows = [], []
            for i, text in enumerate(batch_rows(b, "text")[0]):
                own, spans = segments(text.encode("utf-8", "surrogatepass"))
                own += [(x * 0x9E3779B1 ^ y, 0, x, y - LENGTH + 1 - x, 0, 0) for x, y in spans]
                owner += [i] * len(own)
                rows += own
                if len(rows) > 100_000:
                    yield packed(b, owner, rows)
                    owner, rows = [], []
            yield packed(b, owner, rows)

    def packed(b, owner, rows):
        at = pa.array(owner, pa.int64())
        cols = list(zip(*rows)) if rows else [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                          names=["doc_id", "text_key", "minimizer", "segment", "start", "strings", "place", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text_key", "text").mapInArrow(
        cut, f"doc_id {kind}, text_key bigint, minimizer bigint, segment bigint, start int, strings int, place int, times int")


def _owned(docs: DataFrame, rows: DataFrame):
    return same(docs["doc_id"], rows["own_id"]) & (docs["text_key"] == rows["own_key"])


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted(own_id, own_key, ...)``, one row per document, with the documents' texts.

    Only texts that are wanted are moved when the ids are few enough to be sent to every executor.
    """
    ids = wanted.select("own_id", "own_key")
    if ids.count() * 32 <= SMALL:
        docs = docs.join(F.broadcast(ids), _owned(docs, ids), "left_semi")
    return docs.join(wanted, _owned(docs, wanted)).select("text", *[c for c in wanted.columns if c not in ("own_id", "own_key")])


def _repeated(candidates: DataFrame, docs: DataFrame) -> DataFrame:
    """Spans of repeated string starts ``(segment, first, end)`` among different segments of one minimizer."""
    wanted = stored(candidates.groupBy(F.col("at.doc_id").alias("own_id"), F.col("at.text_key").alias("own_key")).agg(
        F.collect_list(F.struct("minimizer", "segment", "place", "parts", F.col("at.start").alias("start"), "strings")).alias("list")), "wanted")

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, own in zip(*batch_rows(b, "text", "list")):
                data = text.encode("utf-8", "surrogatepass")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s[c] for s in own], k) for c, k in (("minimizer", pa.int64()), ("segment", pa.int64()), ("place", pa.int32()), ("parts", pa.int32()))]
                    + [pa.array([data[s["start"]:s["start"] + s["strings"] + LENGTH - 1] for s in own], pa.binary())],
                    names=["minimizer", "segment", "place", "parts", "bytes"])

    pieces = _texts_of(docs, wanted).mapInArrow(fetched, "minimizer bigint, segment bigint, place int, parts int, bytes binary")
    dealt = (pieces.withColumn("part", F.pmod(F.xxhash64("segment"), F.col("parts")).cast("int"))
             .repartition("minimizer", "part").sortWithinPartitions("minimizer", "part", "segment"))

    def sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, split, last, seen = [], [], None, None
        for b in batches:
            for m, s, p, parts, part, data in zip(*batch_rows(b, "minimizer", "segment", "place", "parts", "part", "bytes")):
                if (m, part) != last and len(rows) >= TOGETHER:
                    yield from found(rows, split)
                    rows, split = [], []
                if (m, part, s) != seen:  # equal rows of a table give a segment more than once
                    rows.append((m, s, p, data))
                    split.append(parts > 1)
                last, seen = (m, part), (m, part, s)
        if rows:
            yield from found(rows, split)

    def found(rows, split):
        for spans, partial in repeated_strings(rows, split):
            yield pa.RecordBatch.from_arrays(
                [pa.array([s[0] for s in spans] + [p[2] for p in partial], pa.int64()),
                 pa.array([s[1] for s in spans] + [p[3] for p in partial], pa.int32()),
                 pa.array([s[2] for s in spans] + [p[3] + 1 for p in partial], pa.int32()),
                 pa.array([None] * len(spans) + [p[0] for p in partial], pa.binary()),
                 pa.array([0] * len(spans) + [p[1] for p in partial], pa.int64())],
                names=["segment", "first", "end", "fingerprint", "times"])

    sorted_ = stored(dealt.mapInArrow(sorted_groups, "segment bigint, first int, end int, fingerprint binary, times bigint"), "sorted")
    once = F.when(F.col("times") == 1, F.struct("segment", "first", "end"))
    across = (sorted_.where("fingerprint is not null").groupBy("fingerprint")
              .agg(F.sum("times").alias("total"), F.collect_list(once).alias("singles"))  # one per part at most
              .where("total > 1").select(F.explode("singles").alias("s")).select("s.*"))
    return sorted_.where("fingerprint is null").select("segment", "first", "end").unionByName(across)


def remove_repeats(docs: DataFrame, together: int = TOGETHER) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs(doc_id, text)``, and the ``spans`` removed.

    Removed is every byte that lies in a 200-byte string which also starts at
    another place of the same or another row; strings never cross rows. Null
    texts are empty; texts of fewer than 200 bytes keep all. Repeated rows are
    copies of each other; null ids are kept; other columns are ignored; an empty
    table gives an empty table.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    every = _segments(keyed)
    mins = stored(every.where("times > 0").groupBy("minimizer").agg(F.sum("times").alias("n")).where("n > 1")
                  .select(F.col("minimizer").alias("again")), "minimizers")
    both = stored(every.join(mins, F.col("minimizer") == F.col("again"), "left").where("times = 0 or again is not null").drop("again"),
                  "segments")
    kept = both.where("times > 0")
    known = both.where("times = 0").select("doc_id", "text_key", F.col("start").alias("low"),
                                           (F.col("start") + F.col("strings") + LENGTH - 1).alias("high"))
    different = stored(kept.groupBy("minimizer", "segment").agg(
        F.sum("times").alias("n"), F.min(F.struct("doc_id", "text_key", "start")).alias("at"), F.first("strings").alias("strings"),
        F.first("place").alias("place")), "different")
    # Stored sides are plain scans, so Spark can split a minimizer or a segment that very many rows share.
    groups = stored(different.groupBy("minimizer").agg(F.count("*").alias("members")).where("members > 1"), "groups")
    candidates = different.join(groups, "minimizer").withColumn("parts", F.ceil(F.col("members") / together).cast("int"))
    whole = different.where("n > 1").select("segment", F.lit(0).alias("first"), F.col("strings").alias("end"))
    marks = whole.unionByName(_repeated(candidates, keyed))
    by_segment = stored(marks.groupBy(F.col("segment").alias("marked")).agg(F.collect_list(F.struct("first", "end")).alias("marks")), "marked")
    spans = (kept.join(by_segment, F.col("segment") == F.col("marked"))
             .select("doc_id", "text_key", "start", F.explode("marks").alias("mark"))
             .select("doc_id", "text_key", (F.col("start") + F.col("mark.first")).alias("low"),
                     (F.col("start") + F.col("mark.end") + LENGTH - 1).alias("high"))).unionByName(known)
    kind = docs.schema["doc_id"].dataType.simpleString()
    gathered = spans.groupBy(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key")).agg(
        F.collect_list(F.struct("low", "high")).alias("spans"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [[x for s in merged([(s["low"], s["high"]) for s in own]) for x in s] for own in batch_rows(b, "spans")[0]]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.int32()))],
                                             names=["own_id", "own_key", "spans"])

    touched = stored(gathered.mapInArrow(joined, f"own_id {kind}, own_key bigint, spans array<int>"), "touched")
    size = touched.agg(F.sum(F.size("spans") * 4 + 32)).first()[0] or 0
    side = F.broadcast(touched) if size <= SMALL else touched

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, removed, counts, digests = [], [], [], []
            for text, flat in zip(*batch_rows(b, "text", "spans")):
                data, rest, at = text.encode("utf-8", "surrogatepass"), sha256(), 0
                pairs = list(zip(flat[::2], flat[1::2])) if flat else []
                for low, high in pairs:
                    rest.update(data[at:low])
                    at = high
                rest.update(data[at:])
                sizes.append(len(data))
                removed.append(sum(high - low for low, high in pairs))
                counts.append(len(pairs))
                digests.append(rest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(digests, pa.string()), b.column(2)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return keyed.join(side, _owned(keyed, touched), "left").select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<int>")
