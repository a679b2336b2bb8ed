"""Best-fit decreasing packing of token sequences.

Lengths are whole numbers up to the sequence length, so all pieces of one length
are interchangeable and the open bins of one remaining capacity are too. The
packing is therefore planned once for the whole corpus on the histogram of
lengths: from the longest length down, every run of pieces goes to the tightest
open bins that hold it, found by a segment tree over remaining capacities. The
plan has a size bounded by the sequence length, however many documents there
are; pieces find their place in it by their rank among the pieces of their
length.
"""

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lorefield.llm.common import batch_rows, stored

CAPACITY = 2048
END = 0
#: Pieces of a generation; two are kept.
PIECES_KEPT = 100_000
#: The characters of which lower case and composition are the same to Python and to the tokenizer.
LATIN = "latin-1"
#: The tokenizer's splitting rule (a fixed value of the vocabulary file) on lower-case Latin-1 text. Letters come first,
#: as most pieces are letters; the order matters only between endings and punctuation.
PIECE = re.compile(r"[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|'(?:[stmd]|re|ve|ll)|[^\sa-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
#: White space to Python, ordinary characters to the tokenizer's splitter.
ODD_SPACE = "\x1c\x1d\x1e\x1f"


def byte_letters() -> dict[int, str]:
    """The visible character by which a byte-level vocabulary writes each byte: itself, or the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


class Pieces(dict):
    """Token ids by piece, made on demand; frequent pieces survive when rare ones go, as only a generation of unused ones is dropped."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.before = encode, most, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        self[piece] = ids = self.encode(piece) if ids is None else ids
        return ids

    def age(self) -> None:
        """Between texts: a full generation becomes the earlier one."""
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()


class WordTokens:
    """Token ids of whole texts, put together from the ids of the pieces that the tokenizer cuts a text into.

    A piece has the same ids wherever it stands. Texts of Latin-1 characters are
    put in lower case and cut by the tokenizer's own rule, so that only letter
    runs, digits and punctuation runs are remembered. In other texts the words
    between white space are the pieces, as the tokenizer never joins characters
    across it. Texts with separators that Python alone takes for white space, or
    with one of the tokenizer's special tokens, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        self.tokenizer = Tokenizer.from_file(path)
        # In lower case, as pieces are put together in lower case.
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.known = Pieces(self.merged, PIECES_KEPT)
        self.words = Pieces(self.whole, PIECES_KEPT // 4)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def merged(self, piece: str) -> bytes:
        """One piece to the splitter: straight to the merges."""
        found = self.model.tokenize(piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.letters))
        return pack(f"<{len(found)}I", *[p.id for p in found])

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        low = text.lower()
        if any(c in text for c in ODD_SPACE) or any(s in low for s in self.special):
            return self.whole(text)
        latin = is_latin(text)
        known = self.known if latin else self.words
        known.age()
        return b"".join(map(known.__getitem__, PIECE.findall(low) if latin else text.split()))


def is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode(LATIN)
    except UnicodeEncodeError:
        return False
    return True


class Tightest:
    """Segment tree over remaining capacities: the least capacity with an open bin that is at least a given one."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.width)

    def set(self, capacity: int, bins: int) -> None:
        i = capacity + self.width
        self.open[i] = bins
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] + self.open[2 * i + 1]

    def find(self, least: int) -> int | None:
        i = least + self.width
        if self.open[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.width:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.width
            i //= 2
        return None


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Best-fit decreasing for ``counts`` pieces of each length.

    Returns runs ``(length, first rank, first bin, offset)``: pieces of that
    length from that rank on go to consecutive bins at that offset.
    """
    tree, spare, runs, bins = Tightest(capacity), {}, [], 0
    for length in sorted((n for n in counts if n > 0), reverse=True):
        rank, left = 0, counts[length]
        moved = []
        while left:
            room = tree.find(length)
            if room is None:
                each = capacity // length
                # The tightest bin for the next equal piece is the one just opened, until it is full.
                full, rest = divmod(left, each)
                for k in range(each):
                    if full:
                        runs.append((length, rank, bins, k * length))
                        rank += full
                moved.append((capacity - each * length, bins, full))
                bins += full
                for k in range(rest):
                    runs.append((length, rank, bins, k * length))
                    rank += 1
                if rest:
                    moved.append((capacity - rest * length, bins, 1))
                    bins += 1
                left = 0
                break
            first, n = spare[room].pop()
            # As many equal pieces as each of these bins still holds, one bin after the other.
            each = room // length
            used = min(n, -(-left // each))
            full, rest = divmod(min(left, used * each), each)
            for k in range(each):
                if full:
                    runs.append((length, rank, first, capacity - room + k * length))
                    rank += full
            if full:
                moved.append((room - each * length, first, full))
            for k in range(rest):
                runs.append((length, rank, first + full, capacity - room + k * length))
                rank += 1
            if rest:
                moved.append((room - rest * length, first + full, 1))
            left -= full * each + rest
            if used < n:
                spare[room].append((first + used, n - used))
            tree.set(room, sum(m for _, m in spare[room]))
        for room, first, n in moved:
            if room and n:
                spare.setdefault(room, []).append((first, n))
                tree.set(room, sum(m for _, m in spare[room]))
    return runs


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and a rank of the piece among equal lengths of its task."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task = WordTokens(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            row, piece, start, length, crc, rank = [], [], [], [], [], []
            for i, text in enumerate(batch_rows(b, "text")[0]):
                ids = words.ids(text or "") + END.to_bytes(4, "little")
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    n = len(part) // 4
                    row.append(i)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    rank.append(int(seen[n]))
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int32()),
                 pa.array(rank, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "task_rank"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        pieces, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, task_rank bigint")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every row.

    A document is its token ids and an end id; only longer ones than
    ``capacity`` are cut. Null and empty texts are the end id alone. Equal
    lengths are placed in the order in which they were read. Repeated rows are
    packed once per row, null ids are kept, other columns are ignored, an empty
    table gives an empty table.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "bases")
    # One row per length, at most as many as the capacity.
    totals = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs: dict[int, tuple[list, list, list]] = {}
    for length, rank, first, offset in plan_packing(totals, capacity):
        ranks, firsts, offsets = runs.setdefault(length, ([], [], []))
        ranks.append(rank)
        firsts.append(first)
        offsets.append(offset)
    plan = docs.sparkSession.sparkContext.broadcast(runs)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins, offsets = [], []
            for length, rank in zip(*batch_rows(b, "length", "rank")):
                ranks, firsts, places = plan.value[length]
                k = bisect_right(ranks, rank) - 1
                bins.append(firsts[k] + rank - ranks[k])
                offsets.append(places[k])
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())],
                                             names=[*b.schema.names[:5], "sequence_id", "offset"])

    ranked = pieces.join(bases.select("length", "task", "base"), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("task_rank")).alias("rank"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(placed, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                     "sequence_id bigint, offset bigint")
