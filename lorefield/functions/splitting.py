"""Splitting one text into chunks: the per-document helper behind the Arrow UDF."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

from lorefield.functions.strings import as_column
from lorefield.session import bound_batches

SLICE = 32   # rows of a batch that are Python strings at a time

# The separators of each strategy, tried in this order. Only
# 'recursive' ends with '' (single characters), so only it never exceeds the size.
SEPARATORS = {
    "recursive": ["\n\n", "\n", " ", ".", ",", "،", "،", "。", "、", "।",
                  "​", "，", "、", "．", "。", ""],
    "semantic": ["\n\n\n", "\n\n", "\n", "\r\n\r\n", "\r\n", " ", ".", ",", "।"],
    "markdown": ["\n\n", "\n", "\n#", "\n##", "\n###", "\n####", "\n#####", "\n######",
                 "\n- ", "\n* ", "\n1. ", "```", " ", ".", ",", "।"],
    "sentence": ["\n\n", "。", ". ", "! ", "? ", "\n", "; ", ": ", ",", " "],
    "large_context": ["\n\n\n", "\n\n", "\n", "\r\n\r\n", "\r\n", "\n#", "\n##", "\n###",
                      "\n- ", "\n* ", " ", "."],
    "hierarchical": ["\n\n\n\n", "\n\n\n", "\n\n", "\n", "\n####", "\n###", "\n##", "\n#",
                     "\n- ", "\n* ", "\n1. ", "```", " "],
    "overlap": ["\n\n", "\n", "\n#", "\n##", "\n###", "\n- ", "\n* ", " "],
    "content_aware": ["\n\n\n", "\n\n", "\n```", "```\n", "\n#", "\n##", "\n- ", "\n* ",
                      "\n1. ", "\n", " "],
}


def check_chunking(strategy: str, size: int, overlap: int, minimum: int) -> None:
    """Raise on arguments no split could honour."""
    if strategy not in SEPARATORS:
        raise ValueError(f"unknown chunking strategy {strategy!r}; one of {', '.join(SEPARATORS)}")
    if size <= 0 or overlap < 0 or not 0 <= minimum <= size:
        raise ValueError("need size > 0, overlap >= 0 and 0 <= minimum <= size")


def effective_sizes(strategy: str, size: int, overlap: int) -> tuple[int, int]:
    """Size and overlap a strategy works with; 'overlap' halves the size."""
    if strategy != "overlap":
        return size, overlap
    half = max(size // 2, 100)
    return half, max(overlap, half // 4)


def _pieces(text: str, separator: str) -> Iterator[str]:
    """Parts of the text; each part after the first starts with the separator."""
    if not separator:
        yield from text
        return
    begin = 0
    for hit in re.finditer(re.escape(separator), text):
        if hit.start() > begin:
            yield text[begin:hit.start()]
        begin = hit.start()
    if begin < len(text):
        yield text[begin:]


def _pack(pieces: Iterable[str], size: int, overlap: int) -> Iterator[str]:
    """Join neighbours up to ``size``; the next chunk repeats at most ``overlap`` characters."""
    window: list[str] = []
    first = total = 0
    for piece in pieces:
        if total + len(piece) > size and first < len(window):
            joined = "".join(window[first:]).strip()
            if joined:
                yield joined
            while first < len(window) and (total > overlap or total + len(piece) > size) and total > 0:
                total -= len(window[first])
                first += 1
            window, first = window[first:], 0
        window.append(piece)
        total += len(piece)
    joined = "".join(window).strip()
    if joined:
        yield joined


def _pack_at(text: str, mark: str, size: int, finer: Sequence[str]) -> Iterator[str]:
    """``split_one`` for a one-character separator (or none) without overlap.

    A chunk ends at the last mark within reach, so only chunk ends are looked
    at and not every word.
    """
    at, end = 0, len(text)
    while at < end:
        if not mark:
            stop = min(at + size, end)
        elif end - at < size:
            stop = end
        else:
            stop = text.rfind(mark, at + 1, at + size + 1) if end - at > size else end
            if stop < 0 or (stop - at == size and text.find(mark, at + 1, stop) < 0):
                # One piece as long as a chunk or longer: it is split by itself.
                stop = text.find(mark, at + 1)
                stop = end if stop < 0 else stop
                piece = text[at:stop]
                yield from split_one(piece, finer, size, 0) if finer else (piece,)
                at = stop
                continue
        chunk = text[at:stop].strip()
        if chunk:
            yield chunk
        at = stop


def split_one(text: str, separators: Sequence[str], size: int, overlap: int) -> Iterator[str]:
    """Chunks of a text, splitting at the coarsest separator that occurs in it."""
    level = next((i for i, s in enumerate(separators) if not s or s in text), len(separators) - 1)
    finer = separators[level + 1:] if separators[level] else ()
    if overlap == 0 and size > 1 and len(separators[level]) < 2:
        yield from _pack_at(text, separators[level], size, finer)
        return
    run: list[str] = []
    for piece in _pieces(text, separators[level]):
        if len(piece) < size:
            run.append(piece)
            continue
        yield from _pack(run, size, overlap)
        run = []
        if finer:
            yield from split_one(piece, finer, size, overlap)
        else:
            yield piece
    yield from _pack(run, size, overlap)


def merge_small(chunks: list[str], minimum: int) -> list[str]:
    """Join chunks shorter than ``minimum`` with their right neighbour, pass by pass.

    A pass treats a joined pair as done, so results differ from one greedy scan.
    A short last chunk joins the chunk before it.
    """
    if minimum <= 0:
        return chunks
    while True:
        out: list[str] = []
        joined = False
        queue = iter(chunks)
        for chunk in queue:
            if len(chunk) < minimum:
                right = next(queue, None)
                if right is not None:
                    chunk, joined = chunk + right, True
                elif out:
                    out[-1] += chunk
                    continue
            out.append(chunk)
        shrunk = len(out) < len(chunks)
        chunks = out
        if not joined or not shrunk:
            return chunks


def _by_slices(values: pa.Array, made: Callable) -> pa.Array:
    """``made`` of every value that is not null; a batch's results are kept as Arrow data, not as Python strings."""
    kind = pa.list_(pa.string())
    parts = [pa.array([None if v is None else made(v) for v in values.slice(at, SLICE).to_pylist()], kind)
             for at in range(0, len(values), SLICE)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def split_text(col: Column | str, strategy: str = "large_context", size: int = 5000,
               overlap: int = 200, minimum: int = 0) -> Column:
    """``array<string>`` of chunks; ``minimum > 0`` also merges small ones.

    Lowers the session's Arrow batches (``bound_batches``): what a task holds
    does not grow with the table.
    """
    check_chunking(strategy, size, overlap, minimum)
    separators = SEPARATORS[strategy]
    size, overlap = effective_sizes(strategy, size, overlap)
    bound_batches(SparkSession.getActiveSession())

    @F.arrow_udf("array<string>")
    def chunks(texts: pa.Array) -> pa.Array:
        return _by_slices(texts, lambda t: merge_small(list(split_one(t, separators, size, overlap)), minimum))

    return chunks(as_column(col))


def merge_small_chunks(col: Column | str, minimum: int = 100) -> Column:
    """Merge the small chunks of an ``array<string>`` column."""
    bound_batches(SparkSession.getActiveSession())

    @F.arrow_udf("array<string>")
    def merged(arrays: pa.Array) -> pa.Array:
        return _by_slices(arrays, lambda a: merge_small(a, minimum))

    return merged(as_column(col))
