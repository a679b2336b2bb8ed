"""Large JSON arrays read by many tasks.

A file that is one JSON array has no line borders to cut it at. Spark's text
reader cuts any file into ranges of pieces that end at a closing brace. What a
range does to the state of a JSON scanner, open string or not and the depth of
brackets, is a small summary; summaries of a file are folded in order, so each
range then knows the state it begins in and gives out the elements in it.
Elements that go over a range's end are put together from their fragments.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from lorefield.session import scratch_path

#: A string up to its end or the piece's, or a bracket; the pieces hold no closing brace.
TOKEN = re.compile(r'"(?:[^"\\]++|\\.)*+("|\Z|\\\Z)|[{\[\]]', re.S)
#: What a block holds of an element.
WHOLE, END, MIDDLE, BEGINNING = range(4)
REST = re.compile(r'(?:[^"\\]++|\\.)*+"', re.S)


def scan(piece: str, inside: bool, depth: int) -> tuple[bool, int, int, bool]:
    """State after a piece, where an element begins in it (-1: nowhere), and whether a bracket closed down to the outer array before.

    ``inside`` tells whether a string is open. An element is an object directly
    in the outer array, at depth 1.
    """
    at, start, down = 0, -1, False
    if inside:
        m = REST.match(piece)
        if not m:
            return True, depth, -1, False
        at = m.end()
    for m in TOKEN.finditer(piece, at):
        c = m[0][0]
        if c == '"':
            if m[1] != '"':
                return True, depth, start, down
        elif c == "]":
            depth -= 1
            down = down or depth <= 1
        else:
            if c == "{" and depth == 1 and start < 0:
                start = m.start()
            depth += 1
    return False, depth, start, down


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``value, path, block`` in file order within a block; a block is one range of a file and is read by one task."""
    return spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for b in batches:
        yield from zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(0).to_pylist())


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block, for either state at its start: the state at its end and the change of depth. And its first sign."""
    found: dict[tuple, list] = {}
    for path, block, piece in _rows(batches):
        state = found.setdefault((path, block), [False, 0, True, 0, ""])
        for k in (0, 2):
            inside, depth = scan(piece, state[k], state[k + 1])[:2]
            # The closing brace that ends the piece.
            state[k], state[k + 1] = inside, depth - (not inside)
        state[4] = state[4] or piece.lstrip("﻿ \t\r\n")[:1] or "}"
    if found:
        columns = list(zip(*[(*key, *state) for key, state in found.items()]))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["path", "block", "out0", "depth0", "out1", "depth1", "first"])


def _folded(table: pa.Table) -> pa.Table:
    """State at the start of every block of a file. A file that begins with a brace is read like the inside of an array."""
    rows = sorted(zip(*table.to_pydict().values()), key=lambda r: r[1])
    inside, depth = False, int(rows[0][6] == "{")
    out = []
    for path, block, out0, depth0, out1, depth1, _ in rows:
        out.append((path, block, inside, depth))
        inside, depth = (out1, depth + depth1) if inside else (out0, depth + depth0)
    return pa.table({n: list(c) for n, c in zip(("path", "block", "inside", "depth"), zip(*out))})


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of every object in the JSON arrays of a file or folder, in no order.

    Files with objects one after the other, such as lines, are taken too.
    Elements that are no objects are left out. One small row per range of the
    input (128 MB by Spark's default) reaches the driver.
    """
    pieces = _pieces(spark, path)
    states = (pieces.mapInArrow(_summaries, "path string, block bigint, out0 boolean, depth0 bigint, out1 boolean, depth1 bigint, first string")
              .groupBy("path").applyInArrow(_folded, "path string, block bigint, inside boolean, depth bigint"))
    begin = {(r["path"], r["block"]): (r["inside"], r["depth"]) for r in states.collect()}

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, None, []

        def batch():
            columns = list(zip(*out)) or [()] * 4
            rows = pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int32()))],
                                              names=["value", "path", "block", "part"])
            out.clear()
            return rows

        for path, block, piece in _rows(batches):
            if now != (path, block):
                if held is not None:
                    out.append(("".join(held), *now, BEGINNING if begun else MIDDLE))
                now = (path, block)
                inside, depth = begin[now]
                # Something is open from the block before: an element, or an array that is none.
                held, begun = ([], False) if depth > 1 else (None, False)
            inside, depth, start, down = scan(piece, inside, depth)
            if held is not None and not begun and down:
                held = None  # it was an array
            if held is not None:
                held.append(piece)
            elif start >= 0:
                held, begun = [piece[start:]], True
            if inside:
                if held is not None:
                    held.append("}")  # the piece ended at a brace in a string
                continue
            depth = max(depth - 1, 0)
            if held is not None:
                held.append("}")
                if depth == 1:
                    out.append(("".join(held), path, block, WHOLE if begun else END))
                    held, begun = None, False
                    if len(out) >= 1000:
                        yield batch()
        if held is not None:
            out.append(("".join(held), *now, BEGINNING if begun else MIDDLE))
        yield batch()

    found = pieces.mapInArrow(elements, "value string, path string, block bigint, part int")
    folder = scratch_path(spark, "elements")
    found.write.parquet(folder)
    found = spark.read.schema(found.schema).parquet(folder)
    # At most two fragments a block: the end of an element from before, and the beginning of one that goes on.
    order = Window.partitionBy("path").orderBy("block", "part")
    ends = F.coalesce(F.sum((F.col("part") == END).cast("int")).over(
        Window.partitionBy("path", "element").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chains = (found.where(F.col("part") != WHOLE).withColumn("element", F.sum((F.col("part") == BEGINNING).cast("int")).over(order))
              # What follows an end belongs to no element.
              .withColumn("ends", ends).where("element > 0 and ends = 0").groupBy("path", "element")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "value"))), lambda s: s["value"]), "").alias("value"),
                   F.max((F.col("part") == END).cast("int")).alias("closed")))
    return found.where(F.col("part") == WHOLE).select("value").unionByName(chains.where("closed = 1").select("value"))


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A table of JSON arrays, as the multi-line reader gives it, read in ranges.

    The elements are stored as lines first, which Spark's own reader takes, so
    inference and types are its own. Every piece of an element in memory is
    bounded by the element.
    """
    lines = scratch_path(spark, "json-lines")
    # Line breaks can only be white space between tokens.
    array_elements(spark, path).select(F.translate("value", "\r\n", "  ").alias("value")).write.text(lines)
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).json(lines)
