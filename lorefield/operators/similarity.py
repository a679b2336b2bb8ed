"""All-pairs cosine similarity of vector tables.

A side is a DataFrame with an id column, a vector column and, for sweeps over
several collections, a collection column. Work is split in one of two ways:

* one side is *measured* and fits ``broadcast_bytes``: it is sent to every
  executor and the other side streams past it, without a shuffle;
* otherwise both sides are hashed into stripes of bounded size, every pair of
  stripes meets in exactly one group, and no group grows with the data.

Top-k and statistics are folded where the pairs are formed, so only the matrix
operator itself ever emits one row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20   # largest side sent to every executor
STRIPE_BYTES = 64 << 20      # size of one stripe in a task
STRIPE_ROWS = 32_768         # most rows of a stripe
TASK_CELLS = 1 << 28         # cells of a task where the held side is sent
TILE_CELLS = 1 << 20         # cells computed at once in a task
TILE_ROWS = 512              # rows of a tile; its columns follow from its cells
ORDERED_CELLS = 1 << 22      # cells that a task puts in order of value at once
SQUARE_ROWS = 4096           # rows of either side that such cells come from, as far as possible
DECIMALS = 12                # equal vectors score equally whatever the kernel
SLACK = 1e-9                 # cells nearer to a bound than this are rounded before they are judged


# --- inside tasks -----------------------------------------------------------

@dataclass
class Block:
    """Vectors of one collection and one dimension, as unit rows."""

    collection: str
    ids: pa.Array
    rows: np.ndarray

    @property
    def dim(self) -> int:
        return self.rows.shape[1]


def _blocks(table: pa.Table, cut: int | None = None) -> list[Block]:
    """Unit-length blocks, in id order, of a ``(collection, id, vector)`` table; with ``cut`` two unit vectors in one."""
    if table.num_rows == 0:
        return []
    table = table.combine_chunks()
    table = table.take(pc.sort_indices(table.column(1))).combine_chunks()
    names, ids, vectors = (_flat(table.column(i)) for i in range(3))
    if vectors.null_count:
        raise ValueError("a row has no embedding")
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    coded = names.dictionary_encode()
    keys = np.stack([coded.indices.to_numpy(zero_copy_only=False), sizes], axis=1)
    out = []
    for code, dim in np.unique(keys, axis=0):
        where = np.flatnonzero((keys[:, 0] == code) & (keys[:, 1] == dim))
        part = vectors if len(where) == len(sizes) else vectors.take(pa.array(where))
        rows = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(where), int(dim))
        for part_rows in (rows,) if cut is None else (rows[:, :cut], rows[:, cut:]):
            length = np.sqrt(np.einsum("ij,ij->i", part_rows, part_rows))
            length[length == 0] = 1.0
            part_rows /= length[:, None]
        part_ids = ids if len(where) == len(sizes) else ids.take(pa.array(where))
        out.append(Block(coded.dictionary[int(code)].as_py(), part_ids, rows))
    return out


def _flat(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)
    return column


def _raw(y: np.ndarray, x: np.ndarray, floor0: bool) -> np.ndarray:
    raw = y @ x.T
    if np.isnan(y).any() or np.isnan(x).any():
        # A vector with NaN: like itself and all others in a matrix, never found in a search.
        raw[np.isnan(raw)] = 1.0 if floor0 else -1.0
    return raw


def _scores(raw: np.ndarray, floor0: bool) -> np.ndarray:
    """Final values of raw products."""
    return np.round(np.clip(raw, 0.0 if floor0 else -1.0, 1.0), DECIMALS) + 0.0


def _held(raw: np.ndarray, low: float, high: float, floor0: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the cells in an inclusive range; only cells near it are rounded."""
    near = raw >= low - SLACK if low > (0.0 if floor0 else -1.0) else np.ones(raw.shape, bool)
    if high < 1.0:
        near &= raw <= high + SLACK
    rows, cols = np.nonzero(near)
    sim = _scores(raw[near], floor0)
    sure = (sim >= low) & (sim <= high)
    return (rows, cols, sim) if sure.all() else (rows[sure], cols[sure], sim[sure])


def _above(raw: np.ndarray, bound: float, strict: bool, floor0: bool) -> int:
    """Cells above a bound, or at it if not strict."""
    sure = int(np.count_nonzero(raw > bound + SLACK))
    if np.count_nonzero(raw > bound - SLACK) == sure:
        return sure
    edge = _scores(raw[(raw > bound - SLACK) & (raw <= bound + SLACK)], floor0)
    return sure + int(np.count_nonzero(edge > bound if strict else edge >= bound))


def _tiles(x: Block, y: Block) -> Iterator[tuple[int, int, int, int]]:
    """Rows of ``y`` and columns of ``x`` of each tile, row by row of tiles."""
    step = min(TILE_ROWS, max(1, len(y.rows)))
    span = max(1, TILE_CELLS // step)
    for a in range(0, len(y.rows), step):
        for c in range(0, len(x.rows), span):
            yield a, min(a + step, len(y.rows)), c, min(c + span, len(x.rows))


def _squares(x: Block, y: Block) -> Iterator[tuple[int, int, int, int]]:
    """The same square by square, so that tiles in a row share the ids of both sides."""
    for c in range(0, len(x.rows), SQUARE_ROWS):
        for a in range(0, len(y.rows), SQUARE_ROWS):
            part = (Block(s.collection, s.ids, s.rows[at:at + SQUARE_ROWS]) for s, at in ((x, c), (y, a)))
            for begin, end, left, right in _tiles(*part):
                yield a + begin, a + end, c + left, c + right


def _meet(xs: list[Block], ys: list[Block], strict: bool) -> Iterator[tuple[Block, Block]]:
    for y in ys:
        for x in xs:
            if x.dim == y.dim:
                yield x, y
            elif strict:
                raise ValueError(f"vector sizes differ: {x.collection} has {x.dim}, {y.collection} has {y.dim}")


def _constant(value: str, n: int) -> pa.Array:
    return pa.repeat(pa.scalar(value, pa.string()), n)


class Cells:
    """One output row per pair.

    Cells leave tile by tile, or with ``by_value`` in runs of ``ORDERED_CELLS`` by value: values that are equal, or become
    so when they are rounded, then lie side by side, and files that hold the cells are smaller.
    """

    fields = "x_collection string, y_collection string, y_id {y}, x_id {x}, sim double"

    def __init__(self, floor0: bool, by_value: bool = False):
        self.floor0, self.by_value = floor0, by_value

    def start(self):
        return self

    def add(self, x: Block, y: Block) -> Iterator[pa.RecordBatch]:
        run, held = [], 0
        for a, b, c, d in (_squares if self.by_value else _tiles)(x, y):
            rows, cols, sim = self.found(y.rows[a:b], x.rows[c:d])
            if not self.by_value:
                yield from self._out(x, y, rows + a, cols + c, sim)
                continue
            run.append(((rows + a).astype(np.int32), (cols + c).astype(np.int32), sim))
            held += len(sim)
            if held >= ORDERED_CELLS:
                yield from self._ordered(x, y, run)
                run, held = [], 0
        if held:
            yield from self._ordered(x, y, run)

    def _ordered(self, x: Block, y: Block, run: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows, cols, sim = (np.concatenate(parts) for parts in zip(*run))
        # A short run has few equal values: there its ids in order save more.
        order = np.argsort(sim, kind="stable") if len(sim) >= ORDERED_CELLS // 4 else np.arange(len(sim))
        for at in range(0, len(order), TILE_CELLS):
            some = order[at:at + TILE_CELLS]
            yield from self._out(x, y, rows[some], cols[some], sim[some])

    @staticmethod
    def _out(x: Block, y: Block, rows: np.ndarray, cols: np.ndarray, sim: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(sim):
            yield pa.RecordBatch.from_arrays(
                [_constant(x.collection, len(sim)), _constant(y.collection, len(sim)),
                 y.ids.take(pa.array(rows)), x.ids.take(pa.array(cols)), pa.array(sim)],
                names=["x_collection", "y_collection", "y_id", "x_id", "sim"])

    def found(self, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and values of the cells that leave a tile."""
        return np.repeat(np.arange(len(y)), len(x)), np.tile(np.arange(len(x)), len(y)), self.values(y, x).ravel()

    def values(self, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        return _scores(_raw(y, x, self.floor0), self.floor0)

    def end(self) -> Iterator[pa.RecordBatch]:
        return iter(())


class Rows(Cells):
    """One output row per y and collection of x: its values in the order of the x ids."""

    fields = "x_collection string, y_id {y}, row array<double>"

    def add(self, x: Block, y: Block) -> Iterator[pa.RecordBatch]:
        step, width = max(1, TILE_CELLS // len(x.rows)), len(x.rows)
        for a in range(0, len(y.rows), step):
            sim = self.values(y.rows[a:a + step], x.rows)
            ends = pa.array(np.arange(0, sim.size + 1, width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [_constant(x.collection, len(sim)), y.ids.slice(a, len(sim)), pa.ListArray.from_arrays(ends, pa.array(sim.ravel()))],
                names=["x_collection", "y_id", "row"])


class Apart(Cells):
    """One output row per pair: the difference of two matrices over the same rows, given as two vectors in one."""

    def __init__(self, floor0: bool, cut: int, by_value: bool = False):
        super().__init__(floor0, by_value)
        self.cut = cut

    def values(self, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        return super().values(y[:, :self.cut], x[:, :self.cut]) - super().values(y[:, self.cut:], x[:, self.cut:])


@dataclass
class Moments:
    """Count, mean, squared deviation, extremes and band counts per pair of collections."""

    floor0: bool
    sums: dict = field(default_factory=dict)

    fields = ("x_collection string, y_collection string, n bigint, mean double, m2 double, "
              "low double, high double, n_high bigint, n_medium bigint, n_low bigint")

    def start(self):
        return Moments(self.floor0)

    def add(self, x: Block, y: Block) -> Iterator[pa.RecordBatch]:
        for a, b, c, d in _tiles(x, y):
            sim = _raw(y.rows[a:b], x.rows[c:d], self.floor0)
            np.clip(sim, 0.0 if self.floor0 else -1.0, 1.0, out=sim)
            high, upper = _above(sim, 0.8, True, self.floor0), _above(sim, 0.5, False, self.floor0)
            ends = [float(v) for v in _scores(np.array([sim.min(), sim.max()]), self.floor0)]
            mean = float(sim.mean())
            sim -= mean
            one = [sim.size, mean, float(np.vdot(sim, sim)), *ends, high, upper - high, sim.size - upper]
            key = (x.collection, y.collection)
            old = self.sums.get(key)
            if old:
                n = old[0] + one[0]
                shift = one[1] - old[1]
                one = [n, old[1] + shift * one[0] / n, old[2] + one[2] + shift * shift * old[0] * one[0] / n,
                       min(old[3], one[3]), max(old[4], one[4]), *(p + q for p, q in zip(old[5:], one[5:]))]
            self.sums[key] = one
        return iter(())

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.sums:
            rows = [(*key, *vals) for key, vals in self.sums.items()]
            names = ["x_collection", "y_collection", "n", "mean", "m2", "low", "high", "n_high", "n_medium", "n_low"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=names)


class Within(Cells):
    """One output row per pair whose value lies in an inclusive range; the others never leave the tile."""

    def __init__(self, floor0: bool, low: float, high: float, by_value: bool = False):
        super().__init__(floor0, by_value)
        self.low, self.high = low, high

    def found(self, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _held(_raw(y, x, self.floor0), self.low, self.high, self.floor0)


class Judged:
    """Of two matrices over the same rows, given as two vectors in one: counts of a range of the first against one of the
    second, or of their difference."""

    fields = "cells bigint, true_positive bigint, false_positive bigint, false_negative bigint"

    def __init__(self, floor0: bool, cut: int, truth: tuple[float, float], judged: tuple[float, float], difference: bool):
        self.floor0, self.cut, self.truth, self.judged, self.difference = floor0, cut, truth, judged, difference

    def start(self):
        return self

    def add(self, x: Block, y: Block) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(4, np.int64)
        for a, b, c, d in _tiles(x, y):
            one, two = (_raw(y.rows[a:b, s], x.rows[c:d, s], self.floor0) for s in (slice(0, self.cut), slice(self.cut, None)))
            rows, cols, _ = _held(one, *self.truth, self.floor0)
            truth = np.zeros(one.shape, bool)
            truth[rows, cols] = True
            if self.difference:
                apart = np.round(_scores(one, self.floor0) - _scores(two, self.floor0), DECIMALS)
                at = np.nonzero((apart >= self.judged[0]) & (apart <= self.judged[1]))
            else:
                at = _held(two, *self.judged, self.floor0)[:2]
            both = int(np.count_nonzero(truth[at]))
            counts += [truth.size, both, len(at[0]) - both, len(rows) - both]
        yield pa.RecordBatch.from_arrays([pa.array([int(n)]) for n in counts],
                                         names=["cells", "true_positive", "false_positive", "false_negative"])

    def end(self) -> Iterator[pa.RecordBatch]:
        return iter(())


class Counted:
    """Per y of a block pair: cells, cells in an inclusive range, and whether the cell with itself is one."""

    fields = "y_id {y}, cells bigint, kept bigint, diagonal bigint"

    def __init__(self, floor0: bool, low: float, high: float):
        self.floor0, self.low, self.high = floor0, low, high

    def start(self):
        return self

    def add(self, x: Block, y: Block) -> Iterator[pa.RecordBatch]:
        n = len(y.rows)
        own = pc.fill_null(pc.index_in(y.ids, value_set=x.ids), -1).to_numpy(zero_copy_only=False)
        cells, kept, diagonal = (np.zeros(n, np.int64) for _ in range(3))
        every = self.low <= (0.0 if self.floor0 else -1.0) and self.high >= 1.0
        for a, b, c, d in _tiles(x, y):
            raw = _raw(y.rows[a:b], x.rows[c:d], self.floor0)
            cells[a:b] += d - c
            if every:
                kept[a:b] += raw.shape[1]
                diagonal[a:b] |= (own[a:b] >= c) & (own[a:b] < d)
            else:
                rows, cols, _ = _held(raw, self.low, self.high, self.floor0)
                kept[a:b] += np.bincount(rows, minlength=b - a)
                diagonal[a + rows[own[a + rows] == c + cols]] = 1
        yield pa.RecordBatch.from_arrays([y.ids, pa.array(cells), pa.array(kept), pa.array(diagonal)],
                                         names=["y_id", "cells", "kept", "diagonal"])

    def end(self) -> Iterator[pa.RecordBatch]:
        return iter(())


@dataclass
class Best:
    """The k best partners of each y (``axis='x'``) or of each x (``axis='y'``).

    Ties go to the smaller id. Partial lists are merged as blocks arrive, so a
    task holds k rows per item of the fixed side however many it meets.
    """

    floor0: bool
    k: int
    axis: str
    kept: pa.Table | None = None
    rows_kept: int = 0

    fields = "x_collection string, y_collection string, y_id {y}, x_id {x}, sim double"

    def start(self):
        return Best(self.floor0, self.k, self.axis)

    def _trim(self, table: pa.Table) -> pa.Table:
        row, other = ("y_id", "x_id") if self.axis == "x" else ("x_id", "y_id")
        order = pc.sort_indices(table, sort_keys=[
            ("x_collection", "ascending"), ("y_collection", "ascending"), (row, "ascending"),
            ("sim", "descending"), (other, "ascending")])
        table = table.take(order).combine_chunks()
        if table.num_rows == 0:
            return table
        first = np.zeros(table.num_rows, dtype=bool)
        first[0] = True
        for name in ("x_collection", "y_collection", row):
            col = _flat(table.column(name))
            first[1:] |= pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
        begin = np.flatnonzero(first)
        position = np.arange(table.num_rows) - np.repeat(begin, np.diff(np.append(begin, table.num_rows)))
        return table.filter(pa.array(position < self.k))

    def _candidates(self, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the k best of each row; columns are in id order.

        Of values equal to the k-th only the first ones are taken, so a large
        group of copies costs no more than any other rows.
        """
        n = sim.shape[1]
        if self.k >= n:
            return np.nonzero(np.ones_like(sim, dtype=bool))
        bound = np.partition(sim, n - self.k, axis=1)[:, n - self.k, None]
        chosen = sim >= bound
        crowded = np.flatnonzero(chosen.sum(axis=1) > self.k)
        if len(crowded):
            tied = sim[crowded] == bound[crowded]
            left = self.k - (sim[crowded] > bound[crowded]).sum(axis=1, keepdims=True)
            chosen[crowded] &= ~tied | (np.cumsum(tied, axis=1, dtype=np.int32) <= left)
        return np.nonzero(chosen)

    def _strips(self, fixed: Block, moving: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per strip of the fixed side its first row, and rows, columns and values of the k best.

        Columns are in id order, so after the first tile only a value above the
        k-th so far can matter, and only such values are rounded.
        """
        rows = cols = sim = bound = None
        for a, b, c, d in _tiles(moving, fixed):
            raw = _raw(fixed.rows[a:b], moving.rows[c:d], self.floor0)
            if c == 0:
                first = _scores(raw, self.floor0)
                rows, cols = self._candidates(first)
                sim = first[rows, cols]
                found = len(rows)
            else:
                more, at = np.nonzero(raw > bound[:, None] - SLACK)
                values = _scores(raw[more, at], self.floor0)
                better = values > bound[more]
                found = int(better.sum())
                rows, cols, sim = (np.concatenate(p) for p in ((rows, more[better]), (cols, at[better] + c), (sim, values[better])))
            if found:
                order = np.lexsort((cols, -sim, rows))
                rows, cols, sim = rows[order], cols[order], sim[order]
                begin = np.searchsorted(rows, np.arange(b - a))
                place = np.arange(len(rows)) - begin[rows]
                rows, cols, sim, place = (v[place < self.k] for v in (rows, cols, sim, place))
                bound = np.full(b - a, -np.inf)
                bound[rows[place == self.k - 1]] = sim[place == self.k - 1]
            if d == len(moving.rows):
                yield a, rows, cols, sim

    def add(self, x: Block, y: Block) -> Iterator[pa.RecordBatch]:
        fixed, moving = (y, x) if self.axis == "x" else (x, y)
        for a, rows, cols, sim in self._strips(fixed, moving):
            fixed_ids, moving_ids = fixed.ids.take(pa.array(rows + a)), moving.ids.take(pa.array(cols))
            y_ids, x_ids = (fixed_ids, moving_ids) if self.axis == "x" else (moving_ids, fixed_ids)
            part = pa.table({
                "x_collection": _constant(x.collection, len(rows)), "y_collection": _constant(y.collection, len(rows)),
                "y_id": y_ids, "x_id": x_ids, "sim": pa.array(sim)})
            self.kept = part if self.kept is None else pa.concat_tables([self.kept, part])
            if self.kept.num_rows > max(2 * self.rows_kept, TILE_CELLS):
                self.kept = self._trim(self.kept)
                self.rows_kept = self.kept.num_rows
        return iter(())

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.kept is not None:
            yield from self._trim(self.kept).to_batches()


class BestStreamed(Best):
    """``Best`` when each item of the ranked side meets all partners in one batch."""

    def start(self):
        return BestStreamed(self.floor0, self.k, self.axis)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.kept is not None:
            yield from self._trim(self.kept).to_batches()
            self.kept, self.rows_kept = None, 0


# --- the plan ---------------------------------------------------------------

def vectors(df: DataFrame, id_col: str = "id", vec_col: str = "embedding",
            collection: str | None = None) -> DataFrame:
    """The three columns a side needs; all others are pruned from the scan."""
    name = F.col(collection).cast("string") if collection else F.lit("")
    return df.select(name.alias("collection"), F.col(id_col).alias("id"), F.col(vec_col).alias("embedding"))


@dataclass(frozen=True)
class Size:
    """Rows of a side, bytes of its vectors with ids and names, and the longest vector."""

    rows: int
    bytes: int
    longest: int


def _measure(side: DataFrame) -> Size:
    """One pass over a side, so computed vectors are computed once here."""
    taken = F.size("embedding") * 8 + F.octet_length(F.col("id").cast("string")) + F.octet_length("collection") + 16
    return Size(*side.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.coalesce(taken, F.lit(16))), F.lit(0)),
                          F.coalesce(F.max(F.size("embedding")), F.lit(1))).first())


def _stripes(side: Size, stripe_bytes: int, stripe_rows: int | None) -> int:
    """Number of stripes so that none exceeds the given size, by the longest vector."""
    most = max(1, stripe_bytes // (8 * max(1, side.longest)))
    return -(-side.rows // (min(most, stripe_rows) if stripe_rows else most))


def _id_type(side: DataFrame) -> str:
    return side.schema["id"].dataType.simpleString()


def pair_up(x: DataFrame, y: DataFrame, fold: Cells | Counted | Moments | Best, strict: bool,
            broadcast_bytes: int = BROADCAST_BYTES, stripe_bytes: int = STRIPE_BYTES) -> DataFrame:
    """Run ``fold`` over every pair of blocks of two sides from :func:`vectors`."""
    schema = fold.fields.format(x=_id_type(x), y=_id_type(y))
    x_size = _measure(x)
    y_size = x_size if y is x else _measure(y)
    if x_size.rows == 0 or y_size.rows == 0:
        raise ValueError("a side of the comparison has no rows")
    fits = {name: size.bytes for name, size in (("x", x_size), ("y", y_size)) if size.bytes <= broadcast_bytes}
    if isinstance(fold, Rows):
        # A collection of x meets a y whole, so x never streams in parts.
        fits = {name: size for name, size in fits.items() if "x" in fits}
    if fits:
        # With both in range, send the side whose partner can be ranked while streaming.
        preferred = "y" if isinstance(fold, Best) and fold.axis == "y" else "x"
        held = preferred if preferred in fits else next(iter(fits))
        cells = x_size.rows * y_size.rows
        if len(fits) == 2 and cells > TILE_CELLS:
            # Small tables come in few partitions, but their pairs are worth every core, and no task has more with more rows.
            parts = max(x.sparkSession.sparkContext.defaultParallelism, -(-cells // TASK_CELLS))
            # Runs by value end with a collection, so its rows stay together.
            ranged = isinstance(fold, Cells) and fold.by_value
            dealt = lambda d: d.repartitionByRange(parts, "collection", "id") if ranged else d.repartition(parts, "id")
            x, y = (x, dealt(y)) if held == "x" else (dealt(x), y)
        return _broadcast_side(x, y, fold, strict, held, schema)
    nx, ny = _stripes(x_size, stripe_bytes, STRIPE_ROWS), _stripes(y_size, stripe_bytes, STRIPE_ROWS)
    return _striped(x, y, fold, strict, schema, nx, ny)


def _broadcast_side(x: DataFrame, y: DataFrame, fold, strict: bool, held: str, schema: str) -> DataFrame:
    spark = x.sparkSession
    # Plain tuples: a broadcast is unpickled without the classes of this package.
    cut = getattr(fold, "cut", None)
    blocks = _blocks((x if held == "x" else y).toArrow(), cut)
    sent = spark.sparkContext.broadcast([(b.collection, b.ids, b.rows) for b in blocks])
    if isinstance(fold, Best) and (held == "x") == (fold.axis == "x"):
        fold = BestStreamed(fold.floor0, fold.k, fold.axis)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = fold.start()
        fixed = [Block(*parts) for parts in sent.value]
        for batch in batches:
            moving = _blocks(pa.Table.from_batches([batch]), cut)
            xs, ys = (fixed, moving) if held == "x" else (moving, fixed)
            for xb, yb in _meet(xs, ys, strict):
                yield from state.add(xb, yb)
            if isinstance(state, BestStreamed):
                yield from state.flush()
        yield from state.end()

    return (y if held == "x" else x).mapInArrow(run, schema)


def _striped(x: DataFrame, y: DataFrame, fold, strict: bool, schema: str, nx: int, ny: int) -> DataFrame:
    spread = F.xxhash64("id", "embedding")
    x_spread = F.col("collection").cast("bigint") if isinstance(fold, Rows) else spread
    x_cells = x.select(
        "collection", F.col("id").alias("x_id"), F.lit(None).cast(_id_type(y)).alias("y_id"), "embedding",
        F.pmod(x_spread, F.lit(nx)).cast("int").alias("sx"), F.explode(F.sequence(F.lit(0), F.lit(ny - 1))).alias("sy"),
        F.lit(True).alias("is_x"))
    y_cells = y.select(
        "collection", F.lit(None).cast(_id_type(x)).alias("x_id"), F.col("id").alias("y_id"), "embedding",
        F.explode(F.sequence(F.lit(0), F.lit(nx - 1))).alias("sx"), F.pmod(spread, F.lit(ny)).cast("int").alias("sy"),
        F.lit(False).alias("is_x"))
    out_schema = T.StructType.fromDDL(schema)

    def run(cell: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        cell, cut = pa.Table.from_batches(cell), getattr(fold, "cut", None)
        is_x = cell.column("is_x")
        xs = _blocks(cell.filter(is_x).select(["collection", "x_id", "embedding"]), cut)
        ys = _blocks(cell.filter(pc.invert(is_x)).select(["collection", "y_id", "embedding"]), cut)
        state = fold.start()
        target = to_arrow_schema(out_schema)

        def made() -> Iterator[pa.RecordBatch]:
            for xb, yb in _meet(xs, ys, strict):
                yield from state.add(xb, yb)
            yield from state.end()

        for batch in made():
            yield from pa.Table.from_batches([batch]).cast(target).to_batches()

    return x_cells.unionByName(y_cells).groupBy("sx", "sy").applyInArrow(run, schema)


# --- operators --------------------------------------------------------------

def similarity_matrix(x: DataFrame, y: DataFrame, id_col: str = "id", vec_col: str = "embedding",
                      floor0: bool = True, by_value: bool = False, block: int | None = None, **limits: int) -> DataFrame:
    """Long-form matrix ``y_id, x_id, sim``; vectors of different size fail. ``by_value`` is for files, see ``Cells``.

    With ``block``, for ids that are positions, the matrix as rows ``y_id, from, row``: of each y the values of ``block``
    columns, the first of which is ``from``. They are put together where pairs are formed.
    """
    if block:
        parts = x.withColumn("_block", F.floor(F.col(id_col) / block))
        rows = pair_up(vectors(parts, id_col, vec_col, "_block"), vectors(y, id_col, vec_col), Rows(floor0), True, **limits)
        return rows.select("y_id", (F.col("x_collection").cast("bigint") * block).alias("from"), "row")
    xs = vectors(x, id_col, vec_col)
    ys = xs if y is x else vectors(y, id_col, vec_col)
    return pair_up(xs, ys, Cells(floor0, by_value), True, **limits).select("y_id", "x_id", "sim")


def similarity_within(x: DataFrame, y: DataFrame, low: float = 0.0, high: float = 1.0, id_col: str = "id",
                      vec_col: str = "embedding", floor0: bool = True, by_value: bool = False, **limits: int) -> DataFrame:
    """The cells ``y_id, x_id, sim`` of a matrix whose value is in an inclusive range."""
    xs = vectors(x, id_col, vec_col)
    ys = xs if y is x else vectors(y, id_col, vec_col)
    return pair_up(xs, ys, Within(floor0, low, high, by_value), True, **limits).select("y_id", "x_id", "sim")


@dataclass(frozen=True)
class Paired:
    """``rows``: ``id, embedding`` with both vectors of each id that either table has once; ``others``: all other ids."""

    rows: DataFrame
    others: DataFrame
    n_rows: int
    n_others: int
    cut: int

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of a table by whether their id is one of ``others``."""
        same = df["id"].eqNullSafe(self.others["other"])
        return df.join(self.others, same, "left_semi"), df.join(self.others, same, "left_anti")


def paired(first: DataFrame, second: DataFrame, id_col: str = "id", vec_col: str = "embedding") -> Paired:
    """Two tables of vectors side by side; the first's vectors have one size."""
    one, two = (vectors(d, id_col, vec_col).drop("collection") for d in (first, second))
    both = (one.select("id", F.col("embedding").alias("a"), F.lit(None).alias("b"), F.lit(1).alias("n"), F.lit(0).alias("m"))
            .unionByName(two.select("id", F.lit(None).alias("a"), F.col("embedding").alias("b"), F.lit(0).alias("n"), F.lit(1).alias("m")))
            .groupBy("id").agg(F.first("a", True).alias("a"), F.first("b", True).alias("b"), F.sum("n").alias("n"), F.sum("m").alias("m")))
    single = F.col("id").isNotNull() & (F.col("n") == 1) & (F.col("m") == 1)
    n, m, least, cut = both.agg(F.count_if(single), F.count_if(~single), F.min(F.size("a")), F.max(F.size("a"))).first()
    if n and least != cut and both.where(single).agg(F.min(F.size("a")) != F.max(F.size("a"))).first()[0]:
        raise ValueError("vector sizes differ")
    return Paired(both.where(single).select("id", F.concat("a", "b").alias("embedding")), both.where(~single).select(F.col("id").alias("other")),
                  n, m, cut or 0)


def judged_pairs(x: Paired, y: Paired, truth: tuple[float, float], judged: tuple[float, float], difference: bool = False,
                 floor0: bool = True, **limits: int) -> DataFrame:
    """One row ``cells, true_positive, false_positive, false_negative`` over all pairs of the paired rows; no cell leaves its tile."""
    xs = vectors(x.rows)
    ys = xs if y is x else vectors(y.rows)
    parts = pair_up(xs, ys, Judged(floor0, x.cut, truth, judged, difference), True, **limits)
    return parts.agg(*[F.sum(c).alias(c) for c in ("cells", "true_positive", "false_positive", "false_negative")])


def paired_difference(x: Paired, y: Paired, floor0: bool = True, by_value: bool = False, **limits: int) -> DataFrame:
    """The cells ``y_id, x_id, sim`` of the first matrix less the second over all pairs of the paired rows; neither is formed as rows."""
    if x.cut != y.cut:
        raise ValueError("vector sizes differ")
    xs = vectors(x.rows)
    ys = xs if y is x else vectors(y.rows)
    return pair_up(xs, ys, Apart(floor0, x.cut, by_value), True, **limits).select("y_id", "x_id", "sim")


def similarity_at(cells: DataFrame, x: DataFrame, y: DataFrame, id_col: str = "id", vec_col: str = "embedding",
                  floor0: bool = True) -> DataFrame:
    """``y_id, x_id, sim`` of given cells ``y_id, x_id``; what is moved grows with the cells and not with the matrix.

    A cell comes once per pair of rows with its ids; vectors of different size,
    and a cell whose row has no vector, fail.
    """
    ys = y.select(F.col(id_col).alias("y_id"), F.col(vec_col).alias("y_vec"))
    xs = x.select(F.col(id_col).alias("x_id"), F.col(vec_col).alias("x_vec"))
    # Cells are more than Spark estimates for computed rows: never broadcast.
    pairs = cells.select("y_id", "x_id").distinct().hint("merge").join(ys, "y_id").hint("merge").join(xs, "x_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = pa.array(np.arange(batch.num_rows))
            name = _constant("", batch.num_rows)
            sides = [_blocks(pa.table([name, place, batch.column(c)], names=["c", "i", "v"])) for c in ("y_vec", "x_vec")]
            if [(b.dim, b.ids) for b in sides[0]] != [(b.dim, b.ids) for b in sides[1]]:
                raise ValueError("vector sizes differ")
            for yb, xb in zip(*sides):
                raw = np.einsum("ij,ij->i", yb.rows, xb.rows)
                raw[np.isnan(raw)] = 1.0 if floor0 else -1.0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("y_id").take(yb.ids), batch.column("x_id").take(yb.ids), pa.array(_scores(raw, floor0))],
                    names=["y_id", "x_id", "sim"])

    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}
    return pairs.select("y_id", "x_id", "y_vec", "x_vec").mapInArrow(run, f"y_id {kinds['y_id']}, x_id {kinds['x_id']}, sim double")


def items_within(x: DataFrame, y: DataFrame, low: float = 0.0, high: float = 1.0, id_col: str = "id",
                 vec_col: str = "embedding", floor0: bool = True, **limits: int) -> DataFrame:
    """Per y: ``y_id, cells, kept, diagonal`` of the range mask, without forming the matrix."""
    xs = vectors(x, id_col, vec_col)
    ys = xs if y is x else vectors(y, id_col, vec_col)
    parts = pair_up(xs, ys, Counted(floor0, low, high), True, **limits)
    return parts.groupBy("y_id").agg(*[F.sum(c).alias(c) for c in ("cells", "kept", "diagonal")])


def collection_similarity(x: DataFrame, y: DataFrame, id_col: str = "id", vec_col: str = "embedding", floor0: bool = True,
                          **limits: int) -> DataFrame:
    """Statistics of one matrix, without forming it."""
    one = lambda d: d.select(F.lit("").alias("_all"), F.col(id_col).alias("id"), F.col(vec_col).alias("embedding"))
    xs = one(x)
    ys = xs if y is x else one(y)
    return sweep_stats(xs, ys, "_all", floor0=floor0, **limits).drop("x_collection", "y_collection")


def matrix_sweep(x: DataFrame, y: DataFrame, collection: str = "collection", id_col: str = "id",
                 vec_col: str = "embedding", floor0: bool = True, by_value: bool = False, **limits: int) -> DataFrame:
    """Matrices of every collection of ``x`` with every collection of ``y``.

    Pairs of collections with different vector sizes have no cells.
    """
    xs = vectors(x, id_col, vec_col, collection)
    ys = xs if y is x else vectors(y, id_col, vec_col, collection)
    return pair_up(xs, ys, Cells(floor0, by_value), False, **limits)


def sweep_stats(x: DataFrame, y: DataFrame, collection: str = "collection", id_col: str = "id",
                vec_col: str = "embedding", floor0: bool = True, **limits: int) -> DataFrame:
    """Statistics per pair of collections, without forming the matrices."""
    xs = vectors(x, id_col, vec_col, collection)
    ys = xs if y is x else vectors(y, id_col, vec_col, collection)
    parts = pair_up(xs, ys, Moments(floor0), False, **limits)
    total, mean = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    spread = F.sum(F.col("m2") + F.col("n") * F.col("mean") * F.col("mean")) / total - mean * mean
    return parts.groupBy("x_collection", "y_collection").agg(
        total.alias("total_pairs"), mean.alias("avg_similarity"),
        F.min("low").alias("min_similarity"), F.max("high").alias("max_similarity"),
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias("std_similarity"),
        F.sum("n_high").alias("high_similarity_count"), F.sum("n_medium").alias("medium_similarity_count"),
        F.sum("n_low").alias("low_similarity_count"))


def similarity_topk(x: DataFrame, y: DataFrame, k: int, axis: str = "x", id_col: str = "id",
                    vec_col: str = "embedding", floor0: bool = True, **limits: int) -> DataFrame:
    """The k best x of each y (``axis='x'``) or the k best y of each x (``axis='y'``).

    Returns ``y_id, x_id, sim, rank``. Each task reports at most k partners
    per item, and only those are ranked across tasks.
    """
    if k < 1 or axis not in ("x", "y"):
        raise ValueError("k must be positive and axis 'x' or 'y'")
    xs = vectors(x, id_col, vec_col)
    ys = xs if y is x else vectors(y, id_col, vec_col)
    best = pair_up(xs, ys, Best(floor0, k, axis), True, **limits)
    row, other = ("y_id", "x_id") if axis == "x" else ("x_id", "y_id")
    order = Window.partitionBy(row).orderBy(F.desc("sim"), F.asc(other))
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("y_id", "x_id", "sim", "rank"))


def similarity_stats(matrix: DataFrame, *keys: str, sim: str = "sim") -> DataFrame:
    """Statistics of a long-form matrix, per ``keys`` if given."""
    s = F.col(sim)
    aggs = [
        F.count(s).alias("total_pairs"), F.avg(s).alias("avg_similarity"),
        F.min(s).alias("min_similarity"), F.max(s).alias("max_similarity"),
        F.stddev_pop(s).alias("std_similarity"),
        F.count_if(s > 0.8).alias("high_similarity_count"),
        F.count_if(s.between(0.5, 0.8)).alias("medium_similarity_count"),
        F.count_if(s < 0.5).alias("low_similarity_count"),
    ]
    return matrix.groupBy(*keys).agg(*aggs) if keys else matrix.agg(*aggs)


