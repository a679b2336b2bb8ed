"""From documents to heading-aware chunks.

``chunk_documents`` keeps a document in one row until its chunks are final, so
chunking a corpus moves no text between executors. ``chunk_positions`` gives the
same positions for a table that already holds chunks; ``heading_paths`` and
``part_suffix`` are its two halves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lorefield.functions.links import image_urls, mask_links, plain_keys, restore_links
from lorefield.functions.splitting import split_text
from lorefield.functions.strings import collapse_markdown_runs, once, stem, strip
from lorefield.session import bound_batches

# Priorities of heading-like lines; the first match counts.
HEADINGS = (
    (r"^# ", 0), (r"^## ", 1), (r"^### ", 2), (r"^#### ", 3), (r"^##### ", 4), (r"^###### ", 5),
    (r"^\p{Nd}+\. ", 6), (r"^- ", 6), (r"^\* ", 6), (r"(?d)^\*\*.*\*\*$", 6),
)
# Underlines turn the line before them into a heading of this priority.
UNDERLINES = ((r"^=+$", 0), (r"^-+$", 1))
# Any heading or underline starts like this; chunks without one skip the line work.
CANDIDATE = r"(?mU)^[\s\x1c-\x1f]*[#*=\p{Nd}-]"
LEVELS = range(7)
JOINT = " > "
RUN = 512         # chunks of a document whose positions are gathered at a time
PIECE = 65_536   # chunks of one document that share a window


def _first_match(line: Column, rules) -> Column:
    return reduce(lambda acc, r: acc.when(line.rlike(r[0]), F.lit(r[1])), rules[1:],
                  F.when(line.rlike(rules[0][0]), F.lit(rules[0][1])))


def _lines(text: Column) -> Column:
    """Stripped lines with their priorities."""
    return F.transform(F.transform(F.split(text, r"\n+"), lambda raw: strip(raw)), lambda line: F.struct(
        line.alias("t"), _first_match(line, HEADINGS).alias("p"), _first_match(line, UNDERLINES).alias("u")))


def _headings(text: Column) -> Column:
    """``array<struct<p int, t string>>``: the headings of a chunk in order."""
    def on_line(lines: Column) -> Column:
        def heading(line: Column, i: Column) -> Column:
            before = F.try_element_at(F.filter(F.slice(lines, 1, i), lambda z: z["u"].isNull()), F.lit(-1))["t"]
            return F.struct(
                F.coalesce(line["u"], line["p"]).alias("p"),
                F.when(line["u"].isNull(), line["t"]).otherwise(F.coalesce(before, F.lit(""))).alias("t"))
        return F.filter(F.transform(lines, heading), lambda h: h["p"].isNotNull())
    found = once(_lines(text), on_line)
    return F.when(text.rlike(CANDIDATE), found).otherwise(F.array().cast("array<struct<p:int,t:string>>"))


def _push(stack: Column, heading: Column) -> Column:
    """The stack after a heading: entries of the same or a deeper level go."""
    return F.concat(F.filter(stack, lambda s: s["p"] < heading["p"]), F.array(heading))


def _positions(headings: Column, root: Column) -> Column:
    """Position of each chunk of a document from the headings of its chunks."""
    stack_type = "array<struct<p:int,t:string>>"
    start = F.struct(
        F.array(F.struct(F.lit(-1).alias("p"), root.alias("t"))).cast(stack_type).alias("stack"),
        F.lit(None).cast("string").alias("last"), F.lit(0).alias("n"),
        F.array().cast("array<array<struct<path:string,n:int>>>").alias("out"))
    nothing = F.array().cast("array<struct<path:string,n:int>>")

    def step(state: Column, found: Column) -> Column:
        def with_path(path: Column) -> Column:
            n = F.when(path == state["last"], state["n"] + 1).otherwise(F.lit(1))
            return F.struct(
                F.aggregate(found, state["stack"], _push).cast(stack_type).alias("stack"),
                path.alias("last"), n.alias("n"),
                F.concat(state["out"], F.array(F.struct(path.alias("path"), n.alias("n")))).alias("out"))
        path = F.array_join(F.transform(state["stack"], lambda s: s["t"]), JOINT)
        return once(path, with_path)

    def labelled(out: Column) -> Column:
        return F.transform(out, lambda o, i: F.when(
            (o["n"] > 1) | (F.coalesce(F.get(out, i + 1)["n"], F.lit(0)) > 1),
            F.concat(o["path"], F.lit(" (part "), o["n"].cast("string"), F.lit(")"))).otherwise(o["path"]))

    def block(state: Column, at: Column) -> Column:
        part = F.aggregate(F.slice(headings, at + 1, RUN), state.withField("out", nothing), step)
        return once(part, lambda s: s.withField("out", F.concat(state["out"], F.array(s["out"]))))

    # Results are gathered run by run, so a document of very many chunks costs little more per chunk.
    runs = F.aggregate(F.sequence(F.lit(0), F.size(headings) - 1, F.lit(RUN)), start, block, lambda s: F.flatten(s["out"]))
    return F.when(F.size(headings) == 0, F.array().cast("array<string>")).otherwise(once(runs, labelled))


def chunk_documents(df: DataFrame, text: str = "text", name: str = "file_name", strategy: str = "large_context",
                    size: int = 5000, overlap: int = 200, minimum: int = 100) -> DataFrame:
    """One row per chunk: the other input columns, ``chunk_no, text, text_pure, img_url, position``.

    ``text`` has links restored, ``text_pure`` keeps the masks, ``position`` is
    the heading path before the chunk's first line.
    """
    bound_batches(df.sparkSession)
    others = [c for c in df.columns if c != text]
    cleaned = df.withColumn("_clean", collapse_markdown_runs(F.col(text)))
    masked = mask_links(cleaned, "_clean", "_masked", "_map").select(*others, "_masked", "_map")
    split = masked.withColumn("_pure", split_text("_masked", strategy, size, overlap, minimum))
    keyed = split.withColumn("_keys", plain_keys("_map"))
    restored = keyed.withColumn("_full", F.transform("_pure", lambda c: restore_links(c, "_map", F.col("_keys"))))
    found = restored.withColumn("_heads", F.transform("_full", _headings))
    placed = found.withColumn("_pos", _positions(F.col("_heads"), stem(F.col(name))))
    rows = F.arrays_zip(F.col("_full").alias("text"), F.col("_pure").alias("text_pure"), F.col("_pos").alias("position"))
    return (placed.select(*others, "_map", F.posexplode(rows).alias("chunk_no", "_c"))
            .select(*others, "chunk_no", F.col("_c.text").alias("text"), F.col("_c.text_pure").alias("text_pure"),
                    image_urls(F.col("_c.text_pure"), F.col("_map")).alias("img_url"),
                    F.col("_c.position").alias("position")))


def _pieces_of(doc: str, order: str, span: int) -> tuple[Column, Window, Window]:
    """Documents are cut into pieces of ``span`` order values: the piece, and windows in it.

    One document may hold most rows of a table; its pieces are worked on in
    parallel, and only one row per piece is looked at per document.
    """
    inside = Window.partitionBy(doc, "_piece").orderBy(order)
    return F.floor(F.col(order) / span), inside, Window.partitionBy(doc).orderBy("_piece")


def _only_cut(rows: DataFrame, doc: str) -> DataFrame:
    """Rows of documents that have several pieces; usually there are none."""
    several = rows.groupBy(doc).agg((F.min("_piece") != F.max("_piece")).alias("_cut")).where("_cut")
    return rows.join(several.select(doc), doc, "left_semi")


_STACK = "array<struct<p:int,t:string>>"
_DECIDED = [f"_p{p}" for p in LEVELS]


def _decided(rows: DataFrame, text: str) -> DataFrame:
    """+ per level what a chunk decides there: ``struct<t>`` (t null: nothing stays), or null if it decides nothing.

    This is the chunk's effect on the heading stack, what it pops and pushes.
    Effects combine level by level, the later one that is not null counts, so
    effects of runs of chunks can be made apart and put together afterwards.
    """
    rows = rows.withColumn("_own", F.aggregate(_headings(F.col(text)), F.array().cast(_STACK), _push))
    # What a chunk pops reaches up to its smallest priority, which its own stack keeps first.
    entry = lambda p: F.get(F.filter(F.col("_own"), lambda s: s["p"] == p), F.lit(0))["t"]
    top = F.get("_own", F.lit(0))["p"]
    return rows.withColumns({n: F.when(top <= p, F.struct(entry(p).alias("t"))) for n, p in zip(_DECIDED, LEVELS)}).drop("_own")


def _carried(rows: DataFrame, doc: str, order: str, across: Window) -> DataFrame:
    """Per piece the levels and the number of rows that the pieces before it leave."""
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy(doc, "_piece").agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col(order))).alias(n) for n in _DECIDED], F.count(F.lit(1)).alias("_n"))
    return ends.select(doc, "_piece", *[F.last(n, ignorenulls=True).over(earlier).alias(f"{n}_c") for n in _DECIDED],
                       F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_c"))


def _with_path(rows: DataFrame, doc: str, inside: Window, out: str) -> DataFrame:
    """+ the path, from the chunks before a row in its piece or else from what the piece was left."""
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    levels = [F.coalesce(F.last(n, ignorenulls=True).over(before), f"{n}_c")["t"] for n in _DECIDED]
    near = rows.withColumns({f"{n}_t": level for n, level in zip(_DECIDED, levels)})
    path = F.concat_ws(JOINT, stem(F.col(doc).cast("string")), *[f"{n}_t" for n in _DECIDED])
    return near.withColumn(out, path).drop(*[f"{n}{end}" for n in _DECIDED for end in ("", "_c", "_t")])


def heading_paths(chunks: DataFrame, doc: str = "file_name", order: str = "chunk_no", text: str = "text",
                  out: str = "path", span: int = PIECE) -> DataFrame:
    """Heading path before each row of a chunk table; ``order`` is a number.

    A chunk decides level p if it holds a heading of level p or above: then the
    level is what its own stack has there, possibly nothing. So each level is
    the latest decision among earlier chunks of the document, in the chunk's
    own piece or else in the pieces before it.
    """
    piece, inside, across = _pieces_of(doc, order, span)
    cut = chunks.withColumn("_piece", piece)
    carried = _carried(_decided(_only_cut(cut, doc), text), doc, order, across)
    joined = _decided(cut, text).join(carried, [doc, "_piece"], "left")
    return _with_path(joined, doc, inside, out).select(*[c for c in chunks.columns if c != out], out)


def _in_piece(rows: DataFrame, path: str, inside: Window) -> DataFrame:
    """+ place in the piece, the next path there, and the place where the run of equal paths began."""
    rows = rows.withColumns({"_rn": F.row_number().over(inside), "_next": F.lead(path).over(inside),
                             "_new": F.lag(path).over(inside) != F.col(path)})
    # Where the run of a row began, unless it is the first run of the piece.
    begun = F.last(F.when(F.col("_new"), F.col("_rn")), ignorenulls=True)
    return rows.withColumn("_start", begun.over(inside.rowsBetween(Window.unboundedPreceding, 0)))


def _edges(rows: DataFrame, doc: str, order: str, path: str, across: Window) -> DataFrame:
    """Per piece the path that follows it and the length of the run that goes on into it."""
    pieces = rows.groupBy(doc, "_piece").agg(
        F.count(F.lit(1)).alias("_n"), F.min_by(path, order).alias("_first"), F.max_by(path, order).alias("_last"),
        F.max("_start").alias("_tail"))
    pieces = pieces.withColumns({
        "_prev": F.lag("_last").over(across), "_follow": F.lead("_first").over(across),
        "_sum": F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, 0))})
    # The run at the end of a piece began in the latest piece that holds a change or starts one.
    fresh = F.when(F.col("_tail").isNotNull(), F.col("_n") - F.col("_tail") + 1).when(
        F.col("_prev").isNull() | (F.col("_prev") != F.col("_first")), F.col("_n"))
    anchor = F.last(F.when(fresh.isNotNull(), F.struct(fresh.alias("n"), F.col("_sum").alias("s"))), ignorenulls=True)
    pieces = pieces.withColumn("_anchor", anchor.over(across.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = pieces.withColumn("_run", F.col("_anchor.n") + F.col("_sum") - F.col("_anchor.s"))
    going = F.when(F.col("_prev") == F.col("_first"), F.lag("_run").over(across))
    return pieces.select(doc, "_piece", "_follow", going.alias("_before"))


def _label(path: str) -> Column:
    """The path, numbered where its run is longer than one row."""
    n = F.when(F.col("_start").isNull(), F.col("_rn") + F.coalesce("_before", F.lit(0))).otherwise(
        F.col("_rn") - F.col("_start") + 1)
    longer = (n > 1) | F.coalesce(F.coalesce("_next", "_follow") == F.col(path), F.lit(False))
    return F.when(longer, F.concat(F.col(path), F.lit(" (part "), n.cast("string"), F.lit(")"))).otherwise(F.col(path))


def part_suffix(chunks: DataFrame, doc: str = "file_name", order: str = "chunk_no", path: str = "path",
                out: str = "position", span: int = PIECE) -> DataFrame:
    """Number runs of equal consecutive paths: `` (part n)`` where a run is longer than 1."""
    piece, inside, across = _pieces_of(doc, order, span)
    cut = chunks.withColumn("_piece", piece)
    edges = _edges(_in_piece(_only_cut(cut, doc), path, inside), doc, order, path, across)
    joined = _in_piece(cut, path, inside).join(edges, [doc, "_piece"], "left")
    return joined.withColumn(out, _label(path)).select(*[c for c in chunks.columns if c != out], out)


def chunk_positions(chunks: DataFrame, doc: str = "file_name", order: str = "chunk_no", text: str = "text",
                    path: str = "path", out: str = "position", number: str = "number", span: int = PIECE) -> DataFrame:
    """Heading path, numbered position and place in the document (from 0) of each row of a chunk table.

    The result of ``part_suffix(heading_paths(chunks))`` in one pass: rows with
    their texts move once, by document and piece. Effects on the heading stack
    are made before that move, and what a piece inherits (open headings, rows
    so far, the run that goes on into it) is one row per piece, made from
    narrow rows of documents with several pieces; usually there are none.
    ``doc`` and ``order`` are not null and unique together; a null text has no
    headings; an empty table gives an empty table.
    """
    piece, inside, across = _pieces_of(doc, order, span)
    cut = _decided(chunks.withColumn("_piece", piece), text)
    hot = _only_cut(cut.select(doc, order, "_piece", *_DECIDED), doc)
    carried = _carried(hot, doc, order, across)
    paths = _with_path(hot.join(carried, [doc, "_piece"]), doc, inside, path)
    inherited = carried.join(_edges(_in_piece(paths, path, inside), doc, order, path, across), [doc, "_piece"])
    placed = _in_piece(_with_path(cut.join(inherited, [doc, "_piece"], "left"), doc, inside, path), path, inside)
    placed = placed.withColumns({out: _label(path), number: F.coalesce("_n_c", F.lit(0)) + F.col("_rn") - 1})
    made = (path, out, number)
    return placed.select(*[c for c in chunks.columns if c not in made], *made)
