"""Uploaded tables: CSV with unknown encoding, JSON, parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lorefield.sources.json_arrays import read_json_arrays

# Encodings tried in this order after UTF-8 (with or without BOM).
FALLBACK_ENCODINGS = ("gbk", "gb2312")

#: Bytes of a JSON file above which several tasks read it.
RANGES_FROM = 64 << 20

# Columns of a chunk table, in file order.
CHUNK_COLUMNS = {"text": "Text", "text_pure": "Text_pure", "img_url": "Img_url", "position": "Position"}


def detect_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 if every line is valid UTF-8, else the first fallback that reads every line."""
    return probe_table(spark, path)[0]


def probe_table(spark: SparkSession, path: str) -> tuple[str, bool]:
    """Encoding of a delimited file, and whether a quoted field may go over a line's end.

    One pass for both: a line with an odd number of quotes begins or ends such a
    field. Only files that are no UTF-8 are read again, once per fallback.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    odd, bad = spark.read.text(path).agg(F.bool_or(quotes % 2 == 1), F.bool_or(~F.is_valid_utf8("value"))).first()
    if not bad:
        return "utf-8", bool(odd)
    # Charsets beyond Spark's own list need this switch. It stays on when such a file is
    # found, as tables are read lazily, and is put back otherwise.
    setting = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    for name in FALLBACK_ENCODINGS:
        lines = spark.read.csv(path, encoding=name, sep="\0", quote="", schema="value string")
        if lines.where(F.col("value").contains("�")).isEmpty():
            return name, bool(odd)
    spark.conf.set(setting, before)
    raise ValueError(f"cannot decode {path}; tried utf-8, {', '.join(FALLBACK_ENCODINGS)}")


def read_table(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None,
               encoding: str | None = None, multiline: bool | None = None, json_lines: bool = False,
               ranges_from: int = RANGES_FROM) -> DataFrame:
    """A CSV, JSON or parquet table; the format defaults to the suffix of the path.

    Encoding and ``multiline`` are found out in one pass where they are not
    given: files without line breaks in quoted fields stay splittable, so one
    large file is read by many tasks. Give a schema to skip the inference pass.
    A JSON file is read whole by one task up to ``ranges_from`` bytes and in
    ranges beyond, with the same rows; files of JSON lines are cut anyway.
    """
    fmt = (fmt or path.rstrip("/").rsplit(".", 1)[-1]).lower()
    if fmt in ("csv", "tsv"):
        if encoding is None or multiline is None:
            found = probe_table(spark, path)
            encoding, multiline = encoding or found[0], found[1] if multiline is None else multiline
        reader = spark.read.options(
            header=True, sep="\t" if fmt == "tsv" else ",", quote='"', escape='"', multiLine=multiline,
            encoding=encoding, inferSchema=schema is None)
        return (reader.schema(schema) if schema is not None else reader).csv(path)
    if fmt == "json":
        if not json_lines and _largest_file(spark, path) > ranges_from:
            return read_json_arrays(spark, path, schema)
        reader = spark.read.option("multiLine", not json_lines)
        return (reader.schema(schema) if schema is not None else reader).json(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported table format {fmt!r}")


def _largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Parquet, CSV, TSV or JSON lines; delimited files have a header and quote what needs it."""
    writer = df.write.mode(mode)
    if fmt in ("csv", "tsv"):
        writer.options(header=True, sep="\t" if fmt == "tsv" else ",", quote='"', escape='"',
                       quoteAll=True, emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False,
                       ignoreTrailingWhiteSpace=False).csv(path)
    elif fmt in ("parquet", "json"):
        writer.format(fmt).save(path)
    else:
        raise ValueError(f"unsupported table format {fmt!r}")


def write_chunks(chunks: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """A chunk dataset with its file columns ``Text, Text_pure, Img_url, Position`` first."""
    named = [F.col(c).alias(n) for c, n in CHUNK_COLUMNS.items()]
    others = [c for c in chunks.columns if c not in CHUNK_COLUMNS]
    write_table(chunks.select(*named, *others), path, fmt, mode)
