"""Text files and upload admission."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lorefield.functions.strings import content_checksum, strip_bom

# Text file suffixes, upload suffixes and the upload size limit.
TEXT_SUFFIXES = (".md", ".txt")
TABLE_SUFFIXES = (".xlsx", ".xls", ".csv", ".json")
UPLOAD_BYTES = 50 * 1024 * 1024


def _glob(suffixes: Sequence[str]) -> str:
    return "*{" + ",".join(suffixes) + "}"


def _corpus_columns(raw: DataFrame) -> DataFrame:
    text = strip_bom("value")
    return raw.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("path"),
                      text.alias("text"), content_checksum("value").alias("checksum"))


def read_corpus(spark: SparkSession, folder: str, suffixes: Sequence[str] = TEXT_SUFFIXES,
                recursive: bool = True) -> DataFrame:
    """``file_name, path, text, checksum``: one row per text file, BOM removed."""
    return _corpus_columns(spark.read.text(folder, wholetext=True, recursiveFileLookup=recursive,
                                           pathGlobFilter=_glob(suffixes)))


def stream_corpus(spark: SparkSession, folder: str, suffixes: Sequence[str] = TEXT_SUFFIXES,
                  files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream of files as they arrive."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _corpus_columns(reader.text(folder, wholetext=True, recursiveFileLookup=True,
                                       pathGlobFilter=_glob(suffixes)))


def admissible(name: Column, length: Column, suffixes: Sequence[str] = TABLE_SUFFIXES,
               max_bytes: int = UPLOAD_BYTES) -> Column:
    suffix = F.lower(F.regexp_extract(name, r"(\.[^./]*)$", 1))
    return suffix.isin(*suffixes) & (length <= max_bytes)


def admit_files(spark: SparkSession, folder: str, suffixes: Sequence[str] = TABLE_SUFFIXES,
                max_bytes: int = UPLOAD_BYTES) -> DataFrame:
    """``path, length`` of the files that may be taken in; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.where(admissible(F.col("path"), F.col("length"), suffixes, max_bytes)).select("path", "length")
