"""Collections stored as catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lorefield.functions.records import VECTOR_FIELDS
from lorefield.operators.collections import export_rows, flatten, scan, to_collection
from lorefield.sources.tables import write_table


def list_collections(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables() if not t.isTemporary]


def has_collection(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_collection(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def create_collection(df: DataFrame, name: str, path: str | None = None) -> None:
    """Store rows as a new collection, replacing one of the same name."""
    drop_collection(df.sparkSession, name)
    append_collection(df, name, path)


def append_collection(df: DataFrame, name: str, path: str | None = None) -> None:
    """Append rows, creating the collection on first use.

    Flat rows are brought into the canonical form first.
    """
    rows = df if set(df.columns) == {"id", "document", "embedding", "metadata"} else to_collection(df)
    writer = rows.select("id", "document", "embedding", "metadata").write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def open_collection(spark: SparkSession, name: str) -> DataFrame:
    if not has_collection(spark, name):
        raise ValueError(f"no collection {name!r}")
    return spark.table(name)


def scan_collection(spark: SparkSession, name: str, limit: int | None = None, ordered: bool = True) -> DataFrame:
    return scan(open_collection(spark, name), limit, ordered)


def export_collection(collection: DataFrame, fields: list[str], path: str, fmt: str = "csv") -> None:
    """All rows as text: the document and the given metadata fields."""
    flat = flatten(collection.drop(*VECTOR_FIELDS), fields)
    write_table(export_rows(flat), path, fmt, mode="overwrite")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))
