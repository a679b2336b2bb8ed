"""Registry and shared views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorefield.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query ``(spark, sf_dir) -> DataFrame`` and its SQL."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents on every core, for work on their texts."""
    return spread(documents(spark, sf_dir))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")


def doc_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a collection, with the source as title for even and path for odd ids."""
    d = documents(spark, sf_dir)
    return d.select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("document"),
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"),
                     F.lit("n_chars"), F.col("n_chars").cast("string")).alias("metadata"))


# The Markdown view of a document: headings, links and repeated images around its text.
MD_SQL = ("'# '||source||chr(10)||chr(10)||'## '||lang||chr(10)||chr(10)||text||chr(10)||chr(10)||"
          "'See ['||source||'](http://a.example/'||doc_id||') and ![pic](http://a.example/'||lang||'.png) again "
          "![pic](http://a.example/'||lang||'.png) then ![pic](http://b.example/x.png) ['||source||'](http://b.example)'||chr(10)")


def markdown(df: DataFrame) -> DataFrame:
    """+ ``file_name, md``."""
    parts = ["# ", F.col("source"), "\n\n## ", F.col("lang"), "\n\n", F.col("text"), "\n\nSee [", F.col("source"),
             "](http://a.example/", F.col("doc_id").cast("string"), ") and ![pic](http://a.example/", F.col("lang"),
             ".png) again ![pic](http://a.example/", F.col("lang"), ".png) then ![pic](http://b.example/x.png) [",
             F.col("source"), "](http://b.example)\n"]
    md = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return df.withColumn("file_name", F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".md"))).withColumn("md", md)
