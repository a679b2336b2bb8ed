"""Merging tables that came from different files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def unique_name(taken, base: str) -> str:
    """``base``, or ``base1, base2, ..`` if taken."""
    if base not in taken:
        return base
    n = 1
    while f"{base}{n}" in taken:
        n += 1
    return f"{base}{n}"


def merge_files(tables: Mapping[str, DataFrame], strategy: str = "all", source: str = "file_name") -> DataFrame:
    """Union by column name with the source name first.

    ``all`` keeps every column in order of appearance, ``all_sorted`` sorts them
    by name, ``common`` keeps those that every table has. Missing values are null.
    """
    if not tables:
        raise ValueError("nothing to merge")
    if strategy not in ("all", "all_sorted", "common"):
        raise ValueError("strategy must be 'all', 'all_sorted' or 'common'")
    seen = list(dict.fromkeys(c for df in tables.values() for c in df.columns))
    if strategy == "common":
        seen = [c for c in seen if all(c in df.columns for df in tables.values())]
    elif strategy == "all_sorted":
        seen = sorted(seen)
    column = unique_name(seen, source)
    named = [df.select(*[c for c in df.columns if c in seen]).withColumn(column, F.lit(name))
             for name, df in tables.items()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    return merged.select(column, *seen)


def with_source(df: DataFrame, source: str = "file_name") -> DataFrame:
    """The same for one reader over many files: the stem of each row's file comes first."""
    column = unique_name(df.columns, source)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return df.select(name.alias(column), *df.columns)
