"""Collections with frequent metadata keys as typed columns.

A condition on a map reads every row's whole map. Here the keys that many rows
have become columns of their own, and the conditions on them become comparisons
of a bare column with a value, which reach the Parquet scan and skip row groups.
Rare keys stay in the map. Each shredded key has three columns: its value, its
value in lower case, in which text is compared, and its number if it is one.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lorefield.functions.conditions import NUMBER_OPERATORS, condition_column, number_value
from lorefield.functions.strings import strip

SHARE = 0.2    # of the rows that must have a key
MOST = 24      # shredded keys


def frequent_keys(collection: DataFrame, share: float = SHARE, most: int = MOST) -> list[str]:
    """The keys that at least ``share`` of the rows have, most frequent first, at most ``most``."""
    rows = collection.count()
    found = (collection.select(F.explode(F.map_keys("metadata")).alias("key")).groupBy("key").count()
             .where(F.col("count") >= max(1, share * rows)).orderBy(F.desc("count"), "key").limit(most))
    return [r["key"] for r in found.collect()]


def shred(collection: DataFrame, keys: list[str] | None = None, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``collection`` with columns ``key<i>_value, key<i>_text, key<i>_number`` for frequent (or given) keys and a map of the others.

    A key's name is kept in the column's own metadata, which Parquet files and
    tables carry along. Null metadata stay null; a key with a null value counts
    as absent in conditions and is kept in the map, so nothing is lost.
    """
    keys = frequent_keys(collection, share, most) if keys is None else list(keys)
    meta, columns = F.col("metadata"), []
    for i, key in enumerate(keys):
        value = F.try_element_at(meta, F.lit(key))
        named = {"key": key}
        columns += [value.alias(f"key{i}_value", metadata=named), F.lower(value).alias(f"key{i}_text", metadata=named),
                    number_value(F.lower(value)).alias(f"key{i}_number", metadata=named)]
    rest = F.map_filter(meta, lambda k, v: v.isNull() | ~k.isin(keys)) if keys else meta
    return collection.select(*[c for c in collection.columns if c != "metadata"], rest.alias("metadata"), *columns)


def shredded_keys(df: DataFrame) -> dict[str, str]:
    """Key -> name stem of its columns."""
    return {f.metadata["key"]: f.name.removesuffix("_value") for f in df.schema.fields if f.name.endswith("_value") and "key" in f.metadata}


def unshred(df: DataFrame) -> DataFrame:
    """The plain collection again: shredded values go back into the map."""
    stems = shredded_keys(df)
    pairs = [F.struct(F.lit(key).alias("key"), F.col(f"{stem}_value").alias("value")) for key, stem in stems.items()]
    gone = {f"{stem}_{part}" for stem in stems.values() for part in ("value", "text", "number")}
    columns = [c for c in df.columns if c not in gone and c != "metadata"]
    if not pairs:
        return df.select(*columns, "metadata")
    own = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull()))
    return df.select(*columns, F.when(F.col("metadata").isNotNull(), F.map_concat("metadata", own)).alias("metadata"))


def _pushed(op: str, value: str, stem: str) -> Column | None:
    """A condition on one shredded key as comparisons of its bare columns; a null key meets ``empty`` and ``is not`` only."""
    text, number = F.col(f"{stem}_text"), F.col(f"{stem}_number")
    if op in NUMBER_OPERATORS:
        try:
            right = float(value)
        except ValueError:
            return F.lit(False)
        if right != right:
            return number.isNotNull() if op == "≠" else F.lit(False)
        # NaN sorts above all numbers, and meets only ≠.
        return {"=": number == right, "≠": number != right, "<": number < right, "≤": number <= right,
                ">": (number > right) & ~F.isnan(number), "≥": (number >= right) & ~F.isnan(number)}[op]
    return {"is": text == value, "is not": text.isNull() | (text != value), "contains": text.contains(value), "not contains": ~text.contains(value),
            "start with": text.startswith(value), "end with": text.endswith(value), "empty": text.isNull() | (strip(text) == ""),
            "not empty": strip(text) != ""}.get(op)


def shredded_condition(df: DataFrame, spec: Mapping) -> Column:
    """:func:`lorefield.functions.conditions.metadata_condition` over the columns of :func:`shred`.

    Conditions on one shredded key compare a bare column. Conditions that join
    several fields, or on a key that is not shredded, are evaluated as before.
    Rows for which the column is null or false are left out.
    """
    stems = shredded_keys(df)
    field = lambda name: F.col(f"{stems[name]}_value") if name in stems else F.try_element_at(F.col("metadata"), F.lit(name))
    logical = spec.get("logical_operator", "and")
    if logical not in ("and", "or"):
        raise ValueError(f"logical_operator must be 'and' or 'or', got {logical!r}")
    held = []
    for c in spec["conditions"]:
        names, bare = c["name"], None
        if len(names) == 1 and names[0] in stems:
            bare = _pushed(c["comparison_operator"], (c.get("value") or "").lower(), stems[names[0]])
        held.append(condition_column(c, field) if bare is None else bare)
    if logical == "and":
        return reduce(lambda a, b: a & b, held, F.lit(True))
    return reduce(lambda a, b: a | b, held, F.lit(False))


def shredded_filter(df: DataFrame, spec: Mapping) -> DataFrame:
    """Rows of a shredded collection that meet the filter."""
    return df.where(shredded_condition(df, spec))
