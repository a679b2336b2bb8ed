"""Collection records: metadata, fallback text, titles, scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from lorefield.functions.strings import as_column, plain_text

# Columns that are never metadata.
SYSTEM_FIELDS = ("id", "document", "embedding", "dense_vector")
VECTOR_FIELDS = ("embedding", "dense_vector")


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _text(df: DataFrame, name: str) -> Column:
    """Stored form of a metadata value: null and NaN become ''."""
    col = _quoted(name)
    text = F.coalesce(plain_text(df, name), F.lit(""))
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(col), F.lit("")).otherwise(text)
    return text


def coerce_metadata(df: DataFrame, system: Sequence[str] = SYSTEM_FIELDS) -> Column:
    """Map of all columns outside ``system`` to their text."""
    names = [c for c in df.columns if c not in system]
    if not names:
        return F.create_map().cast("map<string,string>")
    pairs = [part for c in names for part in (F.lit(c), _text(df, c))]
    return F.create_map(*pairs)


def fallback_document(df: DataFrame) -> Column:
    """``k: v | k: v`` over the text columns, in column order."""
    names = [f.name for f in df.schema.fields
             if f.name not in ("id", *VECTOR_FIELDS) and isinstance(f.dataType, T.StringType)]
    parts = [F.concat(F.lit(f"{c}: "), _quoted(c)) for c in names]
    return F.concat_ws(" | ", *parts) if parts else F.lit("")


def record_content(document: Column | str, metadata: Column | str) -> Column:
    """The document, else the joined metadata values, else a fixed sentence."""
    kept = F.map_filter(as_column(metadata), lambda k, v: ~k.isin("title", "path", "id") & v.isNotNull())
    values = F.map_values(kept)
    joined = F.when(F.size(values) > 0, F.array_join(values, " "))
    return F.coalesce(F.nullif(as_column(document), F.lit("")), joined, F.lit("No content available"))


def record_title(metadata: Column | str, record_id: Column | str) -> Column:
    """``title``, else ``filename``, else the last part of ``path``, else a numbered name.

    Presence decides, not content: an empty ``title`` is still the title.
    """
    meta = as_column(metadata)
    path = F.regexp_extract(meta["path"], r"(?s)([^/]*)\z", 1)
    named = F.concat(F.lit("Document "), F.coalesce(as_column(record_id).cast("string"), F.lit("Unknown")))
    return F.coalesce(meta["title"], meta["filename"], path, named)


def resolve_score(cosine: Column | None = None, similarity: Column | None = None,
                  distance: Column | None = None) -> Column:
    """First score that is present, before clamping."""
    known = [c for c in (cosine, similarity) if c is not None]
    left = F.lit(1.0) if distance is None else F.coalesce(distance, F.lit(1.0))
    return F.coalesce(*known, F.lit(1.0) - left)


def clamp_score(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def strip_vectors(metadata: Column | str) -> Column:
    """Metadata without vector entries."""
    return F.map_filter(as_column(metadata), lambda k, v: ~k.isin(*VECTOR_FIELDS))


def strip_system_fields(df: DataFrame, update: bool = False) -> DataFrame:
    """Rows without vectors; for an update also without ``id`` and ``document``."""
    return df.drop(*(SYSTEM_FIELDS if update else VECTOR_FIELDS))


