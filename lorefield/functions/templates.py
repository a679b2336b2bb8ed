"""Templates compiled into one ``concat`` expression per row."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from lorefield.functions.strings import plain_text, strip

# Texts that count as missing.
MISSING_WORDS = ("nan", "NaN", "None")

_FIELD = re.compile(r"\{([^}]+)\}")


def template_fields(template: str) -> list[str]:
    return _FIELD.findall(template)


def check_template(template: str, columns: Sequence[str]) -> None:
    """Raise before any job when a template names an absent column."""
    missing = [f for f in template_fields(template) if f not in columns]
    if missing:
        raise ValueError(f"template fields not in the data: {missing}; available: {list(columns)}")


def clean_value(df: DataFrame, name: str, infinity: str = "blank") -> Column:
    """One column as text: null, NaN and the missing words become ``''``.

    ``infinity='blank'`` maps infinities to ``''``, ``'symbol'`` to ``∞``/``-∞``.
    """
    if infinity not in ("blank", "symbol"):
        raise ValueError(f"infinity must be 'blank' or 'symbol', got {infinity!r}")
    col = F.col(f"`{name}`")
    text = plain_text(df, name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        plus, minus = ("∞", "-∞") if infinity == "symbol" else ("", "")
        text = (
            F.when(F.isnan(col), F.lit(""))
            .when(col == float("inf"), F.lit(plus))
            .when(col == float("-inf"), F.lit(minus))
            .otherwise(text)
        )
    return F.when(text.isNull() | text.isin(*MISSING_WORDS), F.lit("")).otherwise(text)


def clean_values(df: DataFrame, infinity: str = "blank") -> DataFrame:
    """Every column as display text."""
    return df.select(*[clean_value(df, c, infinity).alias(c) for c in df.columns])


def render_template(df: DataFrame, template: str, infinity: str = "blank") -> Column:
    """Text of a ``{Field}`` template for each row.

    All placeholders are filled at once: a value that itself contains
    ``{Other}`` is not expanded again. Unknown fields become empty.
    """
    parts: list[Column] = []
    for i, piece in enumerate(_FIELD.split(template)):
        if i % 2 == 0:
            if piece:
                parts.append(F.lit(piece))
        elif piece in df.columns:
            parts.append(clean_value(df, piece, infinity))
    return strip(F.concat(*parts)) if parts else F.lit("")


def render_prompt(df: DataFrame, prompt: str, variables: Mapping[str, Column] | None = None) -> Column:
    """Text of a ``{{name}}`` prompt; unknown placeholders stay as they are.

    ``input``, ``generated_output`` (column ``model_output``), ``reference_output``
    and ``group`` are always known; every other column is known by its name.
    """
    aliases = {"input": "input", "generated_output": "model_output",
               "reference_output": "reference_output", "group": "group"}
    known = {c: F.coalesce(plain_text(df, c), F.lit("")) for c in df.columns}
    for name, source in aliases.items():
        known[name] = known[source] if source in df.columns else F.lit("")
    known.update(variables or {})
    names = sorted(known, key=len, reverse=True)
    pattern = re.compile(r"\{\{(" + "|".join(map(re.escape, names)) + r")\}\}")
    parts = [F.lit(p) if i % 2 == 0 else known[p] for i, p in enumerate(pattern.split(prompt)) if i % 2 or p]
    return F.concat(*parts) if parts else F.lit("")
