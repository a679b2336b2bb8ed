"""Metadata conditions compiled into one boolean column."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lorefield.functions.strings import as_column, strip

# The comparison operators.
TEXT_OPERATORS = ("contains", "not contains", "start with", "end with", "is", "is not", "empty", "not empty")
NUMBER_OPERATORS = ("=", "≠", ">", "<", "≥", "≤")
DATE_OPERATORS = ("before", "after")

# What Python's float() accepts, lower-cased and stripped.
_FLOAT = (r"^[+-]?(?:(?:\d++(?:_\d++)*+\.?(?:\d++(?:_\d++)*+)?|\.\d++(?:_\d++)*+)"
          r"(?:e[+-]?\d++(?:_\d++)*+)?|inf|infinity|nan)$")


def number_value(text: Column) -> Column:
    """The number that lower-case text stands for, else null."""
    bare = strip(text)
    return F.when(bare.rlike(_FLOAT), F.replace(bare, F.lit("_"), F.lit("")).try_cast("double"))


def _compare_numbers(op: str, left: Column, right: float | None) -> Column:
    if right is None:
        return F.lit(False)
    if right != right:
        return left.isNotNull() if op == "≠" else F.lit(False)
    value = F.lit(right)
    plain = {
        "=": left == value, "≠": left != value, ">": left > value,
        "<": left < value, "≥": left >= value, "≤": left <= value,
    }[op]
    return F.coalesce(F.when(F.isnan(left), F.lit(op == "≠")).otherwise(plain), F.lit(False))


def condition_column(condition: Mapping, field: Callable[[str], Column]) -> Column:
    """One condition ``{name: [..], comparison_operator, value}``.

    Values of the named fields that exist are joined by blanks and compared
    in lower case. With no such field only ``empty`` and ``is not`` hold.
    """
    op = condition["comparison_operator"]
    if op not in TEXT_OPERATORS + NUMBER_OPERATORS + DATE_OPERATORS:
        raise ValueError(f"unknown comparison operator {op!r}")
    value = (condition.get("value") or "").lower()
    values = [field(n).cast("string") for n in condition["name"]]
    present = reduce(lambda a, b: a | b, [v.isNotNull() for v in values], F.lit(False))
    text = F.lower(F.concat_ws(" ", *values)) if values else F.lit("")
    if op in DATE_OPERATORS:
        held = F.lit(False)
    elif op in NUMBER_OPERATORS:
        try:
            right = float(value)
        except ValueError:
            right = None
        held = _compare_numbers(op, number_value(text), right)
    else:
        held = {
            "contains": text.contains(value),
            "not contains": ~text.contains(value),
            "start with": text.startswith(value),
            "end with": text.endswith(value),
            "is": text == value,
            "is not": text != value,
            "empty": strip(text) == "",
            "not empty": strip(text) != "",
        }[op]
    return F.when(present, held).otherwise(F.lit(op in ("empty", "is not")))


def metadata_condition(spec: Mapping, metadata: Column | str | None = None,
                       df: DataFrame | None = None) -> Column:
    """The column of a filter ``{logical_operator, conditions}``.

    Fields are looked up in the ``metadata`` map, or among the columns of
    ``df`` when metadata is stored flat. Without conditions ``and`` keeps all
    rows and ``or`` keeps none.
    """
    if metadata is not None:
        meta = as_column(metadata)
        field = lambda name: meta[name]
    else:
        columns = set(df.columns)
        field = lambda name: F.col(f"`{name}`") if name in columns else F.lit(None).cast("string")
    logical = spec.get("logical_operator", "and")
    if logical not in ("and", "or"):
        raise ValueError(f"logical_operator must be 'and' or 'or', got {logical!r}")
    held = [condition_column(c, field) for c in spec["conditions"]]
    if logical == "and":
        return reduce(lambda a, b: a & b, held, F.lit(True))
    return reduce(lambda a, b: a | b, held, F.lit(False))


def metadata_filter(df: DataFrame, spec: Mapping, metadata: Column | str | None = "metadata") -> DataFrame:
    """Rows that meet the filter."""
    return df.where(metadata_condition(spec, metadata, df))
