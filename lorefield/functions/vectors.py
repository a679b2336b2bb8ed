"""Vector arithmetic on ``array<float>`` columns, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lorefield.functions.strings import as_column


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product in double precision; vectors of different size fail."""
    a, b = as_column(a), as_column(b)
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    total = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    message = F.concat(F.lit("vector sizes differ: "), F.size(a).cast("string"), F.lit(" and "), F.size(b).cast("string"))
    return F.when(F.size(a) != F.size(b), F.raise_error(message).cast("double")).otherwise(total)


def norm(a: Column | str) -> Column:
    squares = F.transform(as_column(a), lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def cosine(a: Column | str, b: Column | str, floor0: bool = True) -> Column:
    """Cosine similarity; a zero vector gives 0.

    ``floor0`` limits the result to [0, 1] (matrix use, NaN becomes 1);
    otherwise it is limited to [-1, 1] (search use, NaN stays).
    """
    lengths = norm(a) * norm(b)
    raw = F.when(lengths == 0.0, F.lit(0.0)).otherwise(dot(a, b) / F.when(lengths != 0.0, lengths))
    if floor0:
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))
    return F.when(F.isnan(raw), raw).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw)))


def l2_normalize(a: Column | str) -> Column:
    """The vector scaled to length 1; a zero vector stays zero."""
    vector = as_column(a)
    length = norm(vector)
    return F.when(length == 0.0, vector.cast("array<double>")).otherwise(
        F.transform(vector, lambda x: x.cast("double") / length)
    )
