"""Column functions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null where either vector is zero."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def unit(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double") / norm(a))


def mean(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(a), F.lit(0))
