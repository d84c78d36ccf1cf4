"""Functions on arrays of numbers, as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def inner_product(a: Column, b: Column) -> Column:
    """Sum of products in double; null if either is null, null too where the lengths differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda n, x: n + x)


def norm(a: Column) -> Column:
    return F.sqrt(inner_product(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is zero."""
    return F.try_divide(inner_product(a, b), norm(a) * norm(b))
