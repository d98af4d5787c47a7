"""Array/vector column helpers (all JVM-side higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(arr: Column) -> Column:
    """0-based index of the largest element; the first one wins on ties."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def dot(a: Column, b: Column) -> Column:
    """Inner product of two equal-length numeric arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equal-length numeric arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def scale(arr: Column, factor: Column) -> Column:
    return F.transform(arr, lambda x: x * factor)


def abs_array(arr: Column) -> Column:
    """P9 for array rows."""
    return F.transform(arr, lambda x: F.abs(x))
