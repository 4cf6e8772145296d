"""Similarities of vectors and token sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 for empty, unequally long or zero vectors."""
    x, y = a.cast("array<double>"), b.cast("array<double>")
    size = norm(x) * norm(y)
    return F.when((F.size(x) > 0) & (F.size(x) == F.size(y)) & (size > 0), dot(x, y) / size).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """0 for two empty sets."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))
