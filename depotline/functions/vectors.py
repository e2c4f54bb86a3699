"""Dense-vector expressions over ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(as_doubles(vector), F.lit(0.0), lambda acc, x: acc + x * x))


def unit_vector(vector: Column) -> Column:
    """Vector divided by its length; a zero vector stays as it is."""
    norm = l2_norm(vector)
    return F.when(norm > 0, F.transform(as_doubles(vector), lambda x: x / norm)).otherwise(as_doubles(vector))
