"""Arithmetic on array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-12


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v))


def _spread(value: Column, like: Column) -> Column:
    # as an argument of zip_with the value is computed once; inside a lambda, once per element
    return F.array_repeat(value, F.size(like))


def scale(a: Column, factor: Column) -> Column:
    return F.zip_with(a, _spread(factor, a), lambda v, f: v * f)


def l2_normalise(a: Column) -> Column:
    return F.zip_with(a, _spread(norm(a) + F.lit(EPS), a), lambda v, n: v / n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + F.lit(EPS))


def is_zero(a: Column) -> Column:
    return ~F.exists(a, lambda v: v != 0.0)


def near_zero(a: Column, tol: float = 1e-8) -> Column:
    return ~F.exists(a, lambda v: F.abs(v) > tol)


def argmax(a: Column) -> Column:
    """0-based index of the largest value; the first one wins ties."""
    return F.array_position(a, F.array_max(a)).cast("int") - 1


def round_all(a: Column, digits: int = 6) -> Column:
    return F.transform(a, lambda v: F.round(v, digits))


def sif_weight(count: Column, total: Column, a: float = 1e-3) -> Column:
    """Smooth inverse frequency ``a / (a + count / total)``."""
    return F.lit(a) / (F.lit(a) + count / F.greatest(total, F.lit(1)))
