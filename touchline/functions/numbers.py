"""Guarded rates and vector arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def guarded_rate(num: Column, den: Column, digits: int, scale: float = 1.0) -> Column:
    """`num / den`, rounded; 0 where the denominator is 0 or missing."""
    safe = F.when(den != 0, F.round(num / den * F.lit(scale), digits))
    return F.when(F.coalesce(den, F.lit(0)) == 0, F.lit(0.0)).otherwise(safe)


def clamp(c: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(c, F.lit(high)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def unit(v: Column) -> Column:
    """`v` scaled to length 1; an all-zero vector stays as it is."""
    squared = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)
    norm = F.when(squared > 0, F.sqrt(squared)).otherwise(F.lit(1.0))
    return F.transform(v, lambda x: x / norm)


def cosine(a: Column, b: Column) -> Column:
    return dot(unit(a), unit(b))


def add_all(columns: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, columns)
