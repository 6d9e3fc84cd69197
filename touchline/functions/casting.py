"""Casts that give null, never an error, on text that does not fit."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def tolerant_int(c: Column, to: str = "int") -> Column:
    """Whole number from text; '12.0' gives 12 and '12.7' gives 13."""
    return F.round(c.try_cast("decimal(38,6)")).try_cast(to)


def tolerant_double(c: Column) -> Column:
    return c.try_cast("double")


def tolerant_date(c: Column, fmt: str) -> Column:
    return F.try_to_date(c, fmt)


def extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    """The captured text, or null where the pattern does not match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)
