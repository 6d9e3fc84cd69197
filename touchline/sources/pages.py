"""Structured data embedded in page HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline import config
from touchline.functions.casting import extract_or_null


def extract_embedded_json(
    pages: DataFrame,
    html: str = "html",
    pattern: str = config.MATCH_SCRIPT,
    schema: str = config.MATCH_DDL,
    to: str = "doc",
) -> DataFrame:
    """Parse the first text `pattern` captures as JSON; null without a match or on
    text that is no JSON. Pages are kept either way."""
    return pages.withColumn(to, F.from_json(extract_or_null(F.col(html), pattern), schema))
