"""Joins of facts to dimensions and lookups.

No side is forced to be broadcast: dimensions grow with the data, so the choice
is left to Spark, which checks sizes (statistics at planning time, real sizes
under adaptive execution) and otherwise splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.text import season_digits


def attach(
    fact: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str], how: str = "left"
) -> DataFrame:
    """Equi-join on `{fact column: dim column}`, adding `{dim column: new name}`.

    Dim columns travel under private names, so the two sides may share names. A
    hot or missing key piles up on the fact side only; adaptive execution splits
    that partition against the one matching dim row.
    """
    right = dim.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(on.values())],
        *[F.col(c).alias(f"_v_{new}") for c, new in take.items()],
    )
    condition = [F.col(name) == F.col(f"_k{i}") for i, name in enumerate(on)]
    joined = fact.join(right, condition, how)
    return joined.select(
        *fact.columns, *[F.col(f"_v_{new}").alias(new) for new in take.values()]
    )


def attach_season_by_digits(
    fact: DataFrame, seasons: DataFrame, season: str, take: dict[str, str]
) -> DataFrame:
    """Left join of a season text to the season table by its digits as a number."""
    keyed = fact.withColumn("_digits", season_digits(F.col(season)))
    numbered = seasons.withColumn("_number", F.col("season_key").try_cast("bigint"))
    return attach(keyed, numbered, {"_digits": "_number"}, take).drop("_digits")


def attach_coalesced(
    fact: DataFrame, dim: DataFrame, first: Column, second: Column, dim_key: str,
    take: dict[str, str], key_name: str,
) -> DataFrame:
    """Left join on the first name present; the resolved name is kept as a column."""
    keyed = fact.withColumn(key_name, F.coalesce(first, second))
    return attach(keyed, dim, {key_name: dim_key}, take)


def with_lookup(
    df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, lookup_name: str, name: str,
    missing: str = "Unknown",
) -> DataFrame:
    """Add a looked-up name; a miss reads `missing`.

    A plain left join, so it also serves as a stream-static join. `lookup` is
    expected to hold one row per key.
    """
    side = lookup.select(F.col(lookup_key).alias("_lk"), F.col(lookup_name).alias("_ln"))
    joined = df.join(side, F.col(key) == F.col("_lk"), "left")
    return joined.withColumn(name, F.coalesce(F.col("_ln"), F.lit(missing))).drop("_lk", "_ln")


def unsent(df: DataFrame, sent: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been sent yet."""
    return df.join(sent.select(key), key, "left_anti")
