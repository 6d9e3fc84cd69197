"""Similarity marts: one row per player, newest seasons weighing most."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from touchline import config
from touchline.operators.joins import attach
from touchline.operators.recency import recency_decay, recency_weighted
from touchline.operators.rows import latest_per_key


def latest_value(history: DataFrame) -> DataFrame:
    """Newest valuation per player; one without a date ranks before all."""
    ties = [F.col(c).asc_nulls_first() for c in ("market_value_eur", "age", "market_player_name")]
    keyed = history.where(F.col("player_key").isNotNull())
    newest = latest_per_key(keyed, ["player_key"], [F.col("valuation_date").desc_nulls_first(), *ties])
    return newest.select("player_key", "age", "market_value_eur")


def similarity_mart(
    fact: DataFrame, clubs: DataFrame, players: DataFrame, history: DataFrame,
    metrics: Sequence[str], player_columns: Sequence[str],
) -> DataFrame:
    """Weighted metrics of the newest three rows per player, with the player's
    attributes and latest value. Rows without a player would only form a group
    that the inner join drops, so they are left out before the shuffle."""
    known = fact.where(F.col("player_key").isNotNull())
    rows = attach(known, clubs, {"club_key": "club_key"}, {"club_name": "club_name"})
    order = [
        F.col("season_key").desc_nulls_first(),
        *[F.col(c).asc_nulls_first() for c in ("season", "club", "competition", "player_name", "club_name")],
    ]
    weighted = recency_weighted(rows, "player_key", order, list(metrics), label="club_name")
    named = weighted.join(players.select("player_key", "player_name", *player_columns), "player_key")
    valued = attach(
        named, latest_value(history), {"player_key": "player_key"},
        {"age": "age", "market_value_eur": "market_value_eur"},
    )
    return valued.select(
        "player_key", "player_name", "club_name", *player_columns, "age", "market_value_eur", *metrics
    )


def mart_similarity_outfield(fact, clubs, players, history) -> DataFrame:
    return similarity_mart(
        fact, clubs, players, history, config.OUTFIELD_MART,
        ("primary_position", "secondary_position", "position_details"),
    )


def mart_similarity_goalkeeper(fact, clubs, players, history) -> DataFrame:
    return similarity_mart(
        fact, clubs, players, history, config.GOALKEEPER_MART, ("primary_position",)
    )


def mart_forwards(fact, players, seasons, history) -> DataFrame:
    """Earlier forwards mart: every season counts, fading by 0.7 a year."""
    forwards = players.where(F.col("primary_position") == "FW").select("player_key").distinct()
    rows = fact.join(forwards, "player_key")
    starts = seasons.groupBy("season").agg(F.max("season_start_year").alias("season_start_year"))
    rows = attach(rows, starts, {"season": "season"}, {"season_start_year": "season_start_year"})
    faded = recency_decay(rows, "player_key", "season_start_year", list(config.FORWARD_MART))
    top = history.groupBy("player_key").agg(F.max("market_value_eur").alias("market_value_eur"))
    return attach(faded, top, {"player_key": "player_key"}, {"market_value_eur": "market_value_eur"})
