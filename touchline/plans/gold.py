"""The star schema: dimensions, bridge and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline import config
from touchline.functions.text import (
    is_goalkeeper,
    parse_season,
    position_details,
    primary_position,
    secondary_position,
    surrogate_key,
)
from touchline.operators.joins import attach, attach_coalesced, attach_season_by_digits
from touchline.operators.matching import accept, best_match, names_with_blocks
from touchline.operators.rows import latest_per_key


def _newest(*ties: str):
    """Newest season first, a missing one before all; the rest only settles ties."""
    return [F.col("season").desc_nulls_first(), *[F.col(t).asc_nulls_first() for t in ties]]


def name_match(players: DataFrame, market: DataFrame) -> DataFrame:
    """Best market name of every player of the bronze feeds."""
    return best_match(
        names_with_blocks(players, "player_name", "current_club"),
        names_with_blocks(market, "player_name", "club"),
    )


def dim_player_bridge(matches: DataFrame) -> DataFrame:
    return accept(matches)


def dim_club(stg: DataFrame) -> DataFrame:
    latest = latest_per_key(stg, ["club"], _newest("competition", "player_name"))
    return latest.select(
        surrogate_key(F.col("club")).alias("club_key"),
        F.col("club").alias("club_name"),
        "club_country",
        "competition",
    )


def dim_season(stg: DataFrame) -> DataFrame:
    seasons = stg.select("season").distinct()
    parsed = seasons.select("season", parse_season(F.col("season")).alias("p"))
    return parsed.select(
        "p.season_key", "season", "p.season_start_year", "p.season_end_year", "p.is_single_year"
    )


def dim_player(stg: DataFrame, bridge: DataFrame) -> DataFrame:
    latest = latest_per_key(stg, ["player_name"], _newest("club", "competition"))
    joined = attach(
        latest, bridge, {"player_name": "canonical_player_name"},
        {"canonical_player_key": "canonical_player_key"},
    )
    position = F.col("player_position")
    return joined.select(
        F.coalesce("canonical_player_key", surrogate_key(F.col("player_name"))).alias("player_key"),
        "player_name",
        "preferred_foot",
        "national_team",
        "height_cm",
        "weight_kg",
        primary_position(position).alias("primary_position"),
        secondary_position(position).alias("secondary_position"),
        position_details(position).alias("position_details"),
    )


def _with_player(rows: DataFrame, players: DataFrame) -> DataFrame:
    """First of a fact's joins: both sides lie in buckets by this name."""
    return attach(rows, players, {"player_name": "player_name"}, {"player_key": "player_key"})


def _with_club(rows: DataFrame, clubs: DataFrame) -> DataFrame:
    return attach(rows, clubs, {"club": "club_name"}, {"club_key": "club_key"})


_KEYS = ("player_key", "club_key", "season_key", "player_name", "season", "club", "competition")


def fact_outfield_stats(
    stg: DataFrame, players: DataFrame, clubs: DataFrame, seasons: DataFrame
) -> DataFrame:
    rows = _with_player(stg.where(~is_goalkeeper(F.col("player_position"))), players)
    rows = attach_season_by_digits(rows, seasons, "season", {"season_key": "season_key"})
    return _with_club(rows, clubs).select(*_KEYS, *config.OUTFIELD_FACT)


def fact_goalkeeper_stats(
    stg: DataFrame, players: DataFrame, clubs: DataFrame, seasons: DataFrame
) -> DataFrame:
    rows = _with_player(stg.where(is_goalkeeper(F.col("player_position"))), players)
    rows = attach(rows, seasons, {"season": "season"}, {"season_key": "season_key"})
    return _with_club(rows, clubs).select(*_KEYS, *config.GOALKEEPER_FACT)


def fact_player_season_stats(stg: DataFrame, seasons: DataFrame) -> DataFrame:
    """Earlier single fact over both pools, keys computed in place."""
    rows = attach(stg, seasons, {"season": "season"}, {"season_key": "season_key"})
    return rows.select(
        surrogate_key(F.col("player_name")).alias("player_key"),
        surrogate_key(F.col("club")).alias("club_key"),
        "season_key",
        "player_name",
        "club",
        "competition",
        *config.SEASON_FACT,
    )


def fact_market_value_history(
    values: DataFrame, bridge: DataFrame, players: DataFrame, seasons: DataFrame
) -> DataFrame:
    """Valuations under the player they were matched to, or their own name."""
    rows = attach(
        values, bridge, {"player_name": "player_from_market"},
        {"canonical_player_name": "_bridged", "name_sim": "name_sim", "team_sim": "team_sim"},
    )
    rows = attach_coalesced(
        rows, players, F.col("_bridged"), F.col("player_name"), "player_name",
        {"player_key": "player_key"}, "canonical_player_name",
    )
    rows = attach(rows, seasons, {"season": "season"}, {"season_key": "season_key"})
    return rows.select(
        "player_key",
        "season_key",
        F.col("player_name").alias("market_player_name"),
        "canonical_player_name",
        "club",
        "valuation_date",
        "age",
        "market_value_eur",
        "name_sim",
        "team_sim",
    )
