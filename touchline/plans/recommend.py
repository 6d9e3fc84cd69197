"""From marts to nearest-player recommendations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from touchline import config
from touchline.functions.text import routed_model
from touchline.operators.neighbours import similar_all, similar_to
from touchline.operators.scaling import fit, transform, weighted_features

REPORT_FIRST = (
    "target_player_key",
    "target_player_name",
    "target_position",
    "target_minutes",
    "predicted_player_key",
    "predicted_player_name",
)
_CARRIED = ("club_name", "primary_position", "market_value_eur", "age")


def build_models(pools: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> dict[str, DataFrame]:
    """Fitted statistics per pool; weights apply to features they name only."""
    return {
        pool: fit(mart, features, config.POSITION_WEIGHTS) for pool, (mart, features) in pools.items()
    }


def scored_pool(
    mart: DataFrame, stats: DataFrame, features: Sequence[str], weight_at_score: bool = False
) -> DataFrame:
    """Mart with its feature vector. Weights shape the fit only, unless
    `weight_at_score` asks for them here too."""
    rows = weighted_features(mart, features, config.POSITION_WEIGHTS) if weight_at_score else mart
    return transform(rows, stats, features)


def lookup(
    mart: DataFrame, stats: DataFrame, features: Sequence[str], player: str, n: int = config.TOP_N
) -> DataFrame:
    """The players most similar to one."""
    found = similar_to(scored_pool(mart, stats, features), player, n)
    return found.select(
        "player_name", "club_name", "primary_position", "market_value_eur", "age", "player_key",
        "similarity_score",
    )


def recommend(
    pools: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]], n: int = config.TOP_N,
    block_rows: int | None = None,
) -> DataFrame:
    """Top `n` for every player of every pool, as the report's rows.

    `pools` maps "GK" and "OUT" to (mart, fitted statistics, features). A player
    is looked up, by name, in the pool its current position calls for; one that
    is not in that pool gets no rows.
    """
    extra = {"block_rows": block_rows} if block_rows else {}
    targets, found = [], []
    for pool, (mart, stats, features) in pools.items():
        targets.append(
            mart.select(
                F.col("player_key").alias("target_player_key"),
                F.col("player_name").alias("target_player_name"),
                F.col("primary_position").alias("target_position"),
                F.col("minutes_played").alias("target_minutes"),
            )
        )
        top = similar_all(scored_pool(mart, stats, features), n, **extra)
        # A key may stand for several names: matches are looked up by both, and of rows
        # alike in both one is reported.
        details = mart.groupBy(
            F.col("player_key").alias("match_key"), F.col("player_name").alias("predicted_player_name")
        ).agg(F.min(F.struct(*_CARRIED)).alias("_details"))
        named = top.withColumnRenamed("match_name", "predicted_player_name")
        details = details.select("match_key", "predicted_player_name", "_details.*")
        found.append(named.join(details, ["match_key", "predicted_player_name"]).withColumn("pool", F.lit(pool)))
    everyone = targets[0]
    for more in targets[1:]:
        everyone = everyone.unionByName(more)
    matches = found[0]
    for more in found[1:]:
        matches = matches.unionByName(more)
    keeper = routed_model(F.col("target_position")) == "GK"
    routed = everyone.withColumns(
        {"pool": F.when(keeper, "GK").otherwise("OUT"), "name_key": F.lower("target_player_name")}
    )
    return routed.join(matches, ["pool", "name_key"]).select(
        *REPORT_FIRST[:4],
        F.col("match_key").alias("predicted_player_key"),
        "predicted_player_name",
        *_CARRIED,
        "similarity_score",
        "rank",
    )
