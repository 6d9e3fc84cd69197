"""League tables out of match results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def standings(
    matches: DataFrame,
    home: str = "home_team",
    away: str = "away_team",
    home_goals: str = "home_goals",
    away_goals: str = "away_goals",
    by: tuple[str, ...] = ("season",),
) -> DataFrame:
    """One row per team and competition with its record, points and position.

    Each match yields two rows inside the map stage, where they are added up
    before the shuffle. Positions are ranked within one competition (`by`), over
    one row per team.
    """

    def side(team, scored, conceded):
        return F.struct(
            F.col(team).alias("team"),
            F.col(scored).cast("bigint").alias("gf"),
            F.col(conceded).cast("bigint").alias("ga"),
        )

    both = F.array(side(home, home_goals, away_goals), side(away, away_goals, home_goals))
    rows = matches.select(*by, F.inline(both))
    won, drawn = F.col("gf") > F.col("ga"), F.col("gf") == F.col("ga")

    def tally(condition):
        return F.sum(F.when(condition, 1).otherwise(0).cast("bigint"))

    table = rows.groupBy(*by, "team").agg(
        F.count(F.lit(1)).alias("P"),
        tally(won).alias("W"),
        tally(drawn).alias("D"),
        tally(F.col("gf") < F.col("ga")).alias("L"),
        F.sum("gf").alias("GF"),
        F.sum("ga").alias("GA"),
    )
    table = table.withColumn("GD", F.col("GF") - F.col("GA")).withColumn(
        "Pts", 3 * F.col("W") + F.col("D")
    )
    ordered = Window.partitionBy(*by).orderBy(*table_order())
    return table.select(F.row_number().over(ordered).alias("Pos"), "*")


def table_order():
    """Points, goal difference, goals scored; team name settles what is left."""
    return [F.col("Pts").desc(), F.col("GD").desc(), F.col("GF").desc(), F.col("team").asc()]
