"""Stage order: bronze, silver, gold, marts, recommendations."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from touchline import config
from touchline.plans import gold, marts, recommend, silver
from touchline.session import compiled_wide, scratch_dir
from touchline.sources.tables import refresh, refresh_bucketed

# Each table by the function that plans it from the tables before it.
PLANS = {
    "bronze_players": lambda t: t.bronze["players"],
    "bronze_market": lambda t: t.bronze["market"],
    "repeated_players": lambda t: silver.repeated_players(t["bronze_players"]),
    "stg_players": lambda t: silver.stg_players(t["bronze_players"], t["repeated_players"]),
    "stg_market_values": lambda t: silver.stg_market_values(t["bronze_market"]),
    "int_player_name_match": lambda t: gold.name_match(t["bronze_players"], t["bronze_market"]),
    "dim_player_bridge": lambda t: gold.dim_player_bridge(t["int_player_name_match"]),
    "dim_season": lambda t: gold.dim_season(t["stg_players"]),
    "dim_club": lambda t: gold.dim_club(t["stg_players"]),
    "dim_player": lambda t: gold.dim_player(t["stg_players"], t["dim_player_bridge"]),
    "fact_outfield_stats": lambda t: gold.fact_outfield_stats(
        t["stg_players"], t["dim_player"], t["dim_club"], t["dim_season"]
    ),
    "fact_goalkeeper_stats": lambda t: gold.fact_goalkeeper_stats(
        t["stg_players"], t["dim_player"], t["dim_club"], t["dim_season"]
    ),
    "fact_player_season_stats": lambda t: gold.fact_player_season_stats(
        t["stg_players"], t["dim_season"]
    ),
    "fact_market_value_history": lambda t: gold.fact_market_value_history(
        t["stg_market_values"], t["dim_player_bridge"], t["dim_player"], t["dim_season"]
    ),
    "mart_similarity_outfield": lambda t: marts.mart_similarity_outfield(
        t["fact_outfield_stats"], t["dim_club"], t["dim_player"], t["fact_market_value_history"]
    ),
    "mart_similarity_goalkeeper": lambda t: marts.mart_similarity_goalkeeper(
        t["fact_goalkeeper_stats"], t["dim_club"], t["dim_player"], t["fact_market_value_history"]
    ),
    "mart_forwards": lambda t: marts.mart_forwards(
        t["fact_outfield_stats"], t["dim_player"], t["dim_season"], t["fact_market_value_history"]
    ),
    "recommendations": lambda t: _recommendations(t),
}


#: Tables that lie in buckets, by the keys on which others join them or pick their latest rows.
BUCKETS = {"stg_players": ["player_name"], "dim_player": ["player_name"]}


class Medallion:
    """The tables of one run over two bronze feeds.

    `m[name]` is a table: fully refreshed on first use below `warehouse` and read
    back, since most have several consumers and reading prunes columns.
    `m.plan(name)` is the lazy plan of a table over stored ones. A feed that is
    read from storage already can be passed as it is (`stored_bronze`). Tables in `views`
    are planned within each of their readers, which then computes only the columns that it
    needs: for wide tables of which a run reads little, storing costs more than that.
    """

    def __init__(
        self, players: DataFrame, market: DataFrame, warehouse: str | None = None,
        stored_bronze: bool = False, views: Collection[str] = (),
    ):
        compiled_wide(players.sparkSession)
        self.bronze = {"players": players, "market": market}
        self.warehouse = warehouse or scratch_dir(players.sparkSession, "warehouse")
        self.views = frozenset(views)
        self._stored: dict[str, DataFrame] = {}
        if stored_bronze:
            self._stored = {"bronze_players": players, "bronze_market": market}

    def plan(self, name: str) -> DataFrame:
        return PLANS[name](self)

    def intact(self) -> bool:
        """Whether every table stored so far is still there."""
        try:
            for name in self._stored:
                spark = self._stored[name].sparkSession
                spark.read.schema(self._stored[name].schema).parquet(self._path(name))
        except AnalysisException:
            return False
        return True

    def _path(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.views:
            return self.plan(name)
        if name not in self._stored:
            if name in BUCKETS:
                self._stored[name] = refresh_bucketed(self.plan(name), self._path(name), BUCKETS[name])
            else:
                self._stored[name] = refresh(self.plan(name), self._path(name))
        return self._stored[name]


def _recommendations(t: Medallion, n: int = config.TOP_N) -> DataFrame:
    """Fit both models and score every player."""
    pools = {
        "GK": (t["mart_similarity_goalkeeper"], config.GOALKEEPER_FEATURES),
        "OUT": (t["mart_similarity_outfield"], config.OUTFIELD_FEATURES),
    }
    models = recommend.build_models(pools)
    return recommend.recommend({p: (mart, models[p], cols) for p, (mart, cols) in pools.items()}, n)
