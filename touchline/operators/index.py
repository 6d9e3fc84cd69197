"""A stored neighbour index: built once, opened by any session, exact for every lookup.

Vectors lie in a table partitioned by block: a role slot and a cell around one of the
pivots. The pivots and the range of angles of every block are small tables of their own.
A lookup reads the target by name, works out how high it could score in each block, reads
the most promising ones, and then only those that could still reach its n-th score.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline import config
from touchline.functions.numbers import dot, unit
from touchline.operators.neighbours import (
    MAX_PIVOTS, ROLE_SLOTS, SCORE_DIGITS, _angles, _cell_bounds, role_penalty,
)
from touchline.session import materialise

CELL_ROWS = 4096
#: Rows of a file of a block; larger blocks are spread over several.
FILE_ROWS = 200_000
NAME_FILE_ROWS = 1_000_000


class NeighbourIndex:
    """An index stored at `path` (see `build`). `visited` has the blocks read by the last
    lookup and how many there are."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.pivots = np.array([r["vec"] for r in spark.read.parquet(f"{path}/pivots").orderBy("pivot").collect()])
        # At most MAX_PIVOTS * ROLE_SLOTS rows, whatever the size of the data.
        self.cells = spark.read.parquet(f"{path}/cells").toPandas()
        self.vectors = spark.read.parquet(f"{path}/vectors")
        self.visited: tuple[int, int] = (0, len(self.cells))

    @classmethod
    def build(
        cls, pool: DataFrame, path: str, key: str = "player_key", name: str = "player_name",
        position: str = "primary_position", vector: str = "features", cell_rows: int = CELL_ROWS,
    ) -> NeighbourIndex:
        """Store an index of `pool`, all its columns but the vector included."""
        spark = pool.sparkSession
        others = [c for c in pool.columns if c != vector]
        rows = pool.select(
            *[F.col(f"`{c}`") for c in others], F.col(key).alias("_key"), F.col(name).alias("_name"), F.col(position).alias("_role"),
            unit(F.col(vector).cast("array<double>")).alias("_vec"),
        )
        total = rows.count()
        k = max(1, min(MAX_PIVOTS, math.ceil(total / cell_rows)))
        order = F.xxhash64("_vec", "_key")
        seeds = [r["_vec"] for r in rows.orderBy(order, "_key").limit(k).select("_vec").collect()]
        pivots = np.array(seeds)
        stored = spark.createDataFrame([(i, v) for i, v in enumerate(seeds)], "pivot int, vec array<double>")
        stored.coalesce(1).write.mode("overwrite").parquet(f"{path}/pivots")

        @F.pandas_udf("cell int, angle double")
        def locate(vec: pd.Series) -> pd.DataFrame:
            angles = _angles(np.stack(vec.to_numpy()), pivots)
            cell = angles.argmin(axis=1)
            return pd.DataFrame({"cell": cell, "angle": angles[np.arange(len(cell)), cell]})

        slot = F.pmod(F.xxhash64(F.coalesce(F.col("_role").cast("string"), F.lit(""))), F.lit(ROLE_SLOTS)).cast("int")
        located = rows.withColumn("_slot", slot).withColumn("_at", locate("_vec"))
        located = materialise(located.withColumn("_block", F.col("_slot") * MAX_PIVOTS + F.col("_at.cell")), "located")
        cells = located.groupBy("_block").agg(
            F.count(F.lit(1)).alias("n"), F.min("_at.angle").alias("low"), F.max("_at.angle").alias("high"),
            F.first("_slot").alias("slot"), F.first("_at.cell").alias("cell"),
        )
        cells = cells.select("slot", "cell", "n", "low", "high", F.col("_block").alias("block"))
        cells.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
        sizes = spark.read.parquet(f"{path}/cells").select(F.col("block").alias("_block"), F.ceil(F.col("n") / FILE_ROWS).alias("_k"))
        dealt = located.join(F.broadcast(sizes), "_block").withColumn("_chunk", F.pmod(F.xxhash64("_key"), F.col("_k")))
        # Whole blocks, or chunks of them, go to one task each; no file is read for another block.
        dealt.repartition("_block", "_chunk").drop("_slot", "_at", "_k", "_chunk").write.mode("overwrite").partitionBy("_block").parquet(f"{path}/vectors")
        # By name, in ranges: a lookup reads the row groups whose range or Bloom filter may hold it.
        named = rows.select(F.lower("_name").alias("name_key"), "_key", "_name", "_role", "_vec")
        parts = max(1, math.ceil(total / NAME_FILE_ROWS))
        named.repartitionByRange(parts, "name_key").sortWithinPartitions("name_key").write.mode("overwrite").option(
            "parquet.bloom.filter.enabled#name_key", "true"
        ).parquet(f"{path}/names")
        return cls(spark, path)

    def lookup(self, target: str, n: int = config.TOP_N, mismatch: float = config.ROLE_MISMATCH) -> DataFrame:
        """The `n` rows most similar to the first row, by key, called `target` in any case,
        as `similar_to` finds them in the whole pool."""
        named = self.spark.read.parquet(f"{self.path}/names").where(F.col("name_key") == F.lower(F.lit(target)))
        known = named.agg(F.min_by(F.struct("_name", "_role", "_vec"), "_key").alias("t")).first()["t"]
        kept = [c for c in self.vectors.columns if c not in ("_key", "_name", "_role", "_vec", "_block")]
        if known is None or not len(self.cells):
            return self.vectors.where("false").select(*kept, F.lit(None).cast("double").alias("similarity_score"))
        score = dot(F.col("_vec"), F.array(*map(F.lit, known["_vec"]))) * role_penalty(F.col("_role"), F.lit(known["_role"]), mismatch)
        scored = self.vectors.where(F.col("_name") != F.lit(known["_name"])).withColumn("similarity_score", F.round(score, SCORE_DIGITS))
        slot = self.spark.range(1).select(
            F.pmod(F.xxhash64(F.coalesce(F.lit(known["_role"]).cast("string"), F.lit(""))), F.lit(ROLE_SLOTS)).cast("int").alias("s")
        ).first()["s"]
        bound = _cell_bounds(np.array([known["_vec"]]), np.array([slot]), self.pivots, self.cells, mismatch)[0]
        blocks, held = self.cells["block"].to_numpy(), self.cells["n"].to_numpy()
        best = np.argsort(-bound, kind="stable")
        first = best[: int(np.searchsorted(np.cumsum(held[best]), 4 * n)) + 1]
        top = self._in(scored, blocks[first]).select("similarity_score").orderBy(F.col("similarity_score").desc()).limit(n).collect()
        floor = top[-1][0] if len(top) == n else -2.0
        reach = np.flatnonzero(bound >= floor)
        self.visited = (len(reach), len(blocks))
        return self._in(scored, blocks[reach]).orderBy(F.col("similarity_score").desc(), F.col("_key").asc()).limit(n).select(*kept, "similarity_score")

    def _in(self, rows: DataFrame, blocks: np.ndarray) -> DataFrame:
        return rows.where(F.col("_block").isin([int(b) for b in blocks]))
