"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b); the component is its
    smallest node. Nulls and loops are no edges. Nodes may also be text.

    Each round links every node's larger neighbours, and then its smaller ones, to the
    smallest node it sees. A node sends one row per neighbour at most, so a component
    of any size or shape stays spread over all tasks. Rounds are logarithmic in number;
    each is written to the shared folder.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialise(edges.distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        linked, _ = _star(both)
        edges = materialise(linked.where("larger").select("a", "b").distinct(), "edges")
        linked, own = _star(edges)
        edges = materialise(linked.select("a", "b").unionByName(own).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now


def _star(neighbours: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each neighbour `b` of a node `a`, and the node itself, linked to the smallest of
    the node and all its neighbours; `larger`: the neighbour was larger than the node."""
    least = neighbours.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = neighbours.join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b"), (F.col("b") > F.col("a")).alias("larger")
    )
    differ = F.col("a") != F.col("b")
    return linked.where(differ), least.select("a", F.col("m").alias("b")).where(differ)
