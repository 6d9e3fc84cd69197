"""Typed projection, deduplication and per-key ranking."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F


def typed_projection(
    df: DataFrame, spec: Mapping[str, Column], required: Iterable[str] = ()
) -> DataFrame:
    """Keep rows whose `required` inputs are present, then project `spec`."""
    for name in required:
        df = df.where(F.col(name).isNotNull())
    return df.select(*[expr.alias(name) for name, expr in spec.items()])


def dedup_max(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, holding the maximum of every other column.

    Partial maxima are taken before the shuffle, so a key with very many rows
    costs one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rest])


#: Words of 64 marks by which rows whose key may come again are told; 8 MB in all.
MARK_WORDS = 1 << 20


def repeat_marks(df: DataFrame, keys: list[Column]) -> DataFrame:
    """One row with an array of bits, of which one is set by the hash of every key that
    comes more than once. Only hashes are shuffled; the size is fixed."""
    hashes = df.select(F.xxhash64(*keys).alias("_hash")).groupBy("_hash").count().where(F.col("count") > 1)
    word, mark = _mark(F.col("_hash"))
    none = df.sparkSession.range(MARK_WORDS).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("marks"))
    words = hashes.select(word.alias("word"), mark.alias("marks")).unionByName(none)
    words = words.groupBy("word").agg(F.bit_or("marks").alias("marks"))
    listed = F.sort_array(F.collect_list(F.struct("word", "marks")))
    return words.agg(F.transform(listed, lambda w: w["marks"]).alias("marks"))


def may_repeat(marks: DataFrame, keys: list[Column]) -> Column:
    """Whether a row's key may come more than once: true for all that do, and for some that
    do not, by `repeat_marks` of the same rows."""
    word, mark = _mark(F.xxhash64(*keys))
    return F.get(marks.scalar(), word).bitwiseAND(mark) != 0


def _mark(hashed: Column) -> tuple[Column, Column]:
    place = F.pmod(hashed, F.lit(MARK_WORDS * 64))
    return F.shiftright(place, 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(hashed, F.lit(64)).cast("int"))


def rank_per_key(
    df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first `n` rows per key with their rank.

    The filter on the rank lets Spark keep only `n` rows per key in every map
    task before the shuffle (WindowGroupLimit), so hot keys stay small. `order`
    should end in columns that break every tie.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    ranked = rank_per_key(df, keys, order, n, "_rank")
    return ranked.drop("_rank")


def preview(df: DataFrame, order: list[Column], n: int = 10) -> DataFrame:
    """The first rows of a fixed order."""
    return df.orderBy(*order).limit(n)
