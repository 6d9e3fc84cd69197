"""Recency-weighted season aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline import config
from touchline.operators.rows import rank_per_key
from touchline.session import materialise


def recency_weighted(
    df: DataFrame,
    key: str,
    order: list[Column],
    metrics: list[str],
    label: str | None = None,
    weights: tuple[float, ...] = config.RECENCY_WEIGHTS,
    normalize: bool = False,
) -> DataFrame:
    """Weighted sums over the newest rows per key: first row weighs most.

    Missing metrics add nothing, and weights are not rescaled to the rows at
    hand unless `normalize` is set. Ranking and summing share one exchange on
    `key`, and only `len(weights)` rows per key and map task enter it.
    """
    ranked = rank_per_key(df, [key], order, len(weights), "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_rank"))
    sums = []
    for m in metrics:
        total = F.sum(F.col(m).cast("double") * weight)
        if normalize:
            total = total / F.sum(F.when(F.col(m).isNotNull(), weight))
        sums.append(total.alias(m))
    labels = [F.max(label).alias(label)] if label else []
    return ranked.groupBy(key).agg(*labels, *sums)


def recency_decay(
    df: DataFrame,
    key: str,
    year: str,
    metrics: list[str],
    largest: str | None = None,
    base: float = config.DECAY_BASE,
) -> DataFrame:
    """Sums weighted by `base ** age`, age counted in years from the newest year
    of the whole table; with the maximum of `largest` per key.

    The input is read once, into sums per key and year, which are stored; the newest
    year and the weighted sums come from those.
    """
    tops = [F.max(largest).alias(largest)] if largest else []
    yearly = df.groupBy(key, year).agg(*[F.sum(F.col(m).cast("double")).alias(m) for m in metrics], *tops)
    yearly = materialise(yearly, "yearly")
    newest = yearly.agg(F.max(year)).scalar()
    weight = F.pow(F.lit(base), newest - F.col(year))
    return yearly.groupBy(key).agg(*[F.sum(F.col(m) * weight).alias(m) for m in metrics], *tops)
