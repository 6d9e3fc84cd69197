"""Median imputation and standardisation, fitted in two passes over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.functions.text import weight_group
from touchline.session import materialise

STATS_DDL = "feature string, median double, mean double, std double"
# Quantile sketch: ranks are right within n / ACCURACY, so a bracket of twice
# that on each side of the middle holds the exact median.
ACCURACY = 10_000
BRACKET = (0.5 - 2 / ACCURACY, 0.5 + 2 / ACCURACY)
#: Ranges of equal width that a bracket is cut into.
RANGES = 1024


def weighted_features(
    df: DataFrame,
    features: Sequence[str],
    weights: Mapping[str, Mapping[str, float]],
    position: str = "primary_position",
    group: Column | None = None,
) -> DataFrame:
    """Scale each feature by the weight its row's position group gives it."""
    group = weight_group(F.col(position)) if group is None else group
    scaled = {}
    for feature in features:
        factor = F
        for role, table in weights.items():
            if feature in table:
                factor = factor.when(group == role, F.lit(float(table[feature])))
        plain = F.col(feature).cast("double")
        scaled[feature] = plain if factor is F else plain * factor.otherwise(F.lit(1.0))
    return df.withColumns(scaled)


def fit(
    df: DataFrame,
    features: Sequence[str],
    weights: Mapping[str, Mapping[str, float]] | None = None,
    position: str = "primary_position",
) -> DataFrame:
    """Median, mean and population deviation per feature, one row each.

    Mean and deviation are those of the imputed column. They follow from the
    column's own moments, its count of gaps and its median, so no third pass is
    needed. The result is a model: as many rows as there are features.
    """
    if weights:
        df = weighted_features(df, features, weights, position)
    first = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(f).alias(f"n_{f}") for f in features],
        *[F.avg(F.col(f).cast("double")).alias(f"mean_{f}") for f in features],
        *[F.var_pop(F.col(f).cast("double")).alias(f"var_{f}") for f in features],
        *[
            F.percentile_approx(F.col(f).cast("double"), BRACKET, ACCURACY).alias(f"near_{f}")
            for f in features
        ],
    ).first()
    counts = {f: first[f"n_{f}"] for f in features}
    brackets = {f: tuple(first[f"near_{f}"]) for f in features if counts[f]}
    medians = exact_medians(df, counts, brackets)
    out = []
    for f in features:
        n, gaps = counts[f], first["rows"] - counts[f]
        if not n:
            out.append((f, None, None, None))
            continue
        median, mean, spread = medians[f], first[f"mean_{f}"], first[f"var_{f}"] * n
        total = n + gaps
        spread += (mean - median) ** 2 * n * gaps / total
        out.append((f, median, (n * mean + gaps * median) / total, (spread / total) ** 0.5))
    return df.sparkSession.createDataFrame(out, STATS_DDL)


def exact_medians(df: DataFrame, counts: dict, brackets: dict) -> dict[str, float]:
    """The interpolated median of each column in `brackets`.

    Values below the bracket are only counted; those inside it, a 2500th of the rows or
    so, are counted per distinct value and by ranges. Prefix sums over the ranges tell
    which of them hold the middle, and only within those are values put in order.
    """
    if not brackets:
        return {}
    found = _select_middle(df, counts, brackets)
    missed = [f for f in brackets if found.get(f) is None]
    if missed:  # not expected; the whole column is then counted
        ends = df.agg(
            *[F.min(F.col(f).cast("double")).alias(f"low_{k}") for k, f in enumerate(missed)],
            *[F.max(F.col(f).cast("double")).alias(f"high_{k}") for k, f in enumerate(missed)],
        ).first()
        wide = {f: (ends[f"low_{k}"], ends[f"high_{k}"]) for k, f in enumerate(missed)}
        found.update(_select_middle(df, counts, wide))
    return found


def _select_middle(df: DataFrame, counts: dict, brackets: dict) -> dict:
    values = {f: F.col(f).cast("double") for f in brackets}
    below = df.agg(*[F.count(F.when(values[f] < low, 1)).alias(f) for f, (low, _) in brackets.items()]).first()
    # Ranks of the two middle values among those from the bracket's lower end.
    ranks = {f: ((counts[f] + 1) // 2 - below[f], counts[f] // 2 + 1 - below[f]) for f in brackets}
    cells = []
    for f, (low, high) in brackets.items():
        share = (values[f] - low) / (high - low) * RANGES if high > low else F.lit(0.0)
        cells.append(
            F.when(
                values[f].between(low, high),
                F.struct(F.lit(f).alias("feature"), F.floor(share).cast("int").alias("range"), values[f].alias("value")),
            )
        )
    long = df.select(F.inline(F.array_compact(F.array(*cells))))
    tally = materialise(long.groupBy("feature", "range", "value").agg(F.count(F.lit(1)).alias("n")), "tally")
    # At most RANGES + 1 rows per feature.
    ranges = tally.groupBy("feature", "range").agg(F.sum("n").alias("held"))
    over = Window.partitionBy("feature").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ranges = ranges.withColumn("start", F.sum("held").over(over) - F.col("held"))

    def rank(which: int) -> Column:
        return F.create_map(*[F.lit(x) for f, r in ranks.items() for x in (f, r[which])])[F.col("feature")]

    ranges = ranges.where((F.col("start") < rank(1)) & (F.col("start") + F.col("held") >= rank(0)))
    inside = Window.partitionBy("feature", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.col("start") + F.sum("n").over(inside)
    middle = (
        tally.join(ranges, ["feature", "range"]).withColumn("reached", reached).groupBy("feature")
        .agg(
            F.min(F.when(F.col("reached") >= rank(0), F.col("value"))).alias("v1"),
            F.min(F.when(F.col("reached") >= rank(1), F.col("value"))).alias("v2"),
        )
    )
    rows = middle.collect()  # one row per feature
    return {
        r["feature"]: (r["v1"] + r["v2"]) / 2
        for r in rows
        if ranks[r["feature"]][0] > 0 and r["v1"] is not None and r["v2"] is not None
    }


def transform(
    df: DataFrame, stats: DataFrame, features: Sequence[str], vector: str | None = "features"
) -> DataFrame:
    """Impute and standardise with fitted statistics.

    The statistics enter as one scalar subquery over a table of one row per
    feature. With `vector` the result is one array column, else each feature is
    replaced in place.
    """
    entry = F.struct("feature", F.struct("median", "mean", "std"))
    model = stats.agg(F.map_from_entries(F.collect_list(entry))).scalar()
    df = df.withColumn("_model", model)

    def scaled(f: str) -> Column:
        fitted = F.col("_model")[f]
        spread = F.when(fitted["std"] > 0, fitted["std"]).otherwise(F.lit(1.0))
        filled = F.coalesce(F.col(f).cast("double"), fitted["median"])
        return F.coalesce((filled - fitted["mean"]) / spread, F.lit(0.0))

    if vector:
        return df.withColumn(vector, F.array(*[scaled(f) for f in features])).drop("_model")
    return df.withColumns({f: scaled(f) for f in features}).drop("_model")


def impute(df: DataFrame, stats: DataFrame, features: Sequence[str]) -> DataFrame:
    """Fill gaps with the fitted medians."""
    model = stats.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "median")))
    ).scalar()
    df = df.withColumn("_medians", model)
    filled = {f: F.coalesce(F.col(f).cast("double"), F.col("_medians")[f]) for f in features}
    return df.withColumns(filled).drop("_medians")
