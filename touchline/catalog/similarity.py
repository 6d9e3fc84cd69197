"""The similarity model over lineitem features and the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline import config
from touchline.catalog import derive, query, table
from touchline.catalog.derived import for_duckdb
from touchline.catalog.layers import rounded
from touchline.operators.index import NeighbourIndex
from touchline.operators.neighbours import similar_all
from touchline.operators.scaling import fit, impute, transform, weighted_features
from touchline.session import scratch_dir
from touchline.sources.tables import export_csv, load_stats_table, save_stats

# Line items as feature rows: gaps where nothing was taken off the price.
LINES = """SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_quantity AS quantity,
    CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice END AS price,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS tax,
    CASE l_returnflag WHEN 'R' THEN 'fw' WHEN 'A' THEN 'DF' ELSE '??' END AS primary_position FROM {lineitem}"""
LINES_SQL = for_duckdb(LINES)
FEATURES = ("quantity", "price", "tax")
KEYS = ["l_orderkey", "l_partkey", "l_suppkey"]
WEIGHTS = {
    "FW": {"quantity": 3.0, "price": 0.5},
    "DF": {"quantity": 0.5, "price": 1.5},
    "MF": {"quantity": 1.5, "price": 2.0},
}
GROUP = "CASE WHEN UPPER(primary_position) IN ('FW', 'MF', 'DF') THEN UPPER(primary_position) ELSE 'MF' END"


def _weighted_sql(source: str) -> str:
    columns = []
    for f in FEATURES:
        whens = " ".join(f"WHEN '{g}' THEN {w[f]}::DOUBLE" for g, w in WEIGHTS.items() if f in w)
        columns.append(f"{f} * CASE {GROUP} {whens} END AS {f}" if whens else f)
    return f"SELECT {', '.join(KEYS)}, l_returnflag, {', '.join(columns)} FROM ({source})"


def _stats_sql(source: str, pool: str = "") -> str:
    label = f"'{pool}' AS pool, " if pool else ""
    return " UNION ALL ".join(
        f"""SELECT {label}'{f}' AS feature, ROUND(MEDIAN({f}), 6) AS median,
        ROUND(AVG(COALESCE({f}, (SELECT MEDIAN({f}) FROM ({source})))), 6) AS mean,
        ROUND(STDDEV_POP(COALESCE({f}, (SELECT MEDIAN({f}) FROM ({source})))), 6) AS std FROM ({source})"""
        for f in FEATURES
    )


def _lines(spark, sf_dir):
    return derive(spark, sf_dir, LINES, "lineitem")


@query(
    "weighted_features",
    f"SELECT * EXCLUDE (l_returnflag) REPLACE ({', '.join(f'ROUND({f}, 6) AS {f}' for f in FEATURES)}) FROM ({_weighted_sql(LINES_SQL)})",
)
def _weighted_features(spark, sf_dir):
    rows = weighted_features(_lines(spark, sf_dir), FEATURES, WEIGHTS)
    return rounded(rows.select(*KEYS, *FEATURES), FEATURES)


@query(
    "impute_median",
    f"""SELECT {', '.join(KEYS)}, {', '.join(f'COALESCE({f}, (SELECT MEDIAN({f}) FROM ({LINES_SQL}))) AS {f}' for f in FEATURES)}
    FROM ({LINES_SQL})""",
)
def _impute_median(spark, sf_dir):
    rows = _lines(spark, sf_dir)
    return impute(rows, fit(rows, FEATURES), FEATURES).select(*KEYS, *FEATURES)


def _standard_sql() -> str:
    columns = []
    for f in FEATURES:
        filled = f"COALESCE({f}, (SELECT MEDIAN({f}) FROM ({LINES_SQL})))"
        moments = f"(SELECT AVG({filled}) AS mean, STDDEV_POP({filled}) AS std FROM ({LINES_SQL}))"
        columns.append(
            f"ROUND(({filled} - (SELECT mean FROM {moments})) / (SELECT std FROM {moments}), 6) AS {f}"
        )
    return f"SELECT {', '.join(KEYS)}, {', '.join(columns)} FROM ({LINES_SQL})"


@query("standardize", _standard_sql())
def _standardize(spark, sf_dir):
    rows = _lines(spark, sf_dir)
    scaled = transform(rows, fit(rows, FEATURES), FEATURES, vector=None)
    return rounded(scaled.select(*KEYS, *FEATURES), FEATURES)


POOLS = {"RETURNED": "l_returnflag = 'R'", "KEPT": "l_returnflag <> 'R'"}


@query(
    "fit_two_pools",
    " UNION ALL ".join(
        _stats_sql(_weighted_sql(f"SELECT * FROM ({LINES_SQL}) WHERE {where}"), pool) for pool, where in POOLS.items()
    ),
)
def _fit_two_pools(spark, sf_dir):
    """Each pool's model is saved, loaded again and reported."""
    rows, out = _lines(spark, sf_dir), None
    for pool, where in POOLS.items():
        path = scratch_dir(spark, "model")
        save_stats(fit(rows.where(where), FEATURES, WEIGHTS), path)
        loaded = load_stats_table(spark, path).withColumn("pool", F.lit(pool))
        out = loaded if out is None else out.unionByName(loaded)
    return rounded(out, ("median", "mean", "std"))


VECTORS = """SELECT vec_id, 'vector ' || CAST(vec_id AS STRING) AS name, 'label ' || CAST(label AS STRING) AS position,
    embedding FROM {embeddings}"""
SCORE = """ROUND(LIST_DOT_PRODUCT(q.v, c.v) / (SQRT(LIST_DOT_PRODUCT(q.v, q.v)) * SQRT(LIST_DOT_PRODUCT(c.v, c.v)))
    * CASE WHEN q.position = c.position THEN 1 ELSE 0.75::DOUBLE END, 12)"""
VECTORS_SQL = f"(SELECT *, CAST(embedding AS DOUBLE[]) AS v FROM ({for_duckdb(VECTORS, 'embeddings')}))"


def _vectors(spark, sf_dir):
    rows = derive(spark, sf_dir, VECTORS, "embeddings")
    return rows.withColumn("embedding", F.col("embedding").cast("array<double>"))


@query(
    "similar_one",
    f"""SELECT vec_id, name, position, ROUND(score, 6) AS similarity_score
    FROM (SELECT c.vec_id, c.name, c.position, {SCORE} AS score FROM {VECTORS_SQL} q JOIN {VECTORS_SQL} c
            ON q.name = 'vector 0' AND c.name <> q.name)
    ORDER BY score DESC, vec_id LIMIT {config.TOP_N}""",
)
def _similar_one(spark, sf_dir):
    """An index is stored, opened again and asked."""
    path = scratch_dir(spark, "index")
    columns = {"key": "vec_id", "name": "name", "position": "position", "vector": "embedding"}
    NeighbourIndex.build(_vectors(spark, sf_dir), path, **columns)
    return rounded(NeighbourIndex(spark, path).lookup("VECTOR 0"), ("similarity_score",))


@query(
    "similar_batch",
    f"""SELECT target_key, target_name, target_position, predicted_key, predicted_name, predicted_position,
        ROUND(score, 6) AS similarity_score
    FROM (SELECT q.vec_id AS target_key, q.name AS target_name, q.position AS target_position,
            c.vec_id AS predicted_key, c.name AS predicted_name, c.position AS predicted_position, {SCORE} AS score
        FROM {VECTORS_SQL} q JOIN {VECTORS_SQL} c ON c.name <> q.name)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY target_key ORDER BY score DESC, predicted_key) <= {config.TOP_N}""",
)
def _similar_batch(spark, sf_dir):
    """Everyone's top five, exported as a report and read back."""
    pool = _vectors(spark, sf_dir)
    top = similar_all(pool, key="vec_id", name="name", position="position", vector="embedding")
    who = pool.select("vec_id", "name", "position")
    target = who.select(*[F.col(c).alias(f"t_{c}") for c in who.columns])
    match = who.select(*[F.col(c).alias(f"p_{c}") for c in who.columns])
    report = (
        top.join(target, F.col("query_key") == F.col("t_vec_id"))
        .join(match, F.col("match_key") == F.col("p_vec_id"))
        .select(
            F.round("similarity_score", 6).alias("similarity_score"),
            F.col("t_vec_id").alias("target_key"),
            F.col("t_name").alias("target_name"),
            F.col("t_position").alias("target_position"),
            F.col("p_vec_id").alias("predicted_key"),
            F.col("p_name").alias("predicted_name"),
            F.col("p_position").alias("predicted_position"),
        )
    )
    path = scratch_dir(spark, "report")
    first = [c for c in report.columns if c != "similarity_score"]
    export_csv(report, path, first)
    types = {f.name: f.dataType.simpleString() for f in report.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in [*first, "similarity_score"])
    return spark.read.schema(schema).option("header", "true").csv(path)
