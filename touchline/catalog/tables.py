"""Operators one by one over the driver's relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.catalog import derive, query, table
from touchline.catalog.derived import POSITION, for_duckdb, for_spark
from touchline.catalog.layers import (
    BRIDGE_SQL,
    DETAILS,
    PRIMARY,
    SEASON_COLUMNS,
    SEASON_YEARS,
    SECONDARY,
    _clean,
    _int,
    _money,
    match_sql,
    rounded,
)
from touchline.functions.casting import tolerant_date, tolerant_int
from touchline.functions.numbers import clamp, guarded_rate
from touchline.functions.text import (
    clean_name,
    is_goalkeeper,
    parse_season,
    position_details,
    primary_position,
    routed_model,
    secondary_position,
    surrogate_key,
    weight_group,
)
from touchline.operators.joins import attach, attach_coalesced, attach_season_by_digits
from touchline.operators.matching import accept, best_match, block_profile, names_with_blocks
from touchline.operators.recency import recency_decay, recency_weighted
from touchline.operators.rows import dedup_max, latest_per_key, preview, typed_projection
from touchline.operators.standings import standings
from touchline.plans.silver import money

YEAR = "CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER)"
SEASON = f"""CASE WHEN o_orderkey % 11 = 3 THEN CAST({YEAR} AS STRING)
    ELSE CAST({YEAR} AS STRING) || '-' || CAST({YEAR} + 1 AS STRING) END"""

PART_TEXT = """SELECT p_partkey, CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_name END AS name,
    CASE WHEN p_size % 7 = 0 THEN 'junk' WHEN p_size % 2 = 0 THEN CAST(p_size AS STRING) || '.0'
        ELSE CAST(p_size AS STRING) || '.7' END AS size_text,
    '£ ' || CAST(CAST(FLOOR(p_retailprice) AS BIGINT) AS STRING)
        || CASE WHEN p_size % 3 = 0 THEN ' (€ 1,099)' ELSE '' END AS price_text FROM {part}"""


@query(
    "typed_clean",
    f"""SELECT p_partkey, name, {_int('size_text')} AS size, {_money('price_text', '£')} AS price_gbp,
        {_money('price_text', '€')} AS price_eur
    FROM ({for_duckdb(PART_TEXT, 'part')}) WHERE name IS NOT NULL""",
)
def _typed_clean(spark, sf_dir):
    spec = {
        "p_partkey": F.col("p_partkey"),
        "name": F.col("name"),
        "size": tolerant_int(F.col("size_text")),
        "price_gbp": money(F.col("price_text"), "£"),
        "price_eur": money(F.col("price_text"), "€"),
    }
    return typed_projection(derive(spark, sf_dir, PART_TEXT, "part"), spec, ("name",))


ORDER_DATES = """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN MONTH_YEAR(o_orderdate)
    WHEN 'F' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) ELSE 'soon' END AS text FROM {orders}"""


@query(
    "date_parse",
    f"""SELECT o_orderkey, CAST(TRY_STRPTIME(text, '%B %Y') AS DATE) AS by_month,
        CAST(TRY_STRPTIME(text, '%Y-%m-%d') AS DATE) AS by_day
    FROM ({for_duckdb(ORDER_DATES, 'orders')})""",
)
def _date_parse(spark, sf_dir):
    text = derive(spark, sf_dir, for_spark(ORDER_DATES), "orders")
    return text.select(
        "o_orderkey",
        tolerant_date(F.col("text"), "MMMM yyyy").alias("by_month"),
        tolerant_date(F.col("text"), "yyyy-MM-dd").alias("by_day"),
    )


DEDUP_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query(
    "max_dedup",
    f"""SELECT l_partkey, l_suppkey, {', '.join(f'MAX({c}) AS {c}' for c in DEDUP_COLUMNS)}
    FROM lineitem GROUP BY 1, 2""",
)
def _max_dedup(spark, sf_dir):
    keys = ["l_partkey", "l_suppkey"]
    return dedup_max(table(spark, sf_dir, "lineitem").select(*keys, *DEDUP_COLUMNS), keys)


ORDER_SEASONS = f"SELECT o_orderkey, {SEASON} AS season FROM {{orders}}"
SEASONS_SQL = f"""SELECT {SEASON_COLUMNS} FROM (SELECT season, {SEASON_YEARS}
    FROM (SELECT DISTINCT season FROM ({for_duckdb(ORDER_SEASONS, 'orders')})))"""


def _seasons(rows):
    parsed = rows.select("season").distinct().select("season", parse_season(F.col("season")).alias("p"))
    return parsed.select("season", "p.*")


@query("distinct_dim", SEASONS_SQL)
def _distinct_dim(spark, sf_dir):
    return _seasons(derive(spark, sf_dir, ORDER_SEASONS, "orders"))


@query(
    "join_cast_key",
    f"""SELECT o.o_orderkey, o.season, s.season_key FROM ({for_duckdb(ORDER_SEASONS, 'orders')}) o
    LEFT JOIN ({SEASONS_SQL}) s
        ON TRY_CAST(s.season_key AS BIGINT) = TRY_CAST(REPLACE(o.season, '-', '') AS BIGINT)""",
)
def _join_cast_key(spark, sf_dir):
    rows = derive(spark, sf_dir, ORDER_SEASONS, "orders")
    return attach_season_by_digits(rows, _seasons(rows), "season", {"season_key": "season_key"})


@query(
    "latest_per_key",
    """SELECT MD5(UPPER(TRIM('customer ' || CAST(o_custkey AS VARCHAR)))) AS customer_key, o_custkey, o_orderkey,
        o_orderdate, o_totalprice FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey) = 1""",
)
def _latest_per_key(spark, sf_dir):
    order = [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").asc()]
    latest = latest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], order)
    name = F.concat(F.lit("customer "), F.col("o_custkey").cast("string"))
    return latest.select(
        surrogate_key(name).alias("customer_key"), "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )


PART_POSITIONS = f"SELECT p_partkey, {POSITION} AS position FROM {{part}}"


@query(
    "position_case",
    f"""SELECT p_partkey, {PRIMARY} AS primary_position, {SECONDARY} AS secondary_position,
        {DETAILS} AS position_details, p = 'GK' AS keeper,
        CASE WHEN p LIKE '%GK%' THEN 'GK' WHEN p LIKE '%FW%' THEN 'FW' WHEN p LIKE '%DF%' THEN 'DF' ELSE 'MF' END AS model,
        CASE WHEN UPPER(position) IN ('FW', 'MF', 'DF') THEN UPPER(position) ELSE 'MF' END AS weight_group
    FROM (SELECT *, UPPER(TRIM(position)) AS p FROM ({for_duckdb(PART_POSITIONS, 'part')}))""",
)
def _position_case(spark, sf_dir):
    position = F.col("position")
    return derive(spark, sf_dir, PART_POSITIONS, "part").select(
        "p_partkey",
        primary_position(position).alias("primary_position"),
        secondary_position(position).alias("secondary_position"),
        position_details(position).alias("position_details"),
        is_goalkeeper(position).alias("keeper"),
        routed_model(position).alias("model"),
        weight_group(position).alias("weight_group"),
    )


LINE_SEASONS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
    CAST(CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) AS STRING) AS season FROM {lineitem}"""


@query(
    "star_fact",
    f"""SELECT f.*, p.p_name, s.s_name, d.season_key FROM ({for_duckdb(LINE_SEASONS)}) f
    LEFT JOIN part p ON f.l_partkey = p.p_partkey LEFT JOIN supplier s ON f.l_suppkey = s.s_suppkey
    LEFT JOIN (SELECT DISTINCT season AS season_key FROM ({for_duckdb(LINE_SEASONS)})) d ON f.season = d.season_key""",
)
def _star_fact(spark, sf_dir):
    rows = derive(spark, sf_dir, LINE_SEASONS, "lineitem")
    rows = attach(rows, table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"}, {"p_name": "p_name"})
    rows = attach(rows, table(spark, sf_dir, "supplier"), {"l_suppkey": "s_suppkey"}, {"s_name": "s_name"})
    return attach(rows, _seasons(rows), {"season": "season"}, {"season_key": "season_key"})


@query(
    "join_coalesce_key",
    """SELECT c.c_custkey, COALESCE(b.canonical, c.c_name) AS canonical_name, d.person_key
    FROM customer c LEFT JOIN (SELECT c_name, n_name AS canonical FROM customer
            JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 5000) b ON c.c_name = b.c_name
        LEFT JOIN (SELECT n_name AS name, MD5(UPPER(TRIM(n_name))) AS person_key FROM nation) d
            ON COALESCE(b.canonical, c.c_name) = d.name""",
)
def _join_coalesce_key(spark, sf_dir):
    customer, nation = (table(spark, sf_dir, t) for t in ("customer", "nation"))
    bridge = customer.where("c_acctbal > 5000").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    dim = nation.select(F.col("n_name").alias("name"), surrogate_key(F.col("n_name")).alias("person_key"))
    rows = attach(customer.select("c_custkey", "c_name"), bridge, {"c_name": "c_name"}, {"n_name": "canonical"})
    rows = attach_coalesced(
        rows, dim, F.col("canonical"), F.col("c_name"), "name", {"person_key": "person_key"}, "canonical_name"
    )
    return rows.select("c_custkey", "canonical_name", "person_key")


# --- names out of whole texts -----------------------------------------------

DOC_WORDS_SQL = r"(SELECT UNNEST(REGEXP_EXTRACT_ALL(text, '\p{L}+')) AS name, lang AS team FROM documents)"
ITEM_WORDS_SQL = r"(SELECT UNNEST(REGEXP_EXTRACT_ALL(text, '\p{L}+')) AS name, 'EN' AS team FROM benchmark)"


def _words(df, team):
    found = F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))
    return df.select(F.explode(found).alias("name"), team.alias("team"))


def _doc_words(spark, sf_dir):
    return names_with_blocks(_words(table(spark, sf_dir, "documents"), F.col("lang")), "name", "team")


def _item_words(spark, sf_dir):
    return names_with_blocks(_words(table(spark, sf_dir, "benchmark"), F.lit("EN")), "name", "team")


@query("accent_clean", f"SELECT DISTINCT name, {_clean('name')} AS clean FROM {DOC_WORDS_SQL}")
def _accent_clean(spark, sf_dir):
    words = _words(table(spark, sf_dir, "documents"), F.col("lang")).select("name").distinct()
    return words.select("name", clean_name(F.col("name")).alias("clean"))


def _blocks_sql(words: str, size: str) -> str:
    return f"""(SELECT LEFT({_clean('name')}, 3) AS block, COUNT(*) AS {size}
        FROM (SELECT DISTINCT name, team FROM {words} WHERE name IS NOT NULL) GROUP BY 1)"""


@query(
    "blocked_pairs",
    f"""SELECT block, left_names, right_names, left_names * right_names AS pairs
    FROM {_blocks_sql(DOC_WORDS_SQL, 'left_names')} JOIN {_blocks_sql(ITEM_WORDS_SQL, 'right_names')} USING (block)""",
)
def _blocked_pairs(spark, sf_dir):
    return block_profile(_doc_words(spark, sf_dir), _item_words(spark, sf_dir))


NAME_MATCH_SQL = match_sql(DOC_WORDS_SQL, ITEM_WORDS_SQL)


@query("name_match", NAME_MATCH_SQL)
def _name_match(spark, sf_dir):
    return best_match(_doc_words(spark, sf_dir), _item_words(spark, sf_dir))


@query("match_bridge", f"WITH int_player_name_match AS ({NAME_MATCH_SQL}) {BRIDGE_SQL}")
def _match_bridge(spark, sf_dir):
    return accept(_name_match(spark, sf_dir))


# --- recency ----------------------------------------------------------------

CUSTOMER_YEARS = f"""SELECT o_custkey, {YEAR} AS year, MAX(o_orderstatus) AS status,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent, COUNT(*) AS placed
    FROM {{orders}} GROUP BY o_custkey, {YEAR}"""
RECENCY_SQL = f"""SELECT o_custkey, MAX(status) AS status,
    ROUND(SUM(spent * CASE r WHEN 1 THEN 0.6::DOUBLE WHEN 2 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END), 6) AS spent,
    ROUND(SUM(placed * CASE r WHEN 1 THEN 0.6::DOUBLE WHEN 2 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END), 6) AS placed
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY year DESC NULLS FIRST) AS r
        FROM ({for_duckdb(CUSTOMER_YEARS, 'orders')})) WHERE r <= 3 GROUP BY o_custkey"""
LATEST_VALUE_SQL = """SELECT o_custkey, o_totalprice AS latest_price FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey) = 1"""


@query("recency_weighted", RECENCY_SQL)
def _recency_weighted(spark, sf_dir):
    years = derive(spark, sf_dir, CUSTOMER_YEARS, "orders")
    order = [F.col("year").desc_nulls_first()]
    return rounded(recency_weighted(years, "o_custkey", order, ["spent", "placed"], "status"), ("spent", "placed"))


@query("latest_value", LATEST_VALUE_SQL)
def _latest_value(spark, sf_dir):
    order = [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").asc()]
    latest = latest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], order)
    return latest.select("o_custkey", F.col("o_totalprice").alias("latest_price"))


@query(
    "similarity_mart",
    f"""SELECT a.o_custkey, c.c_name, n.n_name, a.status, v.latest_price, a.spent, a.placed
    FROM ({RECENCY_SQL}) a JOIN customer c ON a.o_custkey = c.c_custkey
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN ({LATEST_VALUE_SQL}) v ON a.o_custkey = v.o_custkey""",
)
def _similarity_mart(spark, sf_dir):
    rows = attach(
        _recency_weighted(spark, sf_dir), table(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"},
        {"c_name": "c_name", "c_nationkey": "nationkey"}, how="inner",
    )
    rows = attach(rows, table(spark, sf_dir, "nation"), {"nationkey": "n_nationkey"}, {"n_name": "n_name"})
    rows = attach(rows, _latest_value(spark, sf_dir), {"o_custkey": "o_custkey"}, {"latest_price": "latest_price"})
    return rows.drop("nationkey")


@query(
    "recency_decay",
    f"""SELECT o_custkey, ROUND(SUM(spent * POW(0.7::DOUBLE, newest - year)), 10) AS spent,
        ROUND(SUM(placed * POW(0.7::DOUBLE, newest - year)), 10) AS placed, MAX(spent) AS best
    FROM (SELECT y.*, (SELECT MAX({YEAR}) FROM orders JOIN customer ON o_custkey = c_custkey
                WHERE c_mktsegment = 'BUILDING') AS newest
        FROM ({for_duckdb(CUSTOMER_YEARS, 'orders')}) y JOIN customer ON o_custkey = c_custkey
        WHERE c_mktsegment = 'BUILDING') GROUP BY o_custkey""",
)
def _recency_decay(spark, sf_dir):
    building = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    years = attach(
        derive(spark, sf_dir, CUSTOMER_YEARS, "orders"), building, {"o_custkey": "c_custkey"}, {}, how="inner"
    ).withColumn("best", F.col("spent"))
    return rounded(recency_decay(years, "o_custkey", "year", ["spent", "placed"], "best"), ("spent", "placed"), 10)


@query(
    "rates",
    """SELECT l_partkey, CASE WHEN units = 0 THEN 0 ELSE ROUND(CAST(price / units AS DECIMAL(38,15)), 2)::DOUBLE END AS per_unit,
        CASE WHEN n = 0 THEN 0 ELSE ROUND(CAST(returned / n * 100 AS DECIMAL(38,15)), 1)::DOUBLE END AS returned_pct,
        CASE WHEN free = 0 THEN 0 ELSE ROUND(CAST(n / free AS DECIMAL(38,15)), 2)::DOUBLE END AS per_undiscounted,
        CAST(GREATEST(2, LEAST(n, 30)) AS BIGINT) AS clamped
    FROM (SELECT l_partkey, SUM(l_quantity) AS units, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
            COUNT(*) AS n, COUNT(*) FILTER (l_returnflag = 'R') AS returned, COUNT(*) FILTER (l_discount = 0) AS free
        FROM lineitem GROUP BY 1)""",
)
def _rates(spark, sf_dir):
    per_part = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("units"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned"),
        F.count(F.when(F.col("l_discount") == 0, 1)).alias("free"),
    )
    return per_part.select(
        "l_partkey",
        guarded_rate(F.col("price"), F.col("units"), 2).alias("per_unit"),
        guarded_rate(F.col("returned"), F.col("n"), 1, 100.0).alias("returned_pct"),
        guarded_rate(F.col("n"), F.col("free"), 2).alias("per_undiscounted"),
        clamp(F.col("n"), 2, 30).alias("clamped"),
    )


# --- standings --------------------------------------------------------------

MATCHES = """SELECT CAST(CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER) AS STRING) AS season, h.n_name AS home_team,
    a.n_name AS away_team, l_linenumber % 5 AS home_goals, CAST(FLOOR(l_quantity) AS INTEGER) % 4 AS away_goals
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
        JOIN {nation} h ON c_nationkey = h.n_nationkey JOIN {supplier} ON l_suppkey = s_suppkey
        JOIN {nation} a ON s_nationkey = a.n_nationkey WHERE h.n_nationkey <> a.n_nationkey"""
MATCH_TABLES = ("lineitem", "orders", "customer", "nation", "supplier")


@query(
    "standings",
    f"""SELECT ROW_NUMBER() OVER (PARTITION BY season ORDER BY 3 * W + D DESC, GF - GA DESC, GF DESC, team)::INTEGER AS Pos,
        season, team, P, W, D, L, GF, GA, GF - GA AS GD, 3 * W + D AS Pts
    FROM (SELECT season, team, COUNT(*) AS P, COUNT(*) FILTER (gf > ga) AS W, COUNT(*) FILTER (gf = ga) AS D,
            COUNT(*) FILTER (gf < ga) AS L, CAST(SUM(gf) AS BIGINT) AS GF, CAST(SUM(ga) AS BIGINT) AS GA
        FROM (SELECT season, home_team AS team, home_goals AS gf, away_goals AS ga FROM ({for_duckdb(MATCHES, *MATCH_TABLES)})
            UNION ALL SELECT season, away_team, away_goals, home_goals FROM ({for_duckdb(MATCHES, *MATCH_TABLES)}))
        GROUP BY 1, 2)""",
)
def _standings(spark, sf_dir):
    return standings(derive(spark, sf_dir, MATCHES, *MATCH_TABLES))


@query(
    "preview_limit",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def _preview_limit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])
