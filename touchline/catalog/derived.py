"""Bronze feeds derived from the driver's tables.

Each lineitem becomes a text row of a player feed: the part is the player, the
supplier's nation the club, the year the season. The same text serves Spark and
the SQL check but for the few expressions that `for_spark` and `for_duckdb`
spell out. In the texts a table stands as {table}.
"""

from __future__ import annotations

from touchline import config

YEAR = "CAST(EXTRACT(YEAR FROM l_shipdate) AS INTEGER)"
SEASON = f"""CASE WHEN l_orderkey % 89 = 5 THEN NULL
    WHEN l_orderkey % 83 = 5 THEN 'bad'
    WHEN l_linenumber = 7 THEN CAST({YEAR} AS STRING)
    WHEN l_linenumber = 6 THEN CAST({YEAR} AS STRING) || '-' || CAST({YEAR} AS STRING)
    ELSE CAST({YEAR} AS STRING) || '-' || CAST({YEAR} + 1 AS STRING) END"""
PLAYER = "p_name || ' ' || CAST(p_partkey AS STRING)"
POSITION = """CASE WHEN p_size % 17 = 3 THEN NULL WHEN p_size % 19 = 3 THEN '??'
    WHEN p_type = 'ECONOMY' THEN CASE WHEN p_size % 5 = 0 THEN ' gk ' ELSE 'GK' END
    WHEN p_type = 'LARGE' THEN 'DF (CB-FB, left)'
    WHEN p_type = 'MEDIUM' THEN 'DF,MF (DM, right)'
    WHEN p_type = 'PROMO' THEN 'mf,fw (AM-WM)'
    WHEN p_type = 'SMALL' THEN 'FW'
    ELSE CASE WHEN p_size % 7 = 0 THEN 'GK (x)' ELSE 'MF ()' END END"""
PRICE = "CAST(FLOOR(l_extendedprice) AS BIGINT)"


def _grouped(value: str) -> str:
    """A whole number with a comma before its last three digits."""
    return (
        f"CAST(CAST(FLOOR({value} / 1000) AS BIGINT) AS STRING) || ',' || "
        f"LPAD(CAST({value} % 1000 AS STRING), 3, '0')"
    )


def _int_text(i: int) -> str:
    """A varying whole number; some columns have gaps, junk or a '.0' tail."""
    text = f"CAST((l_orderkey * {i + 3} + l_partkey * 7 + l_linenumber) % {11 + i} AS STRING)"
    if i % 3 == 0:
        text = f"NULLIF({text}, '{i % 7}')"
    if i % 4 == 1:
        text += " || '.0'"
    if i % 5 == 0:
        text = f"CASE WHEN l_linenumber = {i % 7 + 1} THEN 'n.a.' ELSE {text} END"
    return text


def _double_text(i: int) -> str:
    """A varying number with two decimals; some columns have gaps or junk."""
    text = f"CAST((l_orderkey * {i + 2} + l_partkey) % {7 + i} AS STRING)"
    if i % 3 == 1:
        text = f"NULLIF({text}, '{i % 5}')"
    text += f" || '.{i + 10}'"
    if i % 6 == 0:
        text = f"CASE WHEN l_linenumber = {i % 7 + 1} THEN '-' ELSE {text} END"
    return text


def _players() -> str:
    stats = [f"{_int_text(i)} AS {c}" for i, c in enumerate(config.PLAYER_INTS)]
    stats += [f"{_double_text(i)} AS {c}" for i, c in enumerate(config.PLAYER_DOUBLES)]
    weekly = _grouped(PRICE)
    return f"""SELECT
    CASE WHEN l_orderkey % 97 = 5 THEN NULL ELSE {PLAYER} END AS player_name,
    {POSITION} AS player_position,
    CASE WHEN p_size % 2 = 0 THEN 'Right' ELSE 'Left' END AS preferred_foot,
    p_brand AS national_team,
    p_brand || ' FC' AS current_club,
    'raw/' || n_name || '/' || CAST(p_partkey AS STRING) || '.csv' AS _source_file,
    {SEASON} AS season,
    n_name || CASE WHEN s_suppkey % 3 = 0 THEN ' B' ELSE '' END AS club,
    n_name || ' esp ' AS club_country,
    CAST(n_regionkey + 1 AS STRING) || '. League ' || CAST(n_regionkey AS STRING) AS competition,
    CAST(l_linenumber AS STRING) || 'th' AS league_rank,
    CASE WHEN l_linenumber = 5 THEN '2028' ELSE MONTH_YEAR(l_shipdate) END AS contract_expiry,
    CASE WHEN l_linenumber = 4 THEN {weekly}
        ELSE '£ ' || {weekly} || ' (€ ' || {weekly} || ', $' || CAST(p_size AS STRING) || ')' END AS weekly_salary,
    CASE WHEN l_linenumber = 3 THEN '€ ' || {weekly} WHEN l_linenumber = 4 THEN '£ 3,000,000,000' ELSE '£' || {weekly} END AS annual_salary,
    {", ".join(stats)}
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey
    JOIN {{supplier}} ON l_suppkey = s_suppkey JOIN {{nation}} ON s_nationkey = n_nationkey"""


def _market() -> str:
    return f"""SELECT
    CASE WHEN l_orderkey % 53 = 5 THEN NULL
        WHEN p_size % 4 = 0 THEN REPLACE({PLAYER}, 'l', '')
        WHEN p_size % 4 = 1 THEN TRANSLATE({PLAYER}, 'aeio', 'áéíó')
        ELSE {PLAYER} END AS player_name,
    CAST(p_partkey AS STRING) AS player_id,
    p_type AS league,
    CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 3 = 0 THEN LOWER(p_brand) || ' fc'
        WHEN p_size % 5 = 0 THEN p_brand || ' United' ELSE p_brand || ' FC' END AS club,
    CASE WHEN l_orderkey % 41 = 5 THEN 'unknown' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS date,
    CAST(17 + l_linenumber AS STRING) || '.0' AS age,
    CAST({PRICE} AS STRING) || '.5' AS market_value_eur,
    {SEASON} AS season,
    'values.csv' AS _source_file,
    l_shipdate AS _load_timestamp
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey"""


BRONZE_PLAYERS = _players()
BRONZE_MARKET = _market()


def for_spark(sql: str) -> str:
    return sql.replace("MONTH_YEAR(l_shipdate)", "DATE_FORMAT(l_shipdate, 'MMMM yyyy')").replace(
        "MONTH_YEAR(o_orderdate)", "DATE_FORMAT(o_orderdate, 'MMMM yyyy')"
    )


def for_duckdb(sql: str, *tables: str) -> str:
    for t in tables or ("lineitem", "part", "supplier", "nation"):
        sql = sql.replace("{" + t + "}", t)
    return sql.replace("MONTH_YEAR(l_shipdate)", "STRFTIME(l_shipdate, '%B %Y')").replace(
        "MONTH_YEAR(o_orderdate)", "STRFTIME(o_orderdate, '%B %Y')"
    )
