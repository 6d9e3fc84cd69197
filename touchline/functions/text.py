"""Keys, seasons, positions and names out of free text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from touchline import config
from touchline.functions.casting import extract_or_null, tolerant_int


def surrogate_key(c: Column) -> Column:
    return F.md5(F.upper(F.trim(c)))


def parse_season(season: Column) -> Column:
    """Struct of key, start year, end year and single-year flag.

    '2023-2024' keys as 20232024, '2023' and '2023-2023' as 2023.
    """
    start = tolerant_int(F.split_part(season, F.lit("-"), F.lit(1)))
    second = tolerant_int(F.split_part(season, F.lit("-"), F.lit(2)))
    end = F.when(season.contains("-"), second).otherwise(start)
    spans_two = F.coalesce(start != end, F.lit(False))
    key = F.when(spans_two, F.concat(start.cast("string"), end.cast("string"))).otherwise(
        start.cast("string")
    )
    return F.struct(
        key.alias("season_key"),
        start.alias("season_start_year"),
        end.alias("season_end_year"),
        F.when(start == end, 1).otherwise(0).alias("is_single_year"),
    )


def season_digits(season: Column) -> Column:
    """'2023-2024' as the number 20232024; null where that is no number."""
    return F.replace(season, F.lit("-"), F.lit("")).try_cast("bigint")


def position_text(c: Column) -> Column:
    return F.upper(F.trim(c))


def is_goalkeeper(c: Column) -> Column:
    """Exactly the keeper code; null stays null, so both pools drop it."""
    return position_text(c) == "GK"


def _first_listed(text: Column, codes: tuple[str, ...]) -> Column:
    expr = F
    for code in codes:
        expr = expr.when(text.contains(code), code)
    return expr


def primary_position(c: Column) -> Column:
    return _first_listed(position_text(c), ("GK", "DF", "MF", "FW")).otherwise("UNKNOWN")


def secondary_position(c: Column) -> Column:
    """The more advanced of two listed roles, for outfield players with two."""
    text = position_text(c)
    back, middle, front = (text.contains(code) for code in ("DF", "MF", "FW"))
    return (
        F.when(text.contains("GK"), F.lit(None).cast("string"))
        .when(back & middle, "MF")
        .when((back | middle) & front, "FW")
    )


def position_details(c: Column) -> Column:
    """The bracketed part as a bar-separated list without blanks."""
    inner = extract_or_null(position_text(c), r"\((.*?)\)")
    return F.nullif(F.regexp_replace(F.regexp_replace(inner, "[,-]", "|"), " ", ""), F.lit(""))


def clean_name(
    c: Column, accents: str = config.NAME_ACCENTS, plain: str = config.NAME_PLAIN
) -> Column:
    """Lower-case ASCII form. Accents are mapped before lowering, so an upper-case
    accented letter is dropped, as the matching rules expect."""
    return F.lower(F.regexp_replace(F.translate(c, accents, plain), "[^A-Za-z0-9 ]", ""))


def routed_model(position: Column) -> Column:
    """Which model scores a position."""
    return _first_listed(F.upper(position), ("GK", "FW", "DF", "MF")).otherwise(
        config.DEFAULT_GROUP
    )


def weight_group(position: Column) -> Column:
    """Which weight row applies; anything but a plain role takes the default."""
    role = F.upper(position)
    return F.when(role.isin(*config.POSITION_WEIGHTS), role).otherwise(config.DEFAULT_GROUP)
