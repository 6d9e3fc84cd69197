"""Bronze text to typed, deduplicated silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline import config
from touchline.functions.casting import (
    extract_or_null,
    tolerant_date,
    tolerant_double,
    tolerant_int,
)
from touchline.operators.rows import dedup_max, may_repeat, repeat_marks, typed_projection

PLAYER_KEYS = ["player_name", "season", "club", "competition"]


def country_code(c: Column) -> Column:
    return F.upper(F.right(F.trim(c), F.lit(3)))


def competition_name(c: Column) -> Column:
    """Without a leading ordinal such as '1. '."""
    return F.trim(F.regexp_replace(c, r"^[0-9]+\.\s*", ""))


def digits(c: Column) -> Column:
    return tolerant_int(F.regexp_replace(c, "[^0-9]", ""))


def money(c: Column, sign: str) -> Column:
    """The first amount behind a currency sign."""
    sign = "\\" + sign if sign == "$" else sign
    amount = extract_or_null(c, sign + r"[\s]?([0-9,]+)")
    return tolerant_int(F.replace(amount, F.lit(","), F.lit("")), "bigint")


def player_spec() -> dict[str, Column]:
    text = {c: F.col(c) for c in ("player_name", "season", "club", *config.PLAYER_TEXT)}
    return {
        **text,
        "competition": competition_name(F.col("competition")),
        "_source_file": F.col("_source_file"),
        "club_country": country_code(F.col("club_country")),
        "league_rank": digits(F.col("league_rank")),
        "contract_expiry": tolerant_date(F.col("contract_expiry"), "MMMM yyyy"),
        **{
            f"{period}_salary_{code}": money(F.col(f"{period}_salary"), sign)
            for period in ("weekly", "annual")
            for code, sign in config.SALARY_CURRENCIES.items()
        },
        **{c: tolerant_int(F.col(c)) for c in config.PLAYER_INTS},
        **{c: tolerant_double(F.col(c)) for c in config.PLAYER_DOUBLES},
    }


_REQUIRED = ("player_name", "season")


def _key_columns() -> list[Column]:
    spec = player_spec()
    return [spec[k] for k in PLAYER_KEYS]


def repeated_players(bronze: DataFrame) -> DataFrame:
    """Marks of the keys of `stg_players` that come more than once."""
    for name in _REQUIRED:
        bronze = bronze.where(F.col(name).isNotNull())
    return repeat_marks(bronze, _key_columns())


def stg_players(bronze: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """One row per player, season, club and competition. With marks of keys that come again
    (`repeated_players` of the same feed) the wide rows of all others stay where they are."""

    def typed(rows: DataFrame) -> DataFrame:
        return typed_projection(rows, player_spec(), required=_REQUIRED)

    if repeated is None:
        return dedup_max(typed(bronze), PLAYER_KEYS)
    again = may_repeat(repeated, _key_columns())
    merged = dedup_max(typed(bronze.where(again)), PLAYER_KEYS)
    return typed(bronze.where(~again)).select(*merged.columns).unionByName(merged)


def stg_market_values(bronze: DataFrame, loaded_at: str = "_load_timestamp") -> DataFrame:
    """Valuations, typed and not deduplicated."""
    spec = {
        "player_name": F.col("player_name"),
        "player_id": tolerant_int(F.col("player_id"), "bigint"),
        "league": F.col("league"),
        "club": F.col("club"),
        "valuation_date": tolerant_date(F.col("date"), "yyyy-MM-dd"),
        "age": tolerant_int(F.col("age")),
        "market_value_eur": tolerant_double(F.col("market_value_eur")),
        "season": F.col("season"),
        "_source_file": F.col("_source_file"),
        "_load_timestamp": F.col(loaded_at),
    }
    return typed_projection(bronze, spec, required=("player_name",))
