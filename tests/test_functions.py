import random
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from touchline.functions.casting import tolerant_date, tolerant_int
from touchline.functions.jaro import jaro_winkler, similarity_points
from touchline.functions.numbers import cosine, guarded_rate
from touchline.functions.text import (
    clean_name, parse_season, position_details, primary_position, secondary_position,
)
from touchline.plans.silver import competition_name, country_code, digits, money


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "c string").select(fn(F.col("c")).alias("r"))
    return df.first()["r"]


@pytest.mark.parametrize(
    "text, want", [("12", 12), ("12.0", 12), ("12.7", 13), ("abc", None), ("", None), (None, None), ("-3.5", -4)]
)
def test_tolerant_int(spark, text, want):
    assert one(spark, text, tolerant_int) == want


def test_dates(spark):
    assert one(spark, "June 2027", lambda c: tolerant_date(c, "MMMM yyyy")) == date(2027, 6, 1)
    assert one(spark, "2028", lambda c: tolerant_date(c, "MMMM yyyy")) is None


@pytest.mark.parametrize(
    "text, key, single",
    [("2023-2024", "20232024", 0), ("2023", "2023", 1), ("2023-2023", "2023", 1), ("bad", None, 0)],
)
def test_season(spark, text, key, single):
    season = one(spark, text, parse_season)
    assert (season["season_key"], season["is_single_year"]) == (key, single)


@pytest.mark.parametrize(
    "text, first, second, details",
    [
        ("GK", "GK", None, None),
        (" gk ", "GK", None, None),
        ("DF (CB-FB, left)", "DF", None, "CB|FB|LEFT"),
        ("DF,MF", "DF", "MF", None),
        ("MF,FW", "MF", "FW", None),
        ("??", "UNKNOWN", None, None),
        (None, "UNKNOWN", None, None),
    ],
)
def test_positions(spark, text, first, second, details):
    assert one(spark, text, primary_position) == first
    assert one(spark, text, secondary_position) == second
    assert one(spark, text, position_details) == details


def test_names_and_silver_text(spark):
    assert one(spark, "Éder Militão", clean_name) == "der militao"
    assert one(spark, "François", clean_name) == "franaois"
    assert one(spark, "O'Brien", clean_name) == "obrien"
    assert one(spark, "Spain", country_code) == "AIN"
    assert one(spark, "1. La Liga", competition_name) == "La Liga"
    assert one(spark, "3rd", digits) == 3
    salary = "£ 1,234 (€ 1,400, $1,500)"
    assert [one(spark, salary, lambda c, s=s: money(c, s)) for s in "£€$"] == [1234, 1400, 1500]
    assert one(spark, "1234", lambda c: money(c, "£")) is None


def test_similarity_points_equal_sql(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcde ") for _ in range(rng.randint(0, 9))) for _ in range(400)]
    pairs = [(rng.choice(words), rng.choice(words)) for _ in range(3000)]
    con = duckdb.connect()
    con.execute("CREATE TABLE p (i INT, a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [(i, *p) for i, p in enumerate(pairs)])
    want = con.execute(
        "SELECT FLOOR(100.0::DOUBLE * JARO_WINKLER_SIMILARITY(a, b) + 0.5::DOUBLE)::INT FROM p ORDER BY i"
    ).fetchall()
    assert [similarity_points(a, b) for a, b in pairs] == [w[0] for w in want]
    df = spark.createDataFrame(pairs[:50], "a string, b string")
    got = [r[0] for r in df.select(jaro_winkler("a", "b")).collect()]
    assert got == [w[0] for w in want[:50]]


def test_rates_and_cosine(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (1.0, None)], "n double, d double")
    rates = [r[0] for r in df.select(guarded_rate(F.col("n"), F.col("d"), 2)).collect()]
    assert rates == [0.33, 0.0, 0.0]
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([0.5**0.5, 0.0])
