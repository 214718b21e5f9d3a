"""Golden rows for the scalar functions and the quirks they must keep."""
import pytest
from pyspark.sql import functions as F

from wxodds.functions.core import fixed_text, half_up_ratio, round4
from wxodds.functions.market import (
    compute_outcome, is_weather_text, parse_city, question_type, target_temp, yes_price, yes_winner,
)
from wxodds.operators import correlate


def one(spark, col, **cols):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(col.alias("x")).first()
    return row["x"]


@pytest.mark.parametrize("q,city", [
    ("Will the lowest temperature in Tokyo be 18°C on June 3?", "Tokyo"),
    ("Will the highest temperature in New York City be 71°F or below on June 10?", "New York City"),
    ("Will the lowest temperature in New York City be between 70-71°F on June 11?", "New York City"),
    ("Will it rain in St. Louis on June 3?", None),
    ("Will the highest temperature in São Paulo be 30°C?", None),
    ("Highest temperature in Chengdu?", "Chengdu"),
])
def test_parse_city(spark, q, city):
    assert one(spark, parse_city(F.col("q"), F.col("t")), q=q, t="") == city


def test_parse_city_falls_back_to_title(spark):
    assert one(spark, parse_city(F.col("q"), F.col("t")), q="Will it be hot?", t="Temperature in Denver") == "Denver"


@pytest.mark.parametrize("q,expected", [
    ("Will the lowest temperature in New York City be between 70-71°F on June 11?", (71 - 32) * 5.0 / 9.0),
    ("Will it be -5°C in Warsaw?", 5.0),
    ("Will it rain on June 10 Chicago?", 10.0),
    ("Will the temperature in Tokyo be 18°C?", 18.0),
    ("Will it rain in Tokyo?", None),
])
def test_target_temp(spark, q, expected):
    assert one(spark, target_temp(F.col("q")), q=q) == expected


@pytest.mark.parametrize("q,t", [
    ("Will the highest temperature in Paris be 20°C?", "HIGHEST"),
    ("Maximum temperature in Paris", "HIGHEST"),
    ("Will the lowest temperature in Paris be 3°C?", "LOWEST"),
    ("Will the temperature in Paris be 20°C?", "EXACT"),
])
def test_question_type(spark, q, t):
    assert one(spark, question_type(F.col("q")), q=q) == t


@pytest.mark.parametrize("q,actual,target,out", [
    ("Will it be 20°C or above?", 20.5, 20.0, True),
    ("Will it be 20°C or above?", 20.0, 20.0, False),          # strict
    ("Will it be 20°C or below?", 19.0, 20.0, True),
    ("Will it be 20°C or higher?", 21.0, 20.0, True),          # not a comparison word: within ±1
    ("Will it be 20°C or higher?", 21.5, 20.0, False),
    ("Will the temperature in Sunderland be 20°C?", 19.0, 20.0, True),   # 'under' -> strict below
    ("Will the temperature in Sunderland be 20°C?", 20.5, 20.0, False),
])
def test_compute_outcome(spark, q, actual, target, out):
    assert one(spark, compute_outcome(F.col("q"), F.col("a"), F.col("t")), q=q, a=actual, t=target) is out


def test_yes_price_and_winner(spark):
    toks = spark.sql("""SELECT array(named_struct('outcome','No','price',0.4D,'winner',false),
                                      named_struct('outcome','YES','price',0.6D,'winner',true)) AS t,
                               array(named_struct('outcome','A','price',0.4D,'winner',CAST(NULL AS BOOLEAN))) AS u""")
    r = toks.select(yes_price(F.col("t")).alias("p"), yes_winner(F.col("t")).alias("w"),
                    yes_price(F.col("u")).alias("p0"), yes_winner(F.col("u")).alias("w0")).first()
    assert (r.p, r.w, r.p0, r.w0) == (0.6, True, 0.0, None)


def test_round4_is_half_toward_positive_infinity(spark):
    assert one(spark, round4(F.col("x")), x=-0.00025) == -0.0002
    assert one(spark, round4(F.col("x")), x=0.00025) == 0.0003
    assert one(spark, half_up_ratio(F.col("n"), F.col("d"), 10000), n=5, d=2) == 0.0003


def test_fixed_text_matches_jvm_formatting(spark):
    assert one(spark, fixed_text(F.col("x"), 1), x=45.25) == "45.3"
    assert one(spark, fixed_text(F.col("x"), 3), x=0.9995) == "1.000"


def test_keyword_filter(spark):
    assert one(spark, is_weather_text(F.col("q")), q="Will it SNOW?") is True
    assert one(spark, is_weather_text(F.col("q")), q="Will the home side win?") is False


GOLDEN = [
    # question, yes, closed, actual (daily min / max / current), expected type, outcome, error
    ("Will the lowest temperature in Tokyo be 18°C on June 3?", 0.037, False, 19.1, "LOWEST", 0, 0.037),
    ("Will the highest temperature in New York City be 71°F or below on June 10?", 0.5, True, 29.2, "HIGHEST", 0, 0.5),
    ("Will the temperature in Chengdu be 31°C on June 3?", 0.001, False, 31.1, "EXACT", 1, 0.999),
]


@pytest.mark.parametrize("q,yes,closed,actual,qt,out,err", GOLDEN)
def test_golden_rows(spark, q, yes, closed, actual, qt, out, err):
    pairs = spark.sql(f"""
      SELECT 'c1' AS condition_id, '{q}' AS question, {str(closed).lower()} AS closed,
             array(named_struct('outcome','Yes','price',{yes}D,'winner',CAST(NULL AS BOOLEAN)),
                   named_struct('outcome','No','price',{1 - yes}D,'winner',CAST(NULL AS BOOLEAN))) AS tokens,
             'X' AS LOCATION_NAME, TIMESTAMP'2024-06-03 12:00:00' AS POLL_TIMESTAMP, false AS arbitrage_flag,
             '{'historical' if closed else 'forecast'}' AS w_data_type, {actual}D AS w_current_temp,
             {actual}D AS w_daily_max, {actual}D AS w_daily_min, TIMESTAMP'2024-06-03 11:55:00' AS w_poll""")
    r = correlate.score_pairs(pairs).first()
    assert r.question_type == qt and r.ACTUAL_OUTCOME == out and r.PREDICTION_ERROR == err
    assert r.CORRELATION_LATENCY_SEC == 300
    if "71°F" in q:
        assert round(r.target_temp, 2) == 21.67
