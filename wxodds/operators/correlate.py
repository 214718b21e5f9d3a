"""Scoring of matched (market, weather) pairs into Correlation records."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.functions.core import int_floor_div, round4
from wxodds.functions.market import (
    comparison, compute_outcome, lower_text, question_type, target_temp, yes_price, yes_winner,
)
from wxodds.operators.asof import asof_weather_join
from wxodds.schemas import CORR_COLUMNS

# ---------------------------------------------------------------------------
# Weather records of an unknown type only count when they are
# less than 16 minutes (toMinutes() > 15 is stale) from the market poll.
# ---------------------------------------------------------------------------
KNOWN_WEATHER_TYPES = ["forecast", "historical"]
LEGACY_MAX_AGE_SECONDS = 960
# ---------------------------------------------------------------------------


def _not_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def actual_temp(qtype: Column) -> Column:
    """HIGHEST -> daily max, LOWEST -> daily min, EXACT -> current else daily max;
    unknown record types use the current temperature."""
    known = F.coalesce(F.col("w_data_type"), F.lit("current")).isin(*KNOWN_WEATHER_TYPES)
    cur, mx, mn = (_not_nan(F.col("w_current_temp")), _not_nan(F.col("w_daily_max")),
                   _not_nan(F.col("w_daily_min")))
    by_type = (F.when(qtype == "HIGHEST", mx).when(qtype == "LOWEST", mn)
               .otherwise(F.coalesce(cur, mx)))
    return F.when(known, by_type).otherwise(cur)


def legacy_fresh(as_of: Column) -> Column:
    """True for known types; for legacy records, poll time within 16 minutes of `as_of`."""
    known = F.coalesce(F.col("w_data_type"), F.lit("current")).isin(*KNOWN_WEATHER_TYPES)
    age = F.abs(F.unix_micros(F.col("w_poll")) - F.unix_micros(as_of))
    return known | F.col("w_poll").isNull() | (age < LEGACY_MAX_AGE_SECONDS * 1_000_000)


def latency_seconds(market_ts: Column, weather_ts: Column) -> Column:
    """|whole seconds| between the two polls (floor of the signed difference), 0 when missing."""
    diff = int_floor_div(F.unix_micros(weather_ts) - F.unix_micros(market_ts), 1_000_000)
    return F.coalesce(F.abs(diff), F.lit(0)).cast("long")


def market_features(markets: DataFrame) -> DataFrame:
    """What scoring reads off a market's own row.  Added before the market meets its weather, since a condition
    on the pairs would repeat the parsing of the question wherever it names one of these columns."""
    d = markets
    if "_yes_p" not in d.columns:          # token features, unless precomputed (streaming)
        d = d.withColumn("_yes_p", yes_price(F.col("tokens"))).withColumn("_yes_win", yes_winner(F.col("tokens")))
    return d.withColumn("_lower", lower_text("question")).withColumns({
        "_qt": question_type("question", "_lower"), "_cmp": comparison("question", "_lower"),
        "_target": target_temp("question")}).drop("_lower")


def score_pairs(pairs: DataFrame, keep_extra: bool = False) -> DataFrame:
    """Matched pairs -> Correlation rows; pairs without a usable actual or target are dropped."""
    closed = F.coalesce(F.col("closed"), F.lit(False))
    d = pairs if "_qt" in pairs.columns else market_features(pairs)
    d = (d.withColumn("_actual", actual_temp(F.col("_qt")))
         .where(F.col("_actual").isNotNull() & F.col("_target").isNotNull()
                & legacy_fresh(F.col("POLL_TIMESTAMP"))))
    computed = compute_outcome("question", "_actual", "_target", "_cmp")
    outcome = F.when(closed, F.coalesce(F.col("_yes_win"), computed)).otherwise(computed)
    d = d.withColumn("_yes", F.col("_yes_p")).withColumn("_out", outcome.cast("int"))
    cols = [
        F.coalesce(F.col("condition_id"), F.lit("null")).alias("condition_id"),
        F.col("question"), F.col("_qt").alias("question_type"),
        F.coalesce(F.col("LOCATION_NAME"), F.lit("null")).alias("LOCATION_NAME"),
        F.col("_yes").alias("yes_price"), F.col("_target").alias("target_temp"),
        F.col("_actual").alias("actual_temp"),
        F.coalesce(F.col("w_data_type"), F.lit("current")).alias("data_type"),
        closed.alias("market_closed"), F.col("_out").alias("ACTUAL_OUTCOME"),
        round4(F.abs(F.col("_yes") - F.col("_out"))).alias("PREDICTION_ERROR"),
        latency_seconds(F.col("POLL_TIMESTAMP"), F.col("w_poll")).alias("CORRELATION_LATENCY_SEC"),
        F.coalesce(F.col("arbitrage_flag"), F.lit(False)).alias("arbitrage_flag"),
        F.col("POLL_TIMESTAMP"),
    ]
    if keep_extra:
        cols += [F.col("volume"), F.col("price_sum"), F.col("question_id")]
    return d.select(*cols)


def correlate(pred: DataFrame, wx: DataFrame, match: str = "city", keep_extra: bool = False,
              **join_opts) -> DataFrame:
    """pred x latest weather -> Correlation stream (CorrelationJob equivalent)."""
    return score_pairs(asof_weather_join(market_features(pred), wx, match=match, **join_opts), keep_extra)


def shape_correlation(corr: DataFrame) -> DataFrame:
    return corr.select(*CORR_COLUMNS)
