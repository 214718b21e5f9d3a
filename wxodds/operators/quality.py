"""Join side-operators, data-quality monitors and arbitrage analytics."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.functions.core import half_up_ratio, int_floor_div, round4, scaled_int
from wxodds.functions.market import location_key
from wxodds.operators.asof import asof_weather_join, forward_weather_join
from wxodds.operators.ingest import price_sum_raw
from wxodds.operators.ordered import lead_by_key

# ---------------------------------------------------------------------------
# Fixed values from the specification's monitoring targets.
# ---------------------------------------------------------------------------
JOIN_TOLERANCE_SECONDS = 15 * 60
PENDING_TTL_SECONDS = 24 * 3600
COVERAGE_TARGET_PCT = 95
COVERAGE_ALARM_PCT = 70
SILENCE_SECONDS = 10 * 60
LATENCY_PERCENTILE_PCT = 99
# ---------------------------------------------------------------------------


# ------------------------------------------------------------------ geo dimension

def geo_enrich(cities: DataFrame, geo: DataFrame) -> DataFrame:
    """City -> coordinates; cities without coordinates are skipped."""
    return cities.join(geo, "city", "inner").select("city", "lat", "lon")


def geo_missing(cities: DataFrame, geo: DataFrame) -> DataFrame:
    return cities.join(geo.select("city"), "city", "left_anti").select("city")


# ------------------------------------------------------------------ spec joins

def interval_weather_join(pred: DataFrame, wx: DataFrame,
                          tolerance_seconds: int = JOIN_TOLERANCE_SECONDS) -> DataFrame:
    """Event-time band join on city: weather within ±tolerance of the market poll.

    Both sides are bucketed by the tolerance; a weather row is copied to the (at most three)
    buckets its band touches, so every pair is found by one equi-join on (city, bucket)."""
    b_us = tolerance_seconds * 1_000_000
    w = wx.select(location_key(F.col("LOCATION_NAME")).alias("_wcity"),
                  F.col("POLL_TIMESTAMP").alias("w_poll"), F.col("data_type").alias("w_data_type"))
    wu = F.unix_micros(F.col("w_poll"))
    w = w.withColumn("_wb", F.explode(F.sequence(int_floor_div(wu - b_us, b_us), int_floor_div(wu + b_us, b_us))))
    p = (pred.withColumn("_city", location_key(F.col("LOCATION_NAME")))
         .withColumn("_b", int_floor_div(F.unix_micros(F.col("POLL_TIMESTAMP")), b_us)))
    tol = F.expr(f"INTERVAL {tolerance_seconds} SECONDS")
    cond = [p["_city"] == w["_wcity"], p["_b"] == w["_wb"],
            w["w_poll"] >= p["POLL_TIMESTAMP"] - tol, w["w_poll"] <= p["POLL_TIMESTAMP"] + tol]
    return p.join(w, cond, "inner").drop("_city", "_b", "_wcity", "_wb")


def pending_predictions(pred: DataFrame, wx: DataFrame,
                        ttl_seconds: int = PENDING_TTL_SECONDS) -> DataFrame:
    """Markets that found no weather at their poll time, resolved by the first weather of their
    city/class arriving within the TTL (resolved_by null = expired)."""
    unmatched = asof_weather_join(pred, wx, how="left").where(F.col("w_poll").isNull()) \
        .select(*pred.columns)
    fw = forward_weather_join(unmatched, wx, ttl_seconds)
    return fw.select("question_id", "POLL_TIMESTAMP", "resolved_by", "wait_seconds")


def join_coverage(pred: DataFrame, corr: DataFrame) -> DataFrame:
    """Share of predictions per city that produced a correlation; flags < 95 % and < 70 %."""
    p = pred.groupBy(location_key(F.col("LOCATION_NAME")).alias("LOCATION_NAME")).agg(
        F.count(F.lit(1)).alias("predictions"))
    c = corr.groupBy("LOCATION_NAME").agg(F.count(F.lit(1)).alias("matched"))
    j = p.join(c, "LOCATION_NAME", "left").withColumn("matched", F.coalesce(F.col("matched"), F.lit(0)))
    m, n = F.col("matched"), F.col("predictions")
    return j.select("LOCATION_NAME", "predictions", "matched",
                    half_up_ratio(m * 10_000, n, 10_000).alias("coverage"),
                    (m * 100 < n * COVERAGE_TARGET_PCT).alias("below_target"),
                    (m * 100 < n * COVERAGE_ALARM_PCT).alias("alarm"))


# ------------------------------------------------------------------ monitors

def dedup_keys(pred: DataFrame) -> DataFrame:
    """Batch form of the 1 h de-duplication: one row per (condition_id, POLL_TIMESTAMP), the one with
    the least question_id.  A repeat carries the poll time of its first delivery, so all repeats lie
    within the hour; a later poll has another time and is kept."""
    order = F.struct(F.coalesce("question_id", F.lit("")), F.xxhash64(F.to_json(F.struct(*pred.columns))))
    best = pred.groupBy("condition_id", "POLL_TIMESTAMP").agg(F.min_by(F.struct(*pred.columns), order).alias("_r"))
    return best.select("_r.*")


def producer_silence(pred: DataFrame, wx: DataFrame, silence_seconds: int = SILENCE_SECONDS) -> DataFrame:
    """Gaps longer than `silence_seconds` between consecutive polls of each feed."""
    feeds = (pred.select(F.lit("market").alias("feed"), F.col("POLL_TIMESTAMP").alias("ts"))
             .unionByName(wx.select(F.lit("weather").alias("feed"), F.col("POLL_TIMESTAMP").alias("ts")))
             .where(F.col("ts").isNotNull()).distinct())
    nxt = lead_by_key(feeds, ["feed"], "ts", [], ["ts"])
    gap = F.unix_seconds(F.col("next_ts")) - F.unix_seconds(F.col("ts"))
    return (nxt.where(gap > silence_seconds)
            .select("feed", F.col("ts").alias("gap_start"), F.col("next_ts").alias("gap_end"),
                    gap.alias("gap_seconds")))


def producer_silence_now(pred: DataFrame, wx: DataFrame, as_of, silence_seconds: int = SILENCE_SECONDS) -> DataFrame:
    """Live form: each feed's last poll, and whether it has been silent for too long at `as_of`."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    feeds = (pred.select(F.lit("market").alias("feed"), F.col("POLL_TIMESTAMP").alias("ts"))
             .unionByName(wx.select(F.lit("weather").alias("feed"), F.col("POLL_TIMESTAMP").alias("ts"))))
    silent = F.unix_seconds(now) - F.unix_seconds(F.col("last_poll"))
    return (feeds.groupBy("feed").agg(F.max("ts").alias("last_poll"))
            .select("feed", "last_poll", silent.alias("silent_seconds"), (silent > silence_seconds).alias("alarm")))


def latency_p99(corr: DataFrame, pct: int = LATENCY_PERCENTILE_PCT) -> DataFrame:
    """Exact nearest-rank p99 of poll->correlation latency per hour, via a latency histogram
    (per hour: one row per distinct latency), so no hour's rows are gathered in one place."""
    from pyspark.sql import Window
    hour = F.date_trunc("hour", "POLL_TIMESTAMP").alias("hour")
    hist = corr.groupBy(hour, F.col("CORRELATION_LATENCY_SEC").alias("lat")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("hour").orderBy("lat").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = (hist.withColumn("cum", F.sum("c").over(w))
         .withColumn("n", F.sum("c").over(Window.partitionBy("hour"))))
    return h.groupBy("hour").agg(
        F.max("n").alias("correlations"),
        F.min(F.when(F.col("cum") * 100 >= F.col("n") * pct, F.col("lat"))).alias("p99_latency_sec"),
        F.max("lat").alias("max_latency_sec"))


def dq_impossible_values(shaped: DataFrame) -> DataFrame:
    """Counts of impossible values before validation: negative odds, odds above 1, negative volume."""
    neg = F.exists("tokens", lambda t: t["price"] < 0)
    over = F.exists("tokens", lambda t: t["price"] > 1)
    agg = shaped.agg(
        F.sum(F.coalesce(neg, F.lit(False)).cast("long")).alias("negative_odds"),
        F.sum(F.coalesce(over, F.lit(False)).cast("long")).alias("odds_above_one"),
        F.sum((F.coalesce(F.col("volume"), F.lit(0.0)) < 0).cast("long")).alias("negative_volume"))
    return agg.unpivot([], ["negative_odds", "odds_above_one", "negative_volume"], "rule", "violations") \
        .withColumn("violations", F.coalesce(F.col("violations"), F.lit(0)).cast("long"))


# ------------------------------------------------------------------ arbitrage / leaderboard

def expected_profit(pred: DataFrame) -> DataFrame:
    """Flagged markets: margin implied by the odds sum s -- |1 - s| / s as % of stake;
    buy every outcome when s < 1, sell every outcome when s > 1."""
    s = price_sum_raw("tokens")
    d = pred.where(F.col("arbitrage_flag")).withColumn("_s", s).where(F.col("_s") > 0)
    return d.select("question_id", "condition_id", "POLL_TIMESTAMP",
                    F.col("price_sum"),
                    F.when(F.col("_s") < 1, F.lit("buy_all")).otherwise(F.lit("sell_all")).alias("side"),
                    round4(F.abs(1.0 - F.col("_s")) / F.col("_s") * 100.0).alias("expected_profit_pct"))


def market_leaderboard(corr: DataFrame, k: int = 10) -> DataFrame:
    """Most and least accurate markets by mean prediction error: those with one of the k best, and
    of the k worst, error values (ties are kept)."""
    per = corr.groupBy("condition_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(scaled_int(F.col("PREDICTION_ERROR"), 10_000)).alias("_err"),
        F.sum(((F.col("yes_price") > 0.5) == (F.col("ACTUAL_OUTCOME") == 1)).cast("long")).alias("hits"))
    per = per.withColumn("avg_error", half_up_ratio(F.col("_err"), F.col("n"), 10_000)).drop("_err")
    errors = per.select("avg_error").distinct()          # rounded: ten thousand values at most
    best = errors.orderBy(F.col("avg_error").asc()).limit(k).withColumn("board", F.lit("best"))
    worst = errors.orderBy(F.col("avg_error").desc()).limit(k).withColumn("board", F.lit("worst"))
    return per.join(best.unionByName(worst), "avg_error").select(*per.columns, "board")


def arbitrage_now(pred: DataFrame) -> DataFrame:
    """Latest poll of each market whose odds sum deviates from 1, with the implied margin."""
    last = pred.groupBy("condition_id").agg(
        F.max_by(F.struct("question_id", "POLL_TIMESTAMP", "price_sum", "arbitrage_flag", "tokens"),
                 F.struct("POLL_TIMESTAMP", "question_id")).alias("l"))
    latest = last.select("condition_id", "l.*")
    return expected_profit(latest)


def arbitrage_frequency(pred: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "POLL_TIMESTAMP").alias("hour")
    g = pred.groupBy(hour).agg(F.count(F.lit(1)).alias("polls"),
                               F.sum(F.col("arbitrage_flag").cast("long")).alias("arbitrage_polls"))
    return g.withColumn("arbitrage_share",
                        half_up_ratio(F.col("arbitrage_polls") * 10_000, F.col("polls"), 10_000))
