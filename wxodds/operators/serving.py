"""Serving queries over the three sink tables (dashboard panels and specified views).

`NOW()` of a panel is its `as_of` argument; without one it is the latest `inserted_at` of the table it
reads, a scalar subquery, so that results over a closed table are repeatable.  Averages of NUMERIC columns are formed from their exact
unscaled integers and rounded half away from zero, like SQL ROUND on NUMERIC.  Ordered top-k
panels add a key tie-break so that the k rows are well defined.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.functions.core import half_away_ratio, half_up_ratio, scaled_int

MIN_CITY_ROWS = 3


def _day() -> Column:
    return F.expr("INTERVAL 24 HOURS")


def _as_of(table: DataFrame, col: str, as_of) -> Column:
    """The panel's now: the caller's (a timestamp or column), else the table's latest `col`, as a scalar
    subquery of the panel's own plan."""
    if as_of is not None:
        return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return table.agg(F.max(col)).scalar()


def last_24h(table: DataFrame, as_of=None) -> DataFrame:
    return table.where(F.col("inserted_at") > _as_of(table, "inserted_at", as_of) - _day())


def _units(c: str, scale: int) -> Column:
    """Unscaled integer of a DECIMAL column with `scale` decimals."""
    return (F.col(c) * scale).cast("long")


def _avg3(c: str, scale: int) -> Column:
    """ROUND(AVG(decimal column), 3) from exact integer sums."""
    return half_away_ratio(F.sum(_units(c, scale)), F.count(F.col(c)) * (scale // 1000), 1000)


# ------------------------------------------------------------------ 14 panels

def p_total_correlations(corr_t: DataFrame) -> DataFrame:
    return corr_t.agg(F.count(F.lit(1)).alias("value"))


def p_alerts_24h(alerts_t: DataFrame, as_of=None) -> DataFrame:
    return last_24h(alerts_t, as_of).agg(F.count(F.lit(1)).alias("value"))


def p_avg_accuracy(acc_t: DataFrame, as_of=None) -> DataFrame:
    return last_24h(acc_t, as_of).agg(_avg3("accuracy_rate", 10_000).alias("value"))


def p_arbitrage_count(alerts_t: DataFrame) -> DataFrame:
    return alerts_t.where(F.col("alert_type") == "ARBITRAGE").agg(F.count(F.lit(1)).alias("value"))


def p_active_cities(corr_t: DataFrame, as_of=None) -> DataFrame:
    return last_24h(corr_t, as_of).agg(F.count_distinct("location_name").alias("value"))


def p_avg_error(corr_t: DataFrame, as_of=None) -> DataFrame:
    return last_24h(corr_t, as_of).agg(_avg3("prediction_error", 10_000).alias("value"))


def _by_city(acc_t: DataFrame, as_of) -> DataFrame:
    return (last_24h(acc_t, as_of).groupBy("location_name")
            .agg(_avg3("accuracy_rate", 10_000).alias("accuracy"),
                 _avg3("avg_prediction_error", 10_000).alias("avg_error"),
                 _avg3("bias_score", 10_000).alias("bias"),
                 F.sum("total_count").alias("total_markets"))
            .where(F.col("total_markets") >= MIN_CITY_ROWS))


def p_accuracy_by_city(acc_t: DataFrame, k: int = 20, as_of=None) -> DataFrame:
    return (_by_city(acc_t, as_of).orderBy(F.col("accuracy").desc(), "location_name").limit(k)
            .select("location_name", "accuracy"))


def p_error_by_city(acc_t: DataFrame, k: int = 20, as_of=None) -> DataFrame:
    return (_by_city(acc_t, as_of).orderBy(F.col("avg_error").desc(), "location_name").limit(k)
            .select("location_name", "avg_error"))


def p_city_leaderboard(acc_t: DataFrame, as_of=None) -> DataFrame:
    return (_by_city(acc_t, as_of).select("location_name", F.col("accuracy").alias("avg_accuracy"),
                                   "avg_error", "bias", "total_markets")
            .orderBy(F.col("avg_accuracy").desc(), "location_name"))


def p_recent_alerts(alerts_t: DataFrame, k: int = 50) -> DataFrame:
    return (alerts_t.orderBy(F.col("alert_timestamp").desc_nulls_last(), "alert_type", "location_name",
                             F.col("condition_id").asc_nulls_first(), "detail")
            .limit(k).select("alert_timestamp", "alert_type", "location_name", "detail"))


def p_high_error(corr_t: DataFrame, k: int = 100) -> DataFrame:
    def r(c, d):
        return F.round(F.col(c), d).cast("double")
    return (corr_t.where(F.col("prediction_error") > 0.7)
            .orderBy(F.col("poll_timestamp").desc(), "condition_id", "question").limit(k)
            .select("poll_timestamp", "location_name", "question", r("yes_price", 3).alias("yes_price"),
                    r("target_temp", 1).alias("target_c"), r("actual_temp", 1).alias("actual_c"),
                    "actual_outcome", r("prediction_error", 3).alias("pred_error"), "market_closed"))


def p_alert_types(alerts_t: DataFrame) -> DataFrame:
    return alerts_t.groupBy("alert_type").agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.col("count").desc(), "alert_type")


def p_data_type_split(corr_t: DataFrame) -> DataFrame:
    return corr_t.groupBy("data_type").agg(F.count(F.lit(1)).alias("count"))


def p_alerts_over_time(alerts_t: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """Alerts by hour and type in the `hours` up to `as_of`."""
    end = _as_of(alerts_t, "alert_timestamp", as_of)
    start = end - F.expr(f"INTERVAL {int(hours)} HOURS")
    t = alerts_t.where((F.col("alert_timestamp") >= start) & (F.col("alert_timestamp") <= end))
    return (t.groupBy(F.date_trunc("hour", "alert_timestamp").alias("time"),
                      F.col("alert_type").alias("metric"))
            .agg(F.count(F.lit(1)).alias("value")).orderBy("time", "metric"))


# ------------------------------------------------------------------ specified views

def v_accuracy_map(acc_t: DataFrame, corr_t: DataFrame, geo: DataFrame, as_of=None) -> DataFrame:
    """Per city with coordinates: latest window's accuracy and open markets seen in the last 24 h."""
    latest = acc_t.groupBy("location_name").agg(
        F.max_by(F.struct("window_end", "accuracy_rate"), F.col("window_end")).alias("l"))
    latest = latest.select("location_name", F.col("l.window_end").alias("window_end"),
                           F.col("l.accuracy_rate").cast("double").alias("accuracy_rate"))
    active = (last_24h(corr_t, as_of).where(~F.col("market_closed")).groupBy("location_name")
              .agg(F.count_distinct("condition_id").alias("active_markets")))
    g = geo.withColumnRenamed("city", "location_name")
    return (latest.join(active, "location_name", "left")
            .withColumn("active_markets", F.coalesce(F.col("active_markets"), F.lit(0)))
            .join(g, "location_name", "inner"))


def v_accuracy_24h_line(acc_t: DataFrame, as_of=None) -> DataFrame:
    """Overall accuracy across cities at each window end of the last 24 h."""
    g = last_24h(acc_t, as_of).groupBy("window_end").agg(
        F.count(F.lit(1)).alias("cities"), F.sum("total_count").alias("total"),
        F.sum("correct_count").alias("correct"))
    return g.withColumn("accuracy", half_up_ratio(F.col("correct") * 10_000, F.col("total"), 10_000))


def v_accuracy_trend_weekly(corr: DataFrame) -> DataFrame:
    g = corr.groupBy("LOCATION_NAME", F.date_trunc("week", "POLL_TIMESTAMP").alias("week")).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("ACTUAL_OUTCOME").cast("long")).alias("correct"),
        F.sum(scaled_int(F.col("PREDICTION_ERROR"), 10_000)).alias("_err"))
    return g.select("LOCATION_NAME", "week", "total", "correct",
                    half_up_ratio(F.col("correct") * 10_000, F.col("total"), 10_000).alias("accuracy"),
                    half_up_ratio(F.col("_err"), F.col("total"), 10_000).alias("avg_error"))


def v_heatmap(corr: DataFrame) -> DataFrame:
    """question type x city x day of week (1 = Sunday)."""
    g = corr.groupBy("question_type", "LOCATION_NAME", F.dayofweek("POLL_TIMESTAMP").alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("ACTUAL_OUTCOME").cast("long")).alias("correct"),
        F.sum(scaled_int(F.col("PREDICTION_ERROR"), 10_000)).alias("_err"))
    return g.select("question_type", "LOCATION_NAME", "day_of_week", "total", "correct",
                    half_up_ratio(F.col("correct") * 10_000, F.col("total"), 10_000).alias("accuracy"),
                    half_up_ratio(F.col("_err"), F.col("total"), 10_000).alias("avg_error"))


def v_bias_scatter(corr: DataFrame) -> DataFrame:
    """Calibration: price decile -> mean price and observed Yes rate."""
    g = corr.groupBy(F.floor(F.col("yes_price") * 10).alias("price_bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(scaled_int(F.col("yes_price"), 10_000)).alias("_p"),
        F.sum(F.col("ACTUAL_OUTCOME").cast("long")).alias("yes_outcomes"))
    return g.select("price_bucket", "n", "yes_outcomes",
                    half_up_ratio(F.col("_p"), F.col("n"), 10_000).alias("avg_price"),
                    half_up_ratio(F.col("yes_outcomes") * 10_000, F.col("n"), 10_000).alias("observed_rate"))


def v_volume_accuracy_corr(corr_ext: DataFrame) -> DataFrame:
    """Pearson correlation, over markets, of the traded volume (whole units, the largest seen) with the
    share of correct calls ((price > 0.5) == outcome).  Sums are exact decimals; rates are in 1e-4."""
    x = F.coalesce(F.col("volume"), F.lit(0.0)).cast("long")
    hit = ((F.col("yes_price") > 0.5) == (F.col("ACTUAL_OUTCOME") == 1)).cast("long")
    per = corr_ext.groupBy("condition_id").agg(F.max(x).alias("x"), F.sum(hit).alias("hits"), F.count(F.lit(1)).alias("calls"))
    d = lambda c: F.col(c).cast("decimal(19,0)")
    per = per.select("x", F.floor(F.col("hits") * 10_000 / F.col("calls") + 0.5).cast("long").alias("y"))
    s = per.agg(F.count(F.lit(1)).alias("n"), *[F.sum(e.cast("decimal(28,0)")).alias(k) for k, e in (
        ("sx", d("x")), ("sy", d("y")), ("sxy", d("x") * d("y")), ("sxx", d("x") * d("x")), ("syy", d("y") * d("y")))])
    f = {c: F.col(c).cast("double") for c in ["n", "sx", "sy", "sxy", "sxx", "syy"]}
    num = f["n"] * f["sxy"] - f["sx"] * f["sy"]
    den = F.sqrt((f["n"] * f["sxx"] - f["sx"] * f["sx"]) * (f["n"] * f["syy"] - f["sy"] * f["sy"]))
    return s.select("n", F.when(den > 0, num / den).alias("volume_accuracy_corr"))
