"""Alert rules over accuracy windows and correlations.

Accuracy rules run per city in window_end order over windows with at least 3 rows:
  ACCURACY_DROP     previous rate - current rate > 0.20
  ACCURACY_ANOMALY  n >= 10, sigma > 0.01 and |rate - mean| > 2 sigma, where n, mean and the
                    sample sigma are the running baseline *including* the current window.
The baseline is computed from running integer sums (n, sum r, sum r^2 with r = rate * 1e4), so it
is exact; the per-city running frame is evaluated block-wise (see ordered.py).
Correlation rules: ARBITRAGE (flagged price sum) and HIGH_ERROR (error > 0.70).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.functions.core import fixed_text, scaled_int
from wxodds.operators.accuracy import valid_location
from wxodds.operators.ordered import range_frame_by_key, scan_by_key

# ---------------------------------------------------------------------------
# Thresholds and message formats of the four alert rules.
# ---------------------------------------------------------------------------
MIN_WINDOW_ROWS = 3
DROP_THRESHOLD = 0.20
ANOMALY_MIN_POINTS = 10
ANOMALY_MIN_SIGMA = 0.01
ANOMALY_SIGMAS = 2.0
HIGH_ERROR_THRESHOLD = 0.70
WIDE = "decimal(19, 0)"              # holds any long; products of two take 38 digits, where longs overflow
DROP_TEXT = "accuracy dropped {prev}% → {cur}% (delta={delta}%)"
ANOMALY_TEXT = "accuracy={cur}% deviates >2σ from baseline mean={mean}% σ={sigma}"
ARBITRAGE_TEXT = "price sum != 1.0 | question: {question}"
HIGH_ERROR_TEXT = "prediction_error={err} yes_price={yes} target={target}°C actual={actual}°C"
# ---------------------------------------------------------------------------


def _text(template: str, **parts: Column) -> Column:
    """Fill a {name} template with columns (no format parsing at run time)."""
    pieces, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            pieces.append(F.lit(head))
        pieces.append(parts[name])
    if rest:
        pieces.append(F.lit(rest))
    return F.concat(*pieces)


def min_sample_filter(acc: DataFrame) -> DataFrame:
    return acc.where(valid_location() & F.col("accuracy_rate").isNotNull()
                     & ~F.isnan("accuracy_rate") & (F.col("total_count") >= MIN_WINDOW_ROWS))


def running_baseline(acc: DataFrame) -> DataFrame:
    """Adds baseline_n, baseline_mean, baseline_sigma (sample) and prev_accuracy_rate per city."""
    a = min_sample_filter(acc).withColumn("_r", scaled_int(F.col("accuracy_rate"), 10_000))
    a = scan_by_key(a, ["LOCATION_NAME"], "window_end", ["window_start"],
                    {"baseline_n": F.lit(1).cast("long"), "_s1": F.col("_r"),
                     "_s2": F.col("_r") * F.col("_r")}, lags=["accuracy_rate"])
    return baseline_columns(a)


def baseline_columns(a: DataFrame) -> DataFrame:
    """Mean and sample sigma from the running integer sums (baseline_n, _s1, _s2)."""
    n = F.col("baseline_n")
    wide_n, wide_s1, wide_s2 = (F.col(c).cast(WIDE) for c in ("baseline_n", "_s1", "_s2"))
    var_num = (wide_n * wide_s2 - wide_s1 * wide_s1).cast("double")   # exact before the cast, in 1e-8 units * n^2
    sigma_r = F.when(n >= 2, F.sqrt(var_num / (n * (n - 1)))).otherwise(F.lit(0.0))
    return (a.withColumn("_mean_r", F.col("_s1") / n).withColumn("_sigma_r", sigma_r)
            .withColumn("baseline_mean", F.col("_mean_r") / 10_000.0)
            .withColumn("baseline_sigma", F.col("_sigma_r") / 10_000.0))


def _acc_alert(df: DataFrame, alert_type: str, detail: Column) -> DataFrame:
    return df.select(F.lit(alert_type).alias("alert_type"), "LOCATION_NAME",
                     F.lit(None).cast("string").alias("condition_id"), detail.alias("detail"),
                     F.col("window_end").alias("POLL_TIMESTAMP"),
                     F.col("window_end").alias("ALERT_TIMESTAMP"))


def _drop_rule() -> tuple[Column, Column]:
    prev, cur = F.col("prev_accuracy_rate"), F.col("accuracy_rate")
    hit = prev.isNotNull() & ((prev - cur) > DROP_THRESHOLD)
    detail = _text(DROP_TEXT, prev=fixed_text(prev * 100, 1), cur=fixed_text(cur * 100, 1),
                   delta=fixed_text((prev - cur) * 100, 1))
    return hit, detail


def _anomaly_rule() -> tuple[Column, Column]:
    r = scaled_int(F.col("accuracy_rate"), 10_000)
    hit = ((F.col("baseline_n") >= ANOMALY_MIN_POINTS)
           & (F.col("_sigma_r") > ANOMALY_MIN_SIGMA * 10_000)
           & (F.abs(r - F.col("_mean_r")) > ANOMALY_SIGMAS * F.col("_sigma_r")))
    detail = _text(ANOMALY_TEXT, cur=fixed_text(F.col("accuracy_rate") * 100, 1),
                   mean=fixed_text(F.col("_mean_r") / 100.0, 1),
                   sigma=fixed_text(F.col("baseline_sigma"), 3))
    return hit, detail


def alert_accuracy_drop(base: DataFrame) -> DataFrame:
    hit, detail = _drop_rule()
    return _acc_alert(base.where(hit), "ACCURACY_DROP", detail)


def alert_accuracy_anomaly(base: DataFrame) -> DataFrame:
    hit, detail = _anomaly_rule()
    return _acc_alert(base.where(hit), "ACCURACY_ANOMALY", detail)


def _fan_out(df: DataFrame, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """Evaluate several rules in one pass over df: each row yields one alert per rule it hits."""
    hits = F.array_compact(F.array(*[
        F.when(hit, F.struct(F.lit(name).alias("alert_type"), detail.alias("detail")))
        for name, hit, detail in rules]))
    return df.withColumn("_a", F.explode(hits)).withColumn("alert_type", F.col("_a.alert_type")) \
        .withColumn("detail", F.col("_a.detail")).drop("_a")


def accuracy_alerts(acc: DataFrame) -> DataFrame:
    """ACCURACY_DROP and ACCURACY_ANOMALY from one baseline pass."""
    return accuracy_alerts_from_baseline(running_baseline(acc))


def accuracy_alerts_from_baseline(base: DataFrame) -> DataFrame:
    f = _fan_out(base, [("ACCURACY_DROP", *_drop_rule()), ("ACCURACY_ANOMALY", *_anomaly_rule())])
    return f.select("alert_type", "LOCATION_NAME", F.lit(None).cast("string").alias("condition_id"),
                    "detail", F.col("window_end").alias("POLL_TIMESTAMP"),
                    F.col("window_end").alias("ALERT_TIMESTAMP"))


def _corr_alert(df: DataFrame, alert_type: str, detail: Column) -> DataFrame:
    return df.select(F.lit(alert_type).alias("alert_type"), "LOCATION_NAME",
                     F.coalesce(F.col("condition_id"), F.lit("")).alias("condition_id"),
                     detail.alias("detail"), "POLL_TIMESTAMP",
                     F.col("POLL_TIMESTAMP").alias("ALERT_TIMESTAMP"))


def _arbitrage_rule() -> tuple[Column, Column]:
    hit = F.coalesce(F.col("arbitrage_flag"), F.lit(False))
    return hit, _text(ARBITRAGE_TEXT, question=F.coalesce(F.col("question"), F.lit("")))


def _high_error_rule() -> tuple[Column, Column]:
    e = F.col("PREDICTION_ERROR")
    hit = e.isNotNull() & ~F.isnan(e) & (e > HIGH_ERROR_THRESHOLD)
    detail = _text(HIGH_ERROR_TEXT, err=fixed_text(e, 3), yes=fixed_text(F.col("yes_price"), 3),
                   target=fixed_text(F.col("target_temp"), 1),
                   actual=fixed_text(F.coalesce(F.col("actual_temp"), F.lit(0.0)), 1))
    return hit, detail


def alert_arbitrage(corr: DataFrame) -> DataFrame:
    hit, detail = _arbitrage_rule()
    return _corr_alert(corr.where(valid_location() & hit), "ARBITRAGE", detail)


def alert_high_error(corr: DataFrame) -> DataFrame:
    hit, detail = _high_error_rule()
    return _corr_alert(corr.where(valid_location() & hit), "HIGH_ERROR", detail)


def correlation_alerts(corr: DataFrame) -> DataFrame:
    """ARBITRAGE and HIGH_ERROR in one pass over the correlations."""
    f = _fan_out(corr.where(valid_location()),
                 [("ARBITRAGE", *_arbitrage_rule()), ("HIGH_ERROR", *_high_error_rule())])
    return f.select("alert_type", "LOCATION_NAME",
                    F.coalesce(F.col("condition_id"), F.lit("")).alias("condition_id"), "detail",
                    "POLL_TIMESTAMP", F.col("POLL_TIMESTAMP").alias("ALERT_TIMESTAMP"))


def alerts_all(acc: DataFrame, corr: DataFrame) -> DataFrame:
    """Union of the four rules; one correlation row may raise two alerts."""
    return accuracy_alerts(acc).unionByName(correlation_alerts(corr))


def tag_and_union(acc: DataFrame, corr: DataFrame) -> DataFrame:
    """Both inputs as one feed keyed by city, with a source tag (the detector's input)."""
    a = acc.select(F.lit("accuracy").alias("_src"), "LOCATION_NAME",
                   F.col("window_end").alias("event_time"), F.lit(None).cast("string").alias("condition_id"))
    c = corr.select(F.lit("correlation").alias("_src"), "LOCATION_NAME",
                    F.col("POLL_TIMESTAMP").alias("event_time"), "condition_id")
    return a.unionByName(c).where(valid_location())


# ------------------------------------------------------------ spec-only rules

def baseline_7d(acc: DataFrame) -> DataFrame:
    """Baseline over the last 7 days only (range frame incl. current window) and its 2-sigma test."""
    a = min_sample_filter(acc).withColumn("_r", scaled_int(F.col("accuracy_rate"), 10_000))
    a = range_frame_by_key(a, ["LOCATION_NAME"], "window_end", 7 * 86400,
                           {"n7": F.count(F.lit(1)), "_s1": F.sum("_r"), "_s2": F.sum(F.col("_r") * F.col("_r"))})
    n = F.col("n7")
    sigma_r = F.when(n >= 2, F.sqrt((n * F.col("_s2") - F.col("_s1") * F.col("_s1")) / (n * (n - 1))))\
        .otherwise(F.lit(0.0))
    a = a.withColumn("_sig", sigma_r).withColumn("_mean", F.col("_s1") / n)
    anomaly = ((n >= ANOMALY_MIN_POINTS) & (F.col("_sig") > ANOMALY_MIN_SIGMA * 10_000)
               & (F.abs(F.col("_r") - F.col("_mean")) > ANOMALY_SIGMAS * F.col("_sig")))
    return a.select("LOCATION_NAME", "window_end", "accuracy_rate", "n7",
                    (F.col("_mean") / 10_000.0).alias("mean_7d"),
                    (F.col("_sig") / 10_000.0).alias("sigma_7d"), anomaly.alias("is_anomaly"))


def drop_within_1h(acc: DataFrame) -> DataFrame:
    """Windows whose rate is more than 0.20 below the highest rate of the preceding hour."""
    a = min_sample_filter(acc).withColumn("_r", scaled_int(F.col("accuracy_rate"), 10_000))
    a = range_frame_by_key(a, ["LOCATION_NAME"], "window_end", 3600, {"_max_r": F.max("_r")})
    drop_r = F.col("_max_r") - F.col("_r")
    return (a.where(drop_r > DROP_THRESHOLD * 10_000)
            .select("LOCATION_NAME", "window_end", "accuracy_rate",
                    (F.col("_max_r") / 10_000.0).alias("max_rate_1h"),
                    (drop_r / 10_000.0).alias("drop")))
