"""Accuracy aggregation over sliding event-time windows (1 h window, 15 min slide by default).

All window metrics are mergeable (counts, integer sums, max), so rows are first reduced to one
row per (key, pane) -- pane = gcd(window, slide) -- with a partial/final hash aggregate, and only
those pane rows are fanned out to the window_size/pane windows that contain them.  This equals
`groupBy(window(ts, '1 hour', '15 minutes'), key)` but the x4 expansion touches pane rows, not
input rows, and a hot city is spread over its panes.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.functions.core import half_up_ratio, int_floor_div, scaled_int
from wxodds.functions.market import UNKNOWN_LOCATION
from wxodds.operators.ordered import running_sums_by_key

WINDOW_SECONDS = 3600
SLIDE_SECONDS = 900


def valid_location(c: str = "LOCATION_NAME") -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "") & (F.col(c) != UNKNOWN_LOCATION)


def drop_unknown_location(df: DataFrame) -> DataFrame:
    return df.where(valid_location())


def accuracy_skip_invalid(corr: DataFrame) -> DataFrame:
    """Rows without an outcome or with a missing/NaN error do not count."""
    e = F.col("PREDICTION_ERROR")
    return drop_unknown_location(corr).where(
        F.col("ACTUAL_OUTCOME").isNotNull() & e.isNotNull() & ~F.isnan(e))


def pane_windows(df: DataFrame, keys: list[str], ts: str, window_s: int, slide_s: int,
                 sums: dict[str, Column], maxes: dict[str, Column] | None = None) -> DataFrame:
    """Sliding-window sums/maxes per key via pane pre-aggregation.

    Returns keys, window_start, window_end and one column per entry of sums/maxes.
    Windows are [k*slide, k*slide + window) aligned to the epoch, like `window()`.
    """
    maxes = maxes or {}
    pane_s = math.gcd(window_s, slide_s)
    pane = int_floor_div(F.unix_micros(F.col(ts)), pane_s * 1_000_000)
    per_pane = df.groupBy(*keys, pane.alias("_pane")).agg(
        *[F.sum(e).alias(n) for n, e in sums.items()],
        *[F.max(e).alias(n) for n, e in maxes.items()])
    start_s = F.col("_pane") * pane_s                 # pane start, seconds
    first = int_floor_div(start_s - window_s, slide_s) + 1
    last = int_floor_div(start_s, slide_s)
    fanned = per_pane.withColumn("_w", F.explode(F.sequence(first, last)))
    win = fanned.groupBy(*keys, "_w").agg(
        *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxes])
    return win.select(
        *keys,
        F.timestamp_seconds(F.col("_w") * slide_s).alias("window_start"),
        F.timestamp_seconds(F.col("_w") * slide_s + window_s).alias("window_end"),
        *sums.keys(), *maxes.keys())


def _accuracy_inputs(corr: DataFrame) -> tuple[dict, dict]:
    out = F.col("ACTUAL_OUTCOME")
    closed = F.coalesce(F.col("market_closed"), F.lit(False))
    yes = F.col("yes_price")
    signed = F.coalesce(F.when(~F.isnan(yes), yes - out), F.lit(0.0))
    sums = {
        "total_count": F.lit(1).cast("long"),
        "correct_count": F.when(out == 1, 1).otherwise(0).cast("long"),
        "_err": scaled_int(F.col("PREDICTION_ERROR"), 10_000),
        "_bias": scaled_int(signed, 100_000_000),
        "closed_count": F.when(closed, 1).otherwise(0).cast("long"),
        "closed_correct_count": F.when(closed & (out == 1), 1).otherwise(0).cast("long"),
    }
    maxes = {"_err_max": scaled_int(F.col("PREDICTION_ERROR"), 10_000)}
    return sums, maxes


def accuracy_metrics(w: DataFrame, key: str = "LOCATION_NAME") -> DataFrame:
    t = F.col("total_count")
    return w.select(
        key, "window_start", "window_end", "total_count", "correct_count",
        half_up_ratio(F.col("correct_count") * 10_000, t, 10_000).alias("accuracy_rate"),
        half_up_ratio(F.col("_err"), t, 10_000).alias("avg_prediction_error"),
        (F.greatest(F.col("_err_max"), F.lit(0)) / 10_000.0).alias("max_prediction_error"),
        half_up_ratio(F.col("_bias"), t * 10_000, 10_000).alias("bias_score"),
        "closed_count", "closed_correct_count",
        F.when(F.col("closed_count") > 0,
               half_up_ratio(F.col("closed_correct_count") * 10_000, F.col("closed_count"), 10_000)
               ).alias("closed_accuracy_rate"),
    )


def accuracy_sliding(corr: DataFrame, key: str = "LOCATION_NAME", window_s: int = WINDOW_SECONDS,
                     slide_s: int = SLIDE_SECONDS) -> DataFrame:
    """AccuracyWindow rows: one per key and window that holds at least one valid row."""
    v = accuracy_skip_invalid(corr) if key == "LOCATION_NAME" else (
        corr.where(F.col("ACTUAL_OUTCOME").isNotNull() & F.col("PREDICTION_ERROR").isNotNull()
                   & ~F.isnan("PREDICTION_ERROR")))
    sums, maxes = _accuracy_inputs(v)
    return accuracy_metrics(pane_windows(v, [key], "POLL_TIMESTAMP", window_s, slide_s, sums, maxes), key)


def accuracy_sliding_plain(corr: DataFrame, window_s: int = WINDOW_SECONDS,
                           slide_s: int = SLIDE_SECONDS) -> DataFrame:
    """Same result with Spark's window(); used as the independent form in tests."""
    v = accuracy_skip_invalid(corr)
    sums, maxes = _accuracy_inputs(v)
    g = v.groupBy("LOCATION_NAME", F.window("POLL_TIMESTAMP", f"{window_s} seconds", f"{slide_s} seconds"))
    w = g.agg(*[F.sum(e).alias(n) for n, e in sums.items()], *[F.max(e).alias(n) for n, e in maxes.items()])
    w = w.withColumn("window_start", F.col("window.start")).withColumn("window_end", F.col("window.end"))
    return accuracy_metrics(w)


def tumbling_1h_correlation(corr: DataFrame) -> DataFrame:
    """Hourly tumbling counts, outcomes and mean error per city."""
    v = accuracy_skip_invalid(corr)
    sums = {"total_count": F.lit(1).cast("long"),
            "correct_count": F.when(F.col("ACTUAL_OUTCOME") == 1, 1).otherwise(0).cast("long"),
            "_err": scaled_int(F.col("PREDICTION_ERROR"), 10_000)}
    w = pane_windows(v, ["LOCATION_NAME"], "POLL_TIMESTAMP", 3600, 3600, sums)
    return w.select("LOCATION_NAME", "window_start", "window_end", "total_count", "correct_count",
                    half_up_ratio(F.col("_err"), F.col("total_count"), 10_000).alias("avg_prediction_error"))


def volume_weighted_accuracy(corr_ext: DataFrame) -> DataFrame:
    """Per city and sliding window: sum(outcome * volume) / sum(volume) (null when no volume)."""
    v = accuracy_skip_invalid(corr_ext)
    vol = F.coalesce(F.col("volume"), F.lit(0.0))
    sums = {"total_count": F.lit(1).cast("long"),
            "_vol": scaled_int(vol, 100),
            "_vol_yes": scaled_int(F.when(F.col("ACTUAL_OUTCOME") == 1, vol).otherwise(0.0), 100)}
    w = pane_windows(v, ["LOCATION_NAME"], "POLL_TIMESTAMP", WINDOW_SECONDS, SLIDE_SECONDS, sums)
    return w.select("LOCATION_NAME", "window_start", "window_end", "total_count",
                    (F.col("_vol") / 100.0).alias("total_volume"),
                    F.when(F.col("_vol") > 0, half_up_ratio(F.col("_vol_yes") * 10_000, F.col("_vol"), 10_000))
                    .alias("volume_weighted_accuracy"))


def hit_rate(corr: DataFrame) -> DataFrame:
    """True prediction accuracy per city: share of rows where (yes_price > 0.5) == (outcome == 1)."""
    v = accuracy_skip_invalid(corr)
    hit = ((F.col("yes_price") > 0.5) == (F.col("ACTUAL_OUTCOME") == 1)).cast("long")
    g = v.groupBy("LOCATION_NAME").agg(F.count(F.lit(1)).alias("total_count"), F.sum(hit).alias("hits"))
    return g.select("LOCATION_NAME", "total_count", "hits",
                    half_up_ratio(F.col("hits") * 10_000, F.col("total_count"), 10_000).alias("hit_rate"))


def accuracy_running_total(corr: DataFrame) -> DataFrame:
    """Per-event running totals per city in poll order (the earlier per-event accumulator)."""
    v = accuracy_skip_invalid(corr).withColumn("_cid", F.coalesce(F.col("condition_id"), F.lit("")))
    r = running_sums_by_key(
        v, ["LOCATION_NAME"], "POLL_TIMESTAMP", ["_cid", "question"],
        {"running_total": F.lit(1).cast("long"),
         "running_correct": F.when(F.col("ACTUAL_OUTCOME") == 1, 1).otherwise(0).cast("long")})
    return r.select("LOCATION_NAME", "POLL_TIMESTAMP", "condition_id", "question", "running_total",
                    "running_correct",
                    half_up_ratio(F.col("running_correct") * 10_000, F.col("running_total"), 10_000)
                    .alias("running_accuracy"))
