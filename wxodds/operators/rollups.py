"""Hourly rollups that merge: a panel over any span reads one row an hour, not the table.

Distinct cities are kept as HyperLogLog sketches: with 2^HLL_BITS registers the relative standard error is
about 1.04 / 2^(HLL_BITS / 2) = 1.6 %, and counts up to some hundreds are exact.  Latencies are kept as KLL
quantile sketches: with KLL_K = 800 a quantile's rank is off by less than RANK_ERROR of the rows (99 %
confidence), however many sketches were merged.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.functions.core import half_up_ratio, scaled_int

HLL_BITS = 12
KLL_K, RANK_ERROR = 800, 0.005
HOURS = 24


def _hour(ts: str) -> Column:
    return F.date_trunc("hour", ts).alias("hour")


def city_rollup(corr_t: DataFrame) -> DataFrame:
    """(hour, cities): the sketch of each hour's distinct cities."""
    return corr_t.groupBy(_hour("inserted_at")).agg(F.hll_sketch_agg("location_name", F.lit(HLL_BITS)).alias("cities"))


def active_cities(rollup: DataFrame, hours: int = HOURS, last_hour=None) -> DataFrame:
    """Distinct cities of the last `hours` hours up to `last_hour` (the rollup's latest, if not given)."""
    last = rollup.agg(F.max("hour")).scalar() if last_hour is None else F.lit(last_hour).cast("timestamp")
    span = rollup.where((F.col("hour") > last - F.expr(f"INTERVAL {hours} HOURS")) & (F.col("hour") <= last))
    return span.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("cities")), F.lit(0)).alias("value"))


def latency_rollup(corr: DataFrame) -> DataFrame:
    """(hour, correlations, max_latency_sec, latencies): the sketch of each hour's latencies."""
    lat = F.col("CORRELATION_LATENCY_SEC")
    return corr.groupBy(_hour("POLL_TIMESTAMP")).agg(
        F.count(F.lit(1)).alias("correlations"), F.max(lat).alias("max_latency_sec"),
        F.kll_sketch_agg_bigint(lat.cast("long"), F.lit(KLL_K)).alias("latencies"))


def latency_quantile(rollup: DataFrame, *by: Column, rank: float = 0.99) -> DataFrame:
    """The `rank` quantile of the latencies of all hours, or of those of each `by`, from merged sketches."""
    merged = rollup.groupBy(*by).agg(
        F.sum("correlations").alias("correlations"), F.max("max_latency_sec").alias("max_latency_sec"),
        F.kll_merge_agg_bigint("latencies", F.lit(KLL_K)).alias("latencies"))
    return merged.withColumn("latency_sec", F.kll_sketch_get_quantile_bigint("latencies", F.lit(rank))).drop("latencies")


def heatmap_cube(corr: DataFrame) -> DataFrame:
    """The heatmap with all of its subtotals in one pass; `level` tells what is summed up (grouping_id of
    question type, city and day of week, 1 = Sunday: 7 is the grand total)."""
    rows = corr.select("question_type", "LOCATION_NAME", F.dayofweek("POLL_TIMESTAMP").alias("day_of_week"),
                       F.col("ACTUAL_OUTCOME").cast("long").alias("outcome"), scaled_int(F.col("PREDICTION_ERROR"), 10_000).alias("err"))
    g = rows.cube("question_type", "LOCATION_NAME", "day_of_week").agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("total"), F.sum("outcome").alias("correct"), F.sum("err").alias("_err"))
    return g.select("question_type", "LOCATION_NAME", "day_of_week", "level", "total", "correct",
                    half_up_ratio(F.col("correct") * 10_000, F.col("total"), 10_000).alias("accuracy"),
                    half_up_ratio(F.col("_err"), F.col("total"), 10_000).alias("avg_error"))
