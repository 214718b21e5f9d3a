"""Query registry: one entry per operator of the inventory, each with its DuckDB oracle.

Every query reads the driver's tables (through the fixture derivation in sources/fixtures.py)
over their whole extent.  Keys are the operator names; `ORACLE[name]` is the plain-SQL statement
of the same result (omitted only where no SQL form exists).
"""
from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds import schemas
from wxodds.functions.core import round4
from wxodds.functions.market import (
    compute_outcome, location_key, question_type, target_temp, yes_price,
)
from wxodds.operators import accuracy, anomaly, asof, correlate, ingest, quality, rollups, serving
from wxodds.plans.flow import Flow, release
from wxodds.plans.oracle import VALID_LOC, q, r4, ratio, ratio_away
from wxodds.session import work_folder
from wxodds.sources import fixtures, landing, topics, upsert
from wxodds.streaming import routing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Callable[[Flow], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            flow = Flow(spark, sf_dir)
            result = fn(flow).select("*")
            # what the flow keeps goes with the result
            weakref.finalize(result, release, flow.held).atexit = False
            return result
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = q(sql)
        return fn
    return deco


# ====================================================================== core flow

@query("asof_weather_join", """
SELECT condition_id, question_id, LOCATION_NAME, POLL_TIMESTAMP, closed,
       w_type AS w_data_type, w_poll, cur_t AS w_current_temp, dmax AS w_daily_max, dmin AS w_daily_min
FROM pairs""")
def q_asof(f: Flow) -> DataFrame:
    """Each market row with the latest weather of its city and class seen at its poll time."""
    j = asof.asof_weather_join(f.pred, f.wx)
    return j.select("condition_id", "question_id", "LOCATION_NAME", "POLL_TIMESTAMP", "closed",
                    "w_data_type", "w_poll", "w_current_temp", "w_daily_max", "w_daily_min")


@query("shape_correlation", "SELECT * FROM corr")
def q_corr(f: Flow) -> DataFrame:
    return f.corr


@query("accuracy_sliding_1h_15m", "SELECT * FROM acc")
def q_acc(f: Flow) -> DataFrame:
    return f.acc


@query("alerts_all", "SELECT * FROM alerts")
def q_alerts(f: Flow) -> DataFrame:
    return f.alerts


@query("shape_alert", "SELECT alert_type, LOCATION_NAME, condition_id, POLL_TIMESTAMP, ALERT_TIMESTAMP FROM alerts")
def q_shape_alert(f: Flow) -> DataFrame:
    return f.alerts.select("alert_type", "LOCATION_NAME", "condition_id", "POLL_TIMESTAMP", "ALERT_TIMESTAMP")


@query("alert_detail_text", "SELECT alert_type, LOCATION_NAME, POLL_TIMESTAMP, detail FROM alerts")
def q_alert_detail(f: Flow) -> DataFrame:
    return f.alerts.select("alert_type", "LOCATION_NAME", "POLL_TIMESTAMP", "detail")


@query("alert_accuracy_drop", "SELECT * FROM alerts WHERE alert_type = 'ACCURACY_DROP'")
def q_drop(f: Flow) -> DataFrame:
    return anomaly.alert_accuracy_drop(anomaly.running_baseline(f.acc))


@query("alert_accuracy_anomaly", "SELECT * FROM alerts WHERE alert_type = 'ACCURACY_ANOMALY'")
def q_anomaly(f: Flow) -> DataFrame:
    return anomaly.alert_accuracy_anomaly(anomaly.running_baseline(f.acc))


@query("alert_arbitrage", "SELECT * FROM alerts WHERE alert_type = 'ARBITRAGE'")
def q_arb(f: Flow) -> DataFrame:
    return anomaly.alert_arbitrage(f.corr)


@query("alert_high_error", "SELECT * FROM alerts WHERE alert_type = 'HIGH_ERROR'")
def q_high(f: Flow) -> DataFrame:
    return anomaly.alert_high_error(f.corr)


@query("min_sample_filter", """
SELECT LOCATION_NAME, window_start, window_end, total_count, accuracy_rate FROM af""")
def q_min_sample(f: Flow) -> DataFrame:
    return anomaly.min_sample_filter(f.acc).select(
        "LOCATION_NAME", "window_start", "window_end", "total_count", "accuracy_rate")


@query("running_baseline", """
SELECT LOCATION_NAME, window_end, accuracy_rate, n AS baseline_n, mean_r / 10000 AS baseline_mean,
       sigma_r / 10000 AS baseline_sigma, prev AS prev_accuracy_rate
FROM ab2""")
def q_baseline(f: Flow) -> DataFrame:
    return anomaly.running_baseline(f.acc).select(
        "LOCATION_NAME", "window_end", "accuracy_rate", "baseline_n", "baseline_mean",
        "baseline_sigma", "prev_accuracy_rate")


@query("tag_and_union", f"""
SELECT 'accuracy' AS _src, LOCATION_NAME, window_end AS event_time, CAST(NULL AS VARCHAR) AS condition_id
FROM acc WHERE {VALID_LOC}
UNION ALL
SELECT 'correlation', LOCATION_NAME, POLL_TIMESTAMP, condition_id FROM corr WHERE {VALID_LOC}""")
def q_tag_union(f: Flow) -> DataFrame:
    return anomaly.tag_and_union(f.acc, f.corr)


# ====================================================================== ingest

_OTHER_MARKETS = """
SELECT '0xs' || CAST(event_id AS VARCHAR) AS condition_id, 's' || CAST(event_id AS VARCHAR) AS question_id,
       'Will the home side win the match?' AS question, false AS closed
FROM base WHERE event_type <> 'error' AND event_id % 7 = 3"""


@query("explode_markets", f"""
SELECT condition_id, question_id, question, closed FROM shaped
UNION ALL {_OTHER_MARKETS}""")
def q_explode(f: Flow) -> DataFrame:
    m = ingest.explode_markets(f.raw_events)
    return m.select(F.col("conditionId").alias("condition_id"), F.col("id").alias("question_id"),
                    "question", "closed")


@query("weather_keyword_filter", "SELECT question_id, question FROM shaped")
def q_keyword(f: Flow) -> DataFrame:
    m = ingest.weather_keyword_filter(ingest.explode_markets(f.raw_events))
    return m.select(F.col("id").alias("question_id"), "question")


@query("scan_open_markets", f"""
SELECT question_id FROM shaped WHERE NOT closed
UNION ALL SELECT question_id FROM ({_OTHER_MARKETS})""")
def q_scan_open(f: Flow) -> DataFrame:
    return ingest.scan_open_markets(f.raw_events).select(F.col("id").alias("question_id"))


@query("scan_closed_markets", "SELECT question_id FROM shaped WHERE closed")
def q_scan_closed(f: Flow) -> DataFrame:
    return ingest.scan_closed_markets(f.raw_events).select(F.col("id").alias("question_id"))


@query("open_plus_closed", f"""
SELECT question_id, closed FROM shaped
UNION ALL SELECT question_id, closed FROM ({_OTHER_MARKETS})""")
def q_open_closed(f: Flow) -> DataFrame:
    return ingest.open_plus_closed(f.raw_events).select(F.col("id").alias("question_id"), "closed")


def _tokens_stage(f: Flow) -> DataFrame:
    m = ingest.weather_keyword_filter(ingest.open_plus_closed(f.raw_events))
    return ingest.build_tokens(ingest.parse_price_arrays(m))


@query("parse_price_arrays", """
SELECT question_id, 2 AS n_prices, yes_p AS price_0, no_p AS price_1 FROM shaped""")
def q_parse_prices(f: Flow) -> DataFrame:
    m = ingest.parse_price_arrays(ingest.weather_keyword_filter(ingest.open_plus_closed(f.raw_events)))
    return m.select(F.col("id").alias("question_id"), F.size("_prices").alias("n_prices"),
                    F.get("_prices", 0).cast("double").alias("price_0"),
                    F.get("_prices", 1).cast("double").alias("price_1"))


@query("build_tokens", """
SELECT question_id, 0 AS token_index, 'Yes' AS outcome, yes_p AS price, yes_win AS winner FROM shaped
UNION ALL
SELECT question_id, 1, 'No', no_p, NOT yes_win FROM shaped""")
def q_tokens(f: Flow) -> DataFrame:
    t = _tokens_stage(f)
    return t.select(F.col("id").alias("question_id"), F.posexplode("tokens").alias("token_index", "tok")) \
        .select("question_id", "token_index", "tok.outcome", "tok.price", "tok.winner")


@query("price_sum", "SELECT question_id, price_sum FROM shaped2")
def q_price_sum(f: Flow) -> DataFrame:
    return f.shaped.select("question_id", "price_sum")


@query("arbitrage_flag", "SELECT question_id, arbitrage_flag FROM shaped2")
def q_arb_flag(f: Flow) -> DataFrame:
    return f.shaped.select("question_id", "arbitrage_flag")


@query("parse_city", "SELECT question_id, LOCATION_NAME FROM shaped")
def q_parse_city(f: Flow) -> DataFrame:
    return f.shaped.select("question_id", "LOCATION_NAME")


@query("shape_prediction", """
SELECT condition_id, question_id, question, market_slug, end_date_iso, closed, active,
       LOCATION_NAME, POLL_TIMESTAMP, price_sum, arbitrage_flag, volume FROM shaped2""")
def q_shape_pred(f: Flow) -> DataFrame:
    return f.shaped.select("condition_id", "question_id", "question", "market_slug", "end_date_iso",
                           "closed", "active", "LOCATION_NAME", "POLL_TIMESTAMP", "price_sum",
                           "arbitrage_flag", "volume")


@query("price_change_only", "SELECT question_id, condition_id, POLL_TIMESTAMP, closed FROM suppressed")
def q_price_change(f: Flow) -> DataFrame:
    return ingest.price_change_only(f.shaped).select("question_id", "condition_id", "POLL_TIMESTAMP", "closed")


@query("validate_prediction", "SELECT question_id, condition_id, LOCATION_NAME, POLL_TIMESTAMP FROM pred")
def q_validate(f: Flow) -> DataFrame:
    return f.pred.select("question_id", "condition_id", "LOCATION_NAME", "POLL_TIMESTAMP")


@query("schema_error_count", """
SELECT 'token' AS reject_reason, count(*) AS rejected FROM suppressed
WHERE NOT (yes_p BETWEEN 0 AND 1 AND no_p BETWEEN 0 AND 1) HAVING count(*) > 0""")
def q_schema_errors(f: Flow) -> DataFrame:
    _, bad = ingest.validate_prediction(ingest.price_change_only(f.shaped))
    return ingest.schema_error_count(bad)


@query("daily_first_element", "SELECT LOCATION_NAME, POLL_TIMESTAMP, dmax AS temperature_2m_max, dmin AS temperature_2m_min FROM wx")
def q_daily_first(f: Flow) -> DataFrame:
    return f.wx.select("LOCATION_NAME", "POLL_TIMESTAMP", "daily.temperature_2m_max", "daily.temperature_2m_min")


_WX_FLAT = """SELECT LOCATION_NAME, POLL_TIMESTAMP, data_type, date, latitude, longitude,
       cur_t AS current_temp, dmax AS daily_max, dmin AS daily_min FROM wx"""


def _wx_flat(df: DataFrame) -> DataFrame:
    return df.select("LOCATION_NAME", "POLL_TIMESTAMP", "data_type", "date", "latitude", "longitude",
                     F.col("current.temperature_2m").alias("current_temp"),
                     F.col("daily.temperature_2m_max").alias("daily_max"),
                     F.col("daily.temperature_2m_min").alias("daily_min"))


@query("shape_weather", _WX_FLAT)
def q_shape_weather(f: Flow) -> DataFrame:
    return _wx_flat(ingest.shape_weather(f.raw_weather))


@query("scan_forecast", _WX_FLAT + " WHERE data_type = 'forecast'")
def q_scan_forecast(f: Flow) -> DataFrame:
    return _wx_flat(ingest.scan_forecast(f.raw_weather))


@query("scan_historical", _WX_FLAT + " WHERE data_type = 'historical'")
def q_scan_historical(f: Flow) -> DataFrame:
    return _wx_flat(ingest.scan_historical(f.raw_weather))


@query("validate_weather", _WX_FLAT)
def q_validate_weather(f: Flow) -> DataFrame:
    return _wx_flat(f.wx)


@query("city_worklist_open", "SELECT DISTINCT LOCATION_NAME AS city FROM pred WHERE NOT closed AND length(LOCATION_NAME) > 0")
def q_worklist_open(f: Flow) -> DataFrame:
    return ingest.city_worklist_open(f.pred)


@query("city_worklist_closed", """
SELECT LOCATION_NAME AS city, arg_min(substr(end_date_iso, 1, 10), (POLL_TIMESTAMP, question_id)) AS end_date
FROM pred WHERE closed AND length(LOCATION_NAME) > 0 GROUP BY 1""")
def q_worklist_closed(f: Flow) -> DataFrame:
    return ingest.city_worklist_closed(f.pred)


# ====================================================================== scalar functions

@query("location_key", "SELECT question_id, coalesce(LOCATION_NAME, 'UNKNOWN') AS location_key FROM pred")
def q_location_key(f: Flow) -> DataFrame:
    return f.pred.select("question_id", location_key(F.col("LOCATION_NAME")).alias("location_key"))


@query("drop_unknown_location", f"SELECT condition_id, POLL_TIMESTAMP FROM corr WHERE {VALID_LOC}")
def q_drop_unknown(f: Flow) -> DataFrame:
    return accuracy.drop_unknown_location(f.corr).select("condition_id", "POLL_TIMESTAMP")


@query("question_type", """
SELECT question_id, CASE
  WHEN lower(question) LIKE '%highest%' OR lower(question) LIKE '%maximum%' OR lower(question) LIKE '%high temp%' THEN 'HIGHEST'
  WHEN lower(question) LIKE '%lowest%' OR lower(question) LIKE '%minimum%' OR lower(question) LIKE '%low temp%' THEN 'LOWEST'
  ELSE 'EXACT' END AS question_type
FROM pred""")
def q_question_type(f: Flow) -> DataFrame:
    return f.pred.select("question_id", question_type(F.col("question")).alias("question_type"))


@query("target_temp", """
SELECT question_id, CASE WHEN regexp_extract(question, '(\\d+(?:\\.\\d+)?)\\s*°?([CF])', 2) = 'F'
  THEN (CAST(regexp_extract(question, '(\\d+(?:\\.\\d+)?)\\s*°?([CF])', 1) AS DOUBLE) - 32) * CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE)
  ELSE CAST(regexp_extract(question, '(\\d+(?:\\.\\d+)?)\\s*°?([CF])', 1) AS DOUBLE) END AS target_temp
FROM pred""")
def q_target(f: Flow) -> DataFrame:
    return f.pred.select("question_id", target_temp(F.col("question")).alias("target_temp"))


@query("yes_price", "SELECT question_id, yes_p AS yes_price FROM pred")
def q_yes_price(f: Flow) -> DataFrame:
    return f.pred.select("question_id", yes_price(F.col("tokens")).alias("yes_price"))


@query("actual_temp", "SELECT question_id, qt AS question_type, actual AS actual_temp FROM valued")
def q_actual(f: Flow) -> DataFrame:
    j = asof.asof_weather_join(correlate.market_features(f.pred), f.wx)
    return j.select("question_id", F.col("_qt").alias("question_type"), correlate.actual_temp(F.col("_qt")).alias("actual_temp"))


@query("legacy_freshness", "SELECT question_id, true AS fresh FROM pairs")
def q_legacy(f: Flow) -> DataFrame:
    j = asof.asof_weather_join(f.pred, f.wx)
    return j.select("question_id", correlate.legacy_fresh(F.col("POLL_TIMESTAMP")).alias("fresh"))


@query("compute_outcome", """
SELECT question_id, CASE
  WHEN lq LIKE '%above%' OR lq LIKE '%exceed%' OR lq LIKE '%more than%' OR lq LIKE '%at least%' THEN actual > target
  WHEN lq LIKE '%below%' OR lq LIKE '%under%' OR lq LIKE '%less than%' THEN actual < target
  ELSE abs(actual - target) <= 1.0 END AS computed_outcome
FROM valued WHERE actual IS NOT NULL AND target IS NOT NULL""")
def q_compute_outcome(f: Flow) -> DataFrame:
    j = asof.asof_weather_join(correlate.market_features(f.pred), f.wx)
    d = j.withColumn("_a", correlate.actual_temp(F.col("_qt"))).where(F.col("_a").isNotNull() & F.col("_target").isNotNull())
    return d.select("question_id", compute_outcome("question", "_a", "_target", "_cmp").alias("computed_outcome"))


@query("winner_outcome", "SELECT condition_id, POLL_TIMESTAMP, market_closed, ACTUAL_OUTCOME FROM corr")
def q_winner(f: Flow) -> DataFrame:
    return f.corr.select("condition_id", "POLL_TIMESTAMP", "market_closed", "ACTUAL_OUTCOME")


@query("prediction_error", "SELECT condition_id, POLL_TIMESTAMP, yes_price, ACTUAL_OUTCOME, PREDICTION_ERROR FROM corr")
def q_pred_error(f: Flow) -> DataFrame:
    return f.corr.select("condition_id", "POLL_TIMESTAMP", "yes_price", "ACTUAL_OUTCOME", "PREDICTION_ERROR")


@query("correlation_latency_sec", "SELECT condition_id, POLL_TIMESTAMP, CORRELATION_LATENCY_SEC FROM corr")
def q_latency(f: Flow) -> DataFrame:
    return f.corr.select("condition_id", "POLL_TIMESTAMP", "CORRELATION_LATENCY_SEC")


@query("round4", f"SELECT condition_id, POLL_TIMESTAMP, {r4('yes_price - ACTUAL_OUTCOME')} AS signed_error FROM corr")
def q_round4(f: Flow) -> DataFrame:
    return f.corr.select("condition_id", "POLL_TIMESTAMP",
                         round4(F.col("yes_price") - F.col("ACTUAL_OUTCOME")).alias("signed_error"))


@query("date_trunc_hour", """
SELECT date_trunc('hour', POLL_TIMESTAMP) AS hour, count(*) AS correlations FROM corr GROUP BY 1""")
def q_trunc_hour(f: Flow) -> DataFrame:
    return f.corr.groupBy(F.date_trunc("hour", "POLL_TIMESTAMP").alias("hour")).agg(
        F.count(F.lit(1)).alias("correlations"))


# ====================================================================== joins

@query("weather_class_route", """
SELECT LOCATION_NAME, POLL_TIMESTAMP, CASE WHEN data_type = 'historical' THEN 'hist' ELSE 'fcst' END AS weather_class FROM wx""")
def q_class_route(f: Flow) -> DataFrame:
    return f.wx.select("LOCATION_NAME", "POLL_TIMESTAMP", asof.weather_class(None).alias("weather_class"))


@query("geo_enrich", """
SELECT w.city, g.lat, g.lon FROM (SELECT DISTINCT LOCATION_NAME AS city FROM pred WHERE NOT closed AND length(LOCATION_NAME) > 0) w
JOIN geo g ON g.city = w.city""")
def q_geo_enrich(f: Flow) -> DataFrame:
    return quality.geo_enrich(ingest.city_worklist_open(f.pred), f.geo)


@query("geo_missing", """
SELECT w.city FROM (SELECT DISTINCT LOCATION_NAME AS city FROM pred WHERE NOT closed AND length(LOCATION_NAME) > 0) w
WHERE w.city NOT IN (SELECT city FROM geo)""")
def q_geo_missing(f: Flow) -> DataFrame:
    return quality.geo_missing(ingest.city_worklist_open(f.pred), f.geo)


@query("interval_weather_join", """
SELECT p.question_id, p.POLL_TIMESTAMP, w.POLL_TIMESTAMP AS w_poll, w.data_type AS w_data_type
FROM pred p JOIN wx w ON p.LOCATION_NAME = w.LOCATION_NAME
 AND w.POLL_TIMESTAMP BETWEEN p.POLL_TIMESTAMP - INTERVAL 15 MINUTE AND p.POLL_TIMESTAMP + INTERVAL 15 MINUTE""")
def q_interval_join(f: Flow) -> DataFrame:
    return quality.interval_weather_join(f.pred, f.wx).select(
        "question_id", "POLL_TIMESTAMP", "w_poll", "w_data_type")


@query("pending_predictions", """
SELECT u.question_id, u.POLL_TIMESTAMP,
       CASE WHEN w.POLL_TIMESTAMP <= u.POLL_TIMESTAMP + INTERVAL 24 HOUR THEN w.POLL_TIMESTAMP END AS resolved_by,
       CASE WHEN w.POLL_TIMESTAMP <= u.POLL_TIMESTAMP + INTERVAL 24 HOUR
            THEN CAST(epoch(w.POLL_TIMESTAMP) - epoch(u.POLL_TIMESTAMP) AS BIGINT) END AS wait_seconds
FROM (SELECT * FROM pm WHERE question_id NOT IN (SELECT question_id FROM pairs)) u
ASOF LEFT JOIN wc w ON u.LOCATION_NAME = w.LOCATION_NAME AND u.cls = w.cls AND u.POLL_TIMESTAMP < w.POLL_TIMESTAMP""")
def q_pending(f: Flow) -> DataFrame:
    return quality.pending_predictions(f.pred, f.wx)


@query("join_coverage", f"""
SELECT p.LOCATION_NAME, p.predictions, coalesce(c.matched, 0) AS matched,
       {ratio('coalesce(c.matched, 0) * 10000', 'p.predictions')} AS coverage,
       coalesce(c.matched, 0) * 100 < p.predictions * 95 AS below_target,
       coalesce(c.matched, 0) * 100 < p.predictions * 70 AS alarm
FROM (SELECT coalesce(LOCATION_NAME, 'UNKNOWN') AS LOCATION_NAME, count(*) AS predictions FROM pred GROUP BY 1) p
LEFT JOIN (SELECT LOCATION_NAME, count(*) AS matched FROM corr GROUP BY 1) c ON p.LOCATION_NAME = c.LOCATION_NAME""")
def q_coverage(f: Flow) -> DataFrame:
    return quality.join_coverage(f.pred, f.corr)


# ====================================================================== aggregations

@query("accuracy_skip_invalid", f"""
SELECT condition_id, POLL_TIMESTAMP, LOCATION_NAME FROM corr
WHERE {VALID_LOC} AND ACTUAL_OUTCOME IS NOT NULL AND PREDICTION_ERROR IS NOT NULL AND NOT isnan(PREDICTION_ERROR)""")
def q_skip_invalid(f: Flow) -> DataFrame:
    return accuracy.accuracy_skip_invalid(f.corr).select("condition_id", "POLL_TIMESTAMP", "LOCATION_NAME")


@query("accuracy_per_market", f"""
SELECT condition_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS total_count,
       CAST(sum(CASE WHEN ACTUAL_OUTCOME = 1 THEN 1 ELSE 0 END) AS BIGINT) AS correct_count,
       {ratio('sum(CASE WHEN ACTUAL_OUTCOME = 1 THEN 1 ELSE 0 END) * 10000', 'count(*)')} AS accuracy_rate,
       {ratio('sum(err_i)', 'count(*)')} AS avg_prediction_error,
       greatest(max(err_i), 0) / 10000 AS max_prediction_error,
       {ratio('sum(bias_i)', 'count(*) * 10000')} AS bias_score,
       CAST(sum(CASE WHEN market_closed THEN 1 ELSE 0 END) AS BIGINT) AS closed_count,
       CAST(sum(CASE WHEN market_closed AND ACTUAL_OUTCOME = 1 THEN 1 ELSE 0 END) AS BIGINT) AS closed_correct_count,
       CASE WHEN sum(CASE WHEN market_closed THEN 1 ELSE 0 END) > 0 THEN
         {ratio('sum(CASE WHEN market_closed AND ACTUAL_OUTCOME = 1 THEN 1 ELSE 0 END) * 10000', 'sum(CASE WHEN market_closed THEN 1 ELSE 0 END)')}
       END AS closed_accuracy_rate
FROM (SELECT *, TIMESTAMP '1970-01-01 00:00:00' + to_microseconds((epoch_us(POLL_TIMESTAMP) // 900000000 - j) * 900000000) AS window_start
      FROM (SELECT *, CAST(floor(PREDICTION_ERROR * 10000 + 0.5) AS BIGINT) AS err_i,
                   CAST(floor(coalesce(yes_price - ACTUAL_OUTCOME, 0) * 100000000 + 0.5) AS BIGINT) AS bias_i,
                   unnest([0, 1, 2, 3]) AS j FROM corr
            WHERE ACTUAL_OUTCOME IS NOT NULL AND PREDICTION_ERROR IS NOT NULL AND NOT isnan(PREDICTION_ERROR)))
GROUP BY condition_id, window_start""")
def q_acc_market(f: Flow) -> DataFrame:
    return accuracy.accuracy_sliding(f.corr, key="condition_id")


@query("volume_weighted_accuracy", f"""
SELECT LOCATION_NAME, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS total_count,
       sum(vol) / 100 AS total_volume,
       CASE WHEN sum(vol) > 0 THEN {ratio('sum(vol_yes) * 10000', 'sum(vol)')} END AS volume_weighted_accuracy
FROM (SELECT *, CAST(floor(coalesce(volume, 0) * 100 + 0.5) AS BIGINT) AS vol,
             CAST(floor(CASE WHEN ACTUAL_OUTCOME = 1 THEN coalesce(volume, 0) ELSE 0 END * 100 + 0.5) AS BIGINT) AS vol_yes
      FROM cw)
GROUP BY LOCATION_NAME, window_start""")
def q_vol_weighted(f: Flow) -> DataFrame:
    return accuracy.volume_weighted_accuracy(f.corr_ext)


@query("tumbling_1h_correlation", f"""
SELECT LOCATION_NAME, date_trunc('hour', POLL_TIMESTAMP) AS window_start,
       date_trunc('hour', POLL_TIMESTAMP) + INTERVAL 1 HOUR AS window_end, count(*) AS total_count,
       CAST(sum(CASE WHEN ACTUAL_OUTCOME = 1 THEN 1 ELSE 0 END) AS BIGINT) AS correct_count,
       {ratio('sum(err_i)', 'count(*)')} AS avg_prediction_error
FROM cv GROUP BY 1, 2""")
def q_tumbling(f: Flow) -> DataFrame:
    return accuracy.tumbling_1h_correlation(f.corr)


@query("hit_rate", f"""
SELECT LOCATION_NAME, count(*) AS total_count,
       CAST(sum(CASE WHEN (yes_price > 0.5) = (ACTUAL_OUTCOME = 1) THEN 1 ELSE 0 END) AS BIGINT) AS hits,
       {ratio('sum(CASE WHEN (yes_price > 0.5) = (ACTUAL_OUTCOME = 1) THEN 1 ELSE 0 END) * 10000', 'count(*)')} AS hit_rate
FROM cv GROUP BY 1""")
def q_hit_rate(f: Flow) -> DataFrame:
    return accuracy.hit_rate(f.corr)


@query("accuracy_running_total", f"""
SELECT LOCATION_NAME, POLL_TIMESTAMP, condition_id, question, running_total, running_correct,
       {ratio('running_correct * 10000', 'running_total')} AS running_accuracy
FROM (SELECT *, count(*) OVER w AS running_total,
             CAST(sum(CASE WHEN ACTUAL_OUTCOME = 1 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS running_correct
      FROM cv WINDOW w AS (PARTITION BY LOCATION_NAME ORDER BY POLL_TIMESTAMP, condition_id, question
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
def q_running_total(f: Flow) -> DataFrame:
    return accuracy.accuracy_running_total(f.corr)


# ====================================================================== spec windows / arbitrage

@query("baseline_7d", """
SELECT LOCATION_NAME, window_end, accuracy_rate, n7, s1 / n7 / 10000 AS mean_7d, sig / 10000 AS sigma_7d,
       (n7 >= 10 AND sig > 100 AND abs(r - s1 / n7) > 2 * sig) AS is_anomaly
FROM (SELECT *, CASE WHEN n7 >= 2 THEN sqrt((n7 * s2 - s1 * s1) / (n7 * (n7 - 1))) ELSE 0.0 END AS sig
      FROM (SELECT *, count(*) OVER w AS n7, sum(r) OVER w AS s1, sum(r * r) OVER w AS s2 FROM af
            WINDOW w AS (PARTITION BY LOCATION_NAME ORDER BY window_end
                         RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)))""")
def q_baseline_7d(f: Flow) -> DataFrame:
    return anomaly.baseline_7d(f.acc)


@query("drop_within_1h", """
SELECT LOCATION_NAME, window_end, accuracy_rate, max_r / 10000 AS max_rate_1h, (max_r - r) / 10000 AS drop
FROM (SELECT *, max(r) OVER (PARTITION BY LOCATION_NAME ORDER BY window_end
                             RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS max_r FROM af)
WHERE max_r - r > 2000""")
def q_drop_1h(f: Flow) -> DataFrame:
    return anomaly.drop_within_1h(f.acc)


_PROFIT = f"""question_id, condition_id, POLL_TIMESTAMP, price_sum,
       CASE WHEN raw_sum < 1 THEN 'buy_all' ELSE 'sell_all' END AS side,
       {r4('abs(1.0 - raw_sum) / raw_sum * 100')} AS expected_profit_pct"""


@query("expected_profit_pct", f"SELECT {_PROFIT} FROM pred WHERE arbitrage_flag AND raw_sum > 0")
def q_profit(f: Flow) -> DataFrame:
    return quality.expected_profit(f.pred)


@query("market_leaderboard", f"""
WITH per AS (
  SELECT condition_id, count(*) AS n,
         CAST(sum(CASE WHEN (yes_price > 0.5) = (ACTUAL_OUTCOME = 1) THEN 1 ELSE 0 END) AS BIGINT) AS hits,
         {ratio('sum(CAST(floor(PREDICTION_ERROR * 10000 + 0.5) AS BIGINT))', 'count(*)')} AS avg_error
  FROM corr GROUP BY 1)
SELECT *, 'best' AS board FROM per QUALIFY dense_rank() OVER (ORDER BY avg_error ASC) <= 10
UNION ALL
SELECT *, 'worst' AS board FROM per QUALIFY dense_rank() OVER (ORDER BY avg_error DESC) <= 10""")
def q_leaderboard(f: Flow) -> DataFrame:
    return quality.market_leaderboard(f.corr)


# ====================================================================== monitors (batch forms)

@query("dedup_1h", "SELECT condition_id, POLL_TIMESTAMP, question_id FROM pred")
def q_dedup(f: Flow) -> DataFrame:
    """An at-least-once replay (every poll delivered twice) collapses to one row per key."""
    return quality.dedup_keys(f.pred.unionByName(f.pred)).select("condition_id", "POLL_TIMESTAMP", "question_id")


@query("producer_silence", """
SELECT feed, ts AS gap_start, nts AS gap_end, CAST(epoch(nts) - epoch(ts) AS BIGINT) AS gap_seconds
FROM (SELECT feed, ts, lead(ts) OVER (PARTITION BY feed ORDER BY ts) AS nts
      FROM (SELECT DISTINCT 'market' AS feed, POLL_TIMESTAMP AS ts FROM pred
            UNION SELECT DISTINCT 'weather', POLL_TIMESTAMP FROM wx))
WHERE epoch(nts) - epoch(ts) > 600""")
def q_silence(f: Flow) -> DataFrame:
    return quality.producer_silence(f.pred, f.wx)


@query("latency_p99", """
WITH h AS (SELECT date_trunc('hour', POLL_TIMESTAMP) AS hour, CORRELATION_LATENCY_SEC AS lat, count(*) AS c
           FROM corr GROUP BY 1, 2),
     hc AS (SELECT *, sum(c) OVER (PARTITION BY hour ORDER BY lat ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
                   sum(c) OVER (PARTITION BY hour) AS n FROM h)
SELECT hour, CAST(max(n) AS BIGINT) AS correlations, min(CASE WHEN cum * 100 >= n * 99 THEN lat END) AS p99_latency_sec,
       max(lat) AS max_latency_sec
FROM hc GROUP BY hour""")
def q_p99(f: Flow) -> DataFrame:
    return quality.latency_p99(f.corr)


@query("dq_impossible_values", """
SELECT 'negative_odds' AS rule, CAST(count(*) FILTER (WHERE yes_p < 0 OR no_p < 0) AS BIGINT) AS violations FROM shaped
UNION ALL SELECT 'odds_above_one', CAST(count(*) FILTER (WHERE yes_p > 1 OR no_p > 1) AS BIGINT) FROM shaped
UNION ALL SELECT 'negative_volume', CAST(count(*) FILTER (WHERE volume < 0) AS BIGINT) FROM shaped""")
def q_dq(f: Flow) -> DataFrame:
    return quality.dq_impossible_values(f.shaped)


# ====================================================================== serving panels

@query("p_total_correlations", "SELECT count(*) AS value FROM correlations")
def q_p1(f: Flow) -> DataFrame:
    return serving.p_total_correlations(f.correlations_table)


_LAST_DAY = "inserted_at > (SELECT max(inserted_at) FROM {t}) - INTERVAL 24 HOUR"


def _avg3(c: str) -> str:
    return ratio_away(f"sum(CAST({c} * 10000 AS BIGINT))", f"count({c}) * 10", 1000)


@query("p_alerts_24h", f"SELECT count(*) AS value FROM alerts_t WHERE {_LAST_DAY.format(t='alerts_t')}")
def q_p2(f: Flow) -> DataFrame:
    return serving.p_alerts_24h(f.alerts_table)


@query("p_avg_accuracy", f"SELECT {_avg3('accuracy_rate')} AS value FROM accuracy_windows WHERE {_LAST_DAY.format(t='accuracy_windows')}")
def q_p3(f: Flow) -> DataFrame:
    return serving.p_avg_accuracy(f.accuracy_table)


@query("p_arbitrage_count", "SELECT count(*) AS value FROM alerts_t WHERE alert_type = 'ARBITRAGE'")
def q_p4(f: Flow) -> DataFrame:
    return serving.p_arbitrage_count(f.alerts_table)


@query("p_active_cities", f"SELECT count(DISTINCT location_name) AS value FROM correlations WHERE {_LAST_DAY.format(t='correlations')}")
def q_p5(f: Flow) -> DataFrame:
    return serving.p_active_cities(f.correlations_table)


@query("p_avg_error", f"SELECT {_avg3('prediction_error')} AS value FROM correlations WHERE {_LAST_DAY.format(t='correlations')}")
def q_p6(f: Flow) -> DataFrame:
    return serving.p_avg_error(f.correlations_table)


_BY_CITY = f"""(SELECT location_name, {_avg3('accuracy_rate')} AS accuracy, {_avg3('avg_prediction_error')} AS avg_error,
        {_avg3('bias_score')} AS bias, CAST(sum(total_count) AS BIGINT) AS total_markets
 FROM accuracy_windows WHERE {_LAST_DAY.format(t='accuracy_windows')}
 GROUP BY location_name HAVING sum(total_count) >= 3)"""


@query("p_accuracy_by_city", f"SELECT location_name, accuracy FROM {_BY_CITY} ORDER BY accuracy DESC, location_name LIMIT 20")
def q_p7(f: Flow) -> DataFrame:
    return serving.p_accuracy_by_city(f.accuracy_table)


@query("p_error_by_city", f"SELECT location_name, avg_error FROM {_BY_CITY} ORDER BY avg_error DESC, location_name LIMIT 20")
def q_p8(f: Flow) -> DataFrame:
    return serving.p_error_by_city(f.accuracy_table)


@query("p_city_leaderboard", f"""
SELECT location_name, accuracy AS avg_accuracy, avg_error, bias, total_markets FROM {_BY_CITY}
ORDER BY avg_accuracy DESC, location_name""")
def q_p9(f: Flow) -> DataFrame:
    return serving.p_city_leaderboard(f.accuracy_table)


@query("p_recent_alerts", """
SELECT alert_timestamp, alert_type, location_name, detail FROM alerts_t
ORDER BY alert_timestamp DESC NULLS LAST, alert_type, location_name, condition_id NULLS FIRST, detail LIMIT 50""")
def q_p10(f: Flow) -> DataFrame:
    return serving.p_recent_alerts(f.alerts_table)


@query("p_high_error", """
SELECT poll_timestamp, location_name, question, CAST(round(yes_price, 3) AS DOUBLE) AS yes_price,
       CAST(round(target_temp, 1) AS DOUBLE) AS target_c, CAST(round(actual_temp, 1) AS DOUBLE) AS actual_c,
       actual_outcome, CAST(round(prediction_error, 3) AS DOUBLE) AS pred_error, market_closed
FROM correlations WHERE prediction_error > 0.7
ORDER BY poll_timestamp DESC, condition_id, question LIMIT 100""")
def q_p11(f: Flow) -> DataFrame:
    return serving.p_high_error(f.correlations_table)


@query("p_alert_types", "SELECT alert_type, count(*) AS count FROM alerts_t GROUP BY alert_type ORDER BY count DESC")
def q_p12(f: Flow) -> DataFrame:
    return serving.p_alert_types(f.alerts_table)


@query("p_data_type_split", "SELECT data_type, count(*) AS count FROM correlations GROUP BY data_type")
def q_p13(f: Flow) -> DataFrame:
    return serving.p_data_type_split(f.correlations_table)


@query("p_alerts_over_time", """
SELECT date_trunc('hour', alert_timestamp) AS time, alert_type AS metric, count(*) AS value FROM alerts_t
WHERE alert_timestamp BETWEEN (SELECT max(alert_timestamp) FROM alerts_t) - INTERVAL 24 HOUR
                          AND (SELECT max(alert_timestamp) FROM alerts_t)
GROUP BY 1, 2 ORDER BY 1""")
def q_p14(f: Flow) -> DataFrame:
    return serving.p_alerts_over_time(f.alerts_table)


# ====================================================================== specified views

@query("v_accuracy_map", f"""
WITH latest AS (SELECT location_name, max(window_end) AS window_end,
                       CAST(arg_max(accuracy_rate, window_end) AS DOUBLE) AS accuracy_rate
                FROM accuracy_windows GROUP BY 1),
     active AS (SELECT location_name, count(DISTINCT condition_id) AS active_markets FROM correlations
                WHERE {_LAST_DAY.format(t='correlations')} AND NOT market_closed GROUP BY 1)
SELECT l.location_name, l.window_end, l.accuracy_rate, coalesce(a.active_markets, 0) AS active_markets, g.lat, g.lon
FROM latest l LEFT JOIN active a ON a.location_name = l.location_name JOIN geo g ON g.city = l.location_name""")
def q_v_map(f: Flow) -> DataFrame:
    return serving.v_accuracy_map(f.accuracy_table, f.correlations_table, f.geo)


@query("v_accuracy_24h_line", f"""
SELECT window_end, count(*) AS cities, CAST(sum(total_count) AS BIGINT) AS total, CAST(sum(correct_count) AS BIGINT) AS correct,
       {ratio('sum(correct_count) * 10000', 'sum(total_count)')} AS accuracy
FROM accuracy_windows WHERE {_LAST_DAY.format(t='accuracy_windows')} GROUP BY window_end""")
def q_v_line(f: Flow) -> DataFrame:
    return serving.v_accuracy_24h_line(f.accuracy_table)


_CORR_STATS = f"""count(*) AS total, CAST(sum(ACTUAL_OUTCOME) AS BIGINT) AS correct,
       {ratio('sum(ACTUAL_OUTCOME) * 10000', 'count(*)')} AS accuracy,
       {ratio('sum(CAST(floor(PREDICTION_ERROR * 10000 + 0.5) AS BIGINT))', 'count(*)')} AS avg_error"""


@query("v_accuracy_trend_weekly", f"""
SELECT LOCATION_NAME, date_trunc('week', POLL_TIMESTAMP) AS week, {_CORR_STATS} FROM corr GROUP BY 1, 2""")
def q_v_weekly(f: Flow) -> DataFrame:
    return serving.v_accuracy_trend_weekly(f.corr)


@query("v_heatmap", f"""
SELECT question_type, LOCATION_NAME, CAST(dayofweek(POLL_TIMESTAMP) + 1 AS INTEGER) AS day_of_week, {_CORR_STATS}
FROM corr GROUP BY 1, 2, 3""")
def q_v_heatmap(f: Flow) -> DataFrame:
    return serving.v_heatmap(f.corr)


@query("v_bias_scatter", f"""
SELECT CAST(floor(yes_price * 10) AS BIGINT) AS price_bucket, count(*) AS n, CAST(sum(ACTUAL_OUTCOME) AS BIGINT) AS yes_outcomes,
       {ratio('sum(CAST(floor(yes_price * 10000 + 0.5) AS BIGINT))', 'count(*)')} AS avg_price,
       {ratio('sum(ACTUAL_OUTCOME) * 10000', 'count(*)')} AS observed_rate
FROM corr GROUP BY 1""")
def q_v_scatter(f: Flow) -> DataFrame:
    return serving.v_bias_scatter(f.corr)


@query("v_volume_accuracy_corr", """
WITH m AS (SELECT max(CAST(coalesce(volume, 0) AS BIGINT)) AS x,
                  CAST(floor(sum(CAST((yes_price > 0.5) = (ACTUAL_OUTCOME = 1) AS BIGINT)) * 10000 / count(*) + 0.5) AS BIGINT) AS y
           FROM corr_ext GROUP BY condition_id),
     d AS (SELECT count(*) AS n, CAST(count(*) AS DOUBLE) AS dn, CAST(sum(x) AS DOUBLE) AS dx, CAST(sum(y) AS DOUBLE) AS dy,
                  CAST(sum(x * y) AS DOUBLE) AS dxy, CAST(sum(x * x) AS DOUBLE) AS dxx, CAST(sum(y * y) AS DOUBLE) AS dyy FROM m)
SELECT n, CASE WHEN sqrt((dn * dxx - dx * dx) * (dn * dyy - dy * dy)) > 0
               THEN (dn * dxy - dx * dy) / sqrt((dn * dxx - dx * dx) * (dn * dyy - dy * dy)) END AS volume_accuracy_corr
FROM d""")
def q_v_volcorr(f: Flow) -> DataFrame:
    return serving.v_volume_accuracy_corr(f.corr_ext)


@query("v_arbitrage_now", f"""
SELECT {_PROFIT} FROM (SELECT * FROM pred QUALIFY row_number() OVER (PARTITION BY condition_id ORDER BY POLL_TIMESTAMP DESC, question_id DESC) = 1)
WHERE arbitrage_flag AND raw_sum > 0""")
def q_v_arb_now(f: Flow) -> DataFrame:
    return quality.arbitrage_now(f.pred)


@query("v_arbitrage_frequency", f"""
SELECT date_trunc('hour', POLL_TIMESTAMP) AS hour, count(*) AS polls,
       CAST(sum(CASE WHEN arbitrage_flag THEN 1 ELSE 0 END) AS BIGINT) AS arbitrage_polls,
       {ratio('sum(CASE WHEN arbitrage_flag THEN 1 ELSE 0 END) * 10000', 'count(*)')} AS arbitrage_share
FROM pred GROUP BY 1""")
def q_v_arb_freq(f: Flow) -> DataFrame:
    return quality.arbitrage_frequency(f.pred)


@query("sort_cities", "SELECT DISTINCT LOCATION_NAME AS city FROM pred WHERE NOT closed AND length(LOCATION_NAME) > 0 ORDER BY city")
def q_sort_cities(f: Flow) -> DataFrame:
    return ingest.city_worklist_open(f.pred)


@query("topk_recent_alerts", """
SELECT alert_timestamp, alert_type, location_name, detail FROM alerts_t
ORDER BY alert_timestamp DESC NULLS LAST, alert_type, location_name, condition_id NULLS FIRST, detail LIMIT 50""")
def q_topk(f: Flow) -> DataFrame:
    return serving.p_recent_alerts(f.alerts_table)


# ====================================================================== sinks and topics

@query("sink_correlations", """
SELECT condition_id, question, question_type, location_name, yes_price, target_temp, actual_temp, data_type,
       market_closed, actual_outcome, prediction_error, correlation_latency_sec, arbitrage_flag, poll_timestamp
FROM correlations""")
def q_sink_corr(f: Flow) -> DataFrame:
    """The correlations table rows, narrowed to the table's types (NUMERIC/SMALLINT/INTEGER)."""
    return f.correlations_table.drop("inserted_at")


@query("sink_accuracy_windows", "SELECT * EXCLUDE (inserted_at) FROM accuracy_windows")
def q_sink_acc(f: Flow) -> DataFrame:
    return f.accuracy_table.drop("inserted_at")


@query("sink_alerts", "SELECT * EXCLUDE (inserted_at) FROM alerts_t")
def q_sink_alerts(f: Flow) -> DataFrame:
    return f.alerts_table.drop("inserted_at")


@query("table_schema_cast", """
SELECT location_name, CAST(yes_price AS DOUBLE) AS yes_price, CAST(target_temp AS DOUBLE) AS target_temp,
       CAST(actual_temp AS DOUBLE) AS actual_temp, CAST(prediction_error AS DOUBLE) AS prediction_error,
       actual_outcome, correlation_latency_sec
FROM correlations""")
def q_table_cast(f: Flow) -> DataFrame:
    """Narrowed numerics as the table stores them (shown as doubles)."""
    t = f.correlations_table
    return t.select("location_name", *[F.col(c).cast("double").alias(c) for c in
                                       ["yes_price", "target_temp", "actual_temp", "prediction_error"]],
                    "actual_outcome", "correlation_latency_sec")


def _topic(f: Flow, df: DataFrame, name: str, schema) -> DataFrame:
    """`df` written to a topic folder and read back, typed, from there."""
    path = f"{work_folder(f.spark)}/wxodds-topics/{name}-{uuid.uuid4().hex}"
    topics.write_topic(df, path)
    return topics.read_topic(f.spark, path, schema)


@query("read_topic", "SELECT * FROM corr")
def q_read_topic(f: Flow) -> DataFrame:
    """The correlation topic, read with the fixed schema."""
    return _topic(f, f.corr, "correlations", schemas.CORR)


@query("scan_topic_bounded", """
SELECT condition_id, question_id, LOCATION_NAME, POLL_TIMESTAMP, closed, price_sum, arbitrage_flag FROM pred""")
def q_scan_topic(f: Flow) -> DataFrame:
    """The prediction topic read once from its start to its end (bounded batch read)."""
    return _topic(f, f.pred, "predictions", schemas.PRED).select(
        "condition_id", "question_id", "LOCATION_NAME", "POLL_TIMESTAMP", "closed", "price_sum", "arbitrage_flag")


@query("write_topic", "SELECT * FROM alerts")
def q_write_topic(f: Flow) -> DataFrame:
    """The alert topic as it was written."""
    return _topic(f, f.alerts, "alerts", schemas.ALERT)


@query("asof_weather_join_city_date", """
SELECT p.condition_id, p.question_id, p.LOCATION_NAME, p.POLL_TIMESTAMP, p.closed,
       w.data_type AS w_data_type, w.POLL_TIMESTAMP AS w_poll, w.date AS w_date
FROM (SELECT *, CASE WHEN closed THEN 'hist:' || substr(end_date_iso, 1, 10) ELSE 'fcst' END AS cls2 FROM pred) p
ASOF JOIN (SELECT *, CASE WHEN data_type = 'historical' THEN 'hist:' || coalesce(date, '') ELSE 'fcst' END AS cls2 FROM wx) w
  ON p.LOCATION_NAME = w.LOCATION_NAME AND p.cls2 = w.cls2 AND p.POLL_TIMESTAMP >= w.POLL_TIMESTAMP""")
def q_asof_city_date(f: Flow) -> DataFrame:
    """As-of match where a closed market only takes historical weather for its own end date."""
    j = asof.asof_weather_join(f.pred, f.wx, match="city_date")
    return j.select("condition_id", "question_id", "LOCATION_NAME", "POLL_TIMESTAMP", "closed",
                    "w_data_type", "w_poll", "w_date")


@query("write_topic_ingest", """
SELECT condition_id, question_id, question, LOCATION_NAME, POLL_TIMESTAMP, closed, price_sum, arbitrage_flag, volume FROM pred""")
def q_write_topic_ingest(f: Flow) -> DataFrame:
    """The ingest topic as it was written."""
    return _topic(f, f.pred, "ingest", schemas.PRED).select(
        "condition_id", "question_id", "question", "LOCATION_NAME", "POLL_TIMESTAMP", "closed", "price_sum", "arbitrage_flag", "volume")


# ====================================================================== landing folders by day

def _landing(f: Flow, lines: DataFrame, name: str) -> str:
    """A landing folder with `lines`, one folder a poll day."""
    path = f"{work_folder(f.spark)}/wxodds-landing/{name}-{uuid.uuid4().hex}"
    landing.write_landing(landing.dealt_by_day(lines), path)
    return path


def _landed_events(f: Flow) -> DataFrame:
    return landing.read_landing(f.spark, _landing(f, fixtures.landing_events(f.raw_events), "events"), schemas.RAW_EVENT)


def _landed_weather(f: Flow) -> DataFrame:
    return landing.read_landing(f.spark, _landing(f, fixtures.landing_weather(f.raw_weather), "weather"), schemas.RAW_WEATHER)


def _is(rule: tuple[int, int]) -> str:
    return f"event_id % {rule[0]} = {rule[1]}"


_LANDED = f"""(SELECT question_id, closed, NOT {_is(fixtures.UNTAGGED)} AS tagged, NOT closed AND NOT {_is(fixtures.INACTIVE)} AS is_active,
        strftime(ts, '%Y-%m-%d') AS poll_day, strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
        CASE WHEN {_is(fixtures.OTHER_DAY)} THEN strftime(ts + INTERVAL 2 DAY, '%Y-%m-%d') ELSE end_day END AS end_day
 FROM (SELECT question_id, closed, event_id, POLL_TIMESTAMP AS ts, substr(end_date_iso, 1, 10) AS end_day FROM shaped
       UNION ALL SELECT 's' || CAST(event_id AS VARCHAR), false, event_id, poll_ts, strftime(poll_ts, '%Y-%m-%d')
       FROM base WHERE event_type <> 'error' AND event_id % 7 = 3)
 WHERE NOT {_is(fixtures.TRUNCATED)})"""


@query("landing_open_markets", f"SELECT question_id, end_day FROM {_LANDED} WHERE tagged AND is_active AND NOT closed AND end_day = poll_day")
def q_landing_open(f: Flow) -> DataFrame:
    """Open markets of the landing folder: with the tag, active, ending on the poll day."""
    return ingest.scan_open_markets(_landed_events(f)).select(F.col("id").alias("question_id"), F.substring("endDate", 1, 10).alias("end_day"))


@query("landing_closed_markets", f"SELECT question_id, end_day FROM {_LANDED} WHERE tagged AND closed AND end_day = day_before")
def q_landing_closed(f: Flow) -> DataFrame:
    """Resolved markets of the landing folder: with the tag, ended the day before the poll."""
    return ingest.scan_closed_markets(_landed_events(f)).select(F.col("id").alias("question_id"), F.substring("endDate", 1, 10).alias("end_day"))


@query("landing_corrupt_lines", f"""
SELECT strftime(poll_ts, '%Y-%m-%d') AS day, CAST(sum(1 + (event_id % 7 = 3)::INT + (event_id % 11 = 5)::INT) AS BIGINT) AS lines
FROM base WHERE event_type <> 'error' AND {_is(fixtures.TRUNCATED)} GROUP BY 1""")
def q_landing_corrupt(f: Flow) -> DataFrame:
    """Lines of the landing folder that are no JSON of the schema, by day."""
    path = _landing(f, fixtures.landing_events(f.raw_events), "events")
    bad = landing.corrupt_lines(f.spark, path, schemas.RAW_EVENT)
    return bad.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("lines"))


_LANDED_WX = f"""(SELECT event_id, CASE WHEN {_is(fixtures.NO_CITY)} THEN '' ELSE LOCATION_NAME END AS LOCATION_NAME,
        CASE WHEN NOT {_is(fixtures.ODD_TIME)} THEN POLL_TIMESTAMP END AS POLL_TIMESTAMP,
        CASE WHEN {_is(fixtures.UNKNOWN_KIND)} THEN 'current' ELSE data_type END AS data_type,
        CASE WHEN {_is(fixtures.UNKNOWN_KIND)} THEN NULL ELSE date END AS date, CASE WHEN NOT {_is(fixtures.NO_PLACE)} THEN latitude END AS latitude,
        longitude, cur_t, dmax, dmin FROM wx WHERE NOT {_is(fixtures.TRUNCATED)})"""
_LANDED_FLAT = f"""SELECT LOCATION_NAME, POLL_TIMESTAMP, data_type, date, latitude, longitude, cur_t AS current_temp, dmax AS daily_max,
       dmin AS daily_min FROM {_LANDED_WX}"""


@query("landing_forecast", _LANDED_FLAT + " WHERE data_type = 'forecast'")
def q_landing_forecast(f: Flow) -> DataFrame:
    return _wx_flat(ingest.scan_forecast(_landed_weather(f)))


@query("landing_historical", _LANDED_FLAT + " WHERE data_type = 'historical'")
def q_landing_historical(f: Flow) -> DataFrame:
    return _wx_flat(ingest.scan_historical(_landed_weather(f)))


@query("landing_valid_weather", _LANDED_FLAT + """
 WHERE latitude IS NOT NULL AND data_type IN ('forecast', 'historical') AND LOCATION_NAME <> '' AND POLL_TIMESTAMP IS NOT NULL""")
def q_landing_valid_weather(f: Flow) -> DataFrame:
    """Weather of the landing folder that passes validation, which rejects some for each of its reasons."""
    return _wx_flat(ingest.validate_weather(ingest.shape_weather(_landed_weather(f)))[0])


@query("weather_error_count", f"""
SELECT reject_reason, count(*) AS rejected FROM (
  SELECT CASE WHEN latitude IS NULL THEN 'coordinates' WHEN data_type NOT IN ('forecast', 'historical') THEN 'data_type'
              WHEN LOCATION_NAME = '' THEN 'location' WHEN POLL_TIMESTAMP IS NULL THEN 'poll_timestamp' END AS reject_reason FROM {_LANDED_WX})
WHERE reject_reason IS NOT NULL GROUP BY 1""")
def q_weather_errors(f: Flow) -> DataFrame:
    """The schema errors of the weather feed by reason."""
    return ingest.schema_error_count(ingest.validate_weather(ingest.shape_weather(_landed_weather(f)))[1])


# ====================================================================== routed serving tables

@query("route_by_topic", f"""
SELECT 'correlations' AS table_name, count(*) AS n, count(DISTINCT location_name) AS cities FROM (
  SELECT DISTINCT condition_id, poll_timestamp, data_type, location_name FROM correlations)
UNION ALL SELECT 'accuracy', count(*), count(DISTINCT location_name) FROM accuracy_windows
UNION ALL SELECT 'alerts', count(*), count(DISTINCT location_name) FROM (
  SELECT DISTINCT alert_type, location_name, condition_id, poll_timestamp FROM alerts_t)""")
def q_route(f: Flow) -> DataFrame:
    """All result topics dealt out to their tables, twice (a redelivery), and what the tables then hold."""
    folder = f"{work_folder(f.spark)}/wxodds-serving/{uuid.uuid4().hex}"
    for name, df in (("correlations", f.corr), ("accuracy", f.acc), ("alerts", f.alerts)):
        topics.write_topic(df, routing.topic_folder(f"{folder}/topics", name))
    records = routing.read_topics(f.spark, f"{folder}/topics")
    for batch_id in (0, 1):
        routing.route(records, batch_id, folder)
    tables = {"correlations": f.correlations_table, "accuracy": f.accuracy_table, "alerts": f.alerts_table}
    held = [upsert.read_table(f.spark, f"{folder}/{name}", df.schema).agg(
        F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.count_distinct("location_name").alias("cities")) for name, df in tables.items()]
    return held[0].unionByName(held[1]).unionByName(held[2])


# ====================================================================== rollups

@query("p_active_cities_rollup", """
SELECT count(DISTINCT location_name) AS value FROM correlations
WHERE date_trunc('hour', inserted_at) > (SELECT date_trunc('hour', max(inserted_at)) FROM correlations) - INTERVAL 24 HOUR""")
def q_active_rollup(f: Flow) -> DataFrame:
    """Active cities of the last 24 hours from hourly sketches (exact at this number of cities)."""
    return rollups.active_cities(rollups.city_rollup(f.correlations_table))


@query("latency_p99_daily", """
SELECT date_trunc('day', POLL_TIMESTAMP)::TIMESTAMP AS day, count(*) AS correlations, max(CORRELATION_LATENCY_SEC) AS max_latency_sec,
       true AS within_rank_error
FROM corr GROUP BY 1""")
def q_latency_daily(f: Flow) -> DataFrame:
    """Each day's p99 latency from merged hourly quantile sketches, held against the exact ranks: whether it
    stands within rollups.RANK_ERROR of rank 0.99."""
    daily = rollups.latency_quantile(rollups.latency_rollup(f.corr), F.date_trunc("day", "hour").alias("day"))
    rows = f.corr.select(F.date_trunc("day", "POLL_TIMESTAMP").alias("day"), F.col("CORRELATION_LATENCY_SEC").alias("lat"))
    counts = rows.groupBy("day", "lat").agg(F.count(F.lit(1)).alias("c")).join(daily, "day").groupBy(
        "day", "correlations", "max_latency_sec").agg(
        F.sum(F.when(F.col("lat") < F.col("latency_sec"), F.col("c")).otherwise(0)).alias("under"),
        F.sum(F.when(F.col("lat") <= F.col("latency_sec"), F.col("c")).otherwise(0)).alias("upto"))
    near = ((F.col("under") / F.col("correlations") <= 0.99 + rollups.RANK_ERROR)
            & (F.col("upto") / F.col("correlations") >= 0.99 - rollups.RANK_ERROR))
    return counts.select("day", "correlations", "max_latency_sec", near.alias("within_rank_error"))


@query("v_heatmap_cube", f"""
SELECT question_type, LOCATION_NAME, day_of_week, CAST(GROUPING(question_type, LOCATION_NAME, day_of_week) AS INTEGER) AS level, {_CORR_STATS}
FROM (SELECT *, CAST(dayofweek(POLL_TIMESTAMP) + 1 AS INTEGER) AS day_of_week FROM corr)
GROUP BY CUBE (question_type, LOCATION_NAME, day_of_week)""")
def q_heatmap_cube(f: Flow) -> DataFrame:
    return rollups.heatmap_cube(f.corr)
