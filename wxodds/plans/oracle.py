"""DuckDB oracle SQL.

An independent plain-SQL statement of every registered query over the driver's tables.  The
fixture is derived here straight from the flat `events` columns (no nested JSON, no ingest
operators), the as-of match uses DuckDB's ASOF JOIN, sliding windows fan each row out to its
four windows, and running baselines are ordinary window frames over the whole city.
"""
from __future__ import annotations

from wxodds.sources.fixtures import CITIES, EPOCH_2024, GEO_MISSING_CITY, QUESTION_KINDS


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def fmt(x: str, digits: int) -> str:
    """Java '%.Nf': half-up rounding of the shortest decimal form of the double."""
    return (f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) "
            f"AS DECIMAL(38,{digits}))::VARCHAR")


def r4(x: str) -> str:
    return f"(floor(({x}) * 10000 + 0.5) / 10000)"


def py_r4(x: str) -> str:
    """Python's round(x, 4): nearest 4-decimal number to the exact double, by its exact decimal text."""
    high = f"((({x}) * 134217729) - ((({x}) * 134217729) - ({x})))"
    over = f"(({x}) * 10000 - floor(({x}) * 10000) - 0.5) + (({high} * 10000 - ({x}) * 10000) + (({x}) - {high}) * 10000)"
    low = f"floor(({x}) * 10000)"
    return f"(({low} + CASE WHEN {over} > 0 OR ({over} = 0 AND {low} % 2 <> 0) THEN 1 ELSE 0 END) / 10000)"


def ratio(num: str, den: str, scale: int = 10000) -> str:
    return f"(floor(({num}) / ({den}) + 0.5) / {scale})"


def ratio_away(num: str, den: str, scale: int) -> str:
    return f"(sign({num}) * floor(abs({num}) / ({den}) + 0.5) / {scale})"


VALID_LOC = "(LOCATION_NAME IS NOT NULL AND LOCATION_NAME <> '' AND LOCATION_NAME <> 'UNKNOWN')"

_POLL_TS = f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds({EPOCH_2024} + event_id * 30))"

PRELUDE = f"""
base AS (
  SELECT event_id, user_id, event_type,
         CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents,
         CAST(user_id % 25 AS INTEGER) AS k,
         ({_list(CITIES)})[CAST(user_id % 25 AS INTEGER) + 1] AS city,
         {_POLL_TS} AS poll_ts
  FROM events
),
mk AS (
  SELECT *, (event_id % 4 = 0) AS closed, (k % 5 = 1) AS is_f,
         (event_id * 37 + cents) % 101 AS yes_cents
  FROM base WHERE event_type <> 'error'
),
shaped AS (
  SELECT '0x' || CAST(user_id % 50 AS VARCHAR) AS condition_id,
         CAST(event_id AS VARCHAR) AS question_id,
         'Will the ' || ({_list(QUESTION_KINDS)})[CAST(event_id % 3 AS INTEGER) + 1] || ' in ' || city
           || ' be ' || CAST(CASE WHEN is_f THEN 50 + cents % 27 ELSE 10 + cents % 15 END AS VARCHAR)
           || CASE WHEN is_f THEN '°F' ELSE '°C' END
           || CASE WHEN event_id % 5 = 0 THEN ' or above' WHEN event_id % 5 = 1 THEN ' or below' ELSE '' END
           || ' on January 5?' AS question,
         'wx-' || CAST(event_id AS VARCHAR) AS market_slug,
         strftime(poll_ts - to_days(CAST(CASE WHEN closed THEN 1 ELSE 0 END AS INTEGER)), '%Y-%m-%d') || 'T12:00:00Z' AS end_date_iso,
         closed, NOT closed AS active,
         CAST(yes_cents AS DOUBLE) / 100 AS yes_p,
         CAST(100 - yes_cents + CASE WHEN event_id % 20 = 0 THEN 3 ELSE 0 END AS DOUBLE) / 100 AS no_p,
         CASE WHEN closed AND event_id % 12 <> 0 THEN (cents % 2 = 0) END AS yes_win,
         city AS LOCATION_NAME, poll_ts AS POLL_TIMESTAMP, CAST(cents AS DOUBLE) AS volume, event_id
  FROM mk
),
shaped2 AS (
  SELECT *, yes_p + no_p AS raw_sum, {py_r4('yes_p + no_p')} AS price_sum,
         abs(yes_p + no_p - 1.0) > 0.01 AS arbitrage_flag
  FROM shaped
),
suppressed AS (
  SELECT * FROM shaped2 WHERE closed
  UNION ALL
  SELECT * EXCLUDE (py, pn) FROM (
    SELECT *, lag(yes_p) OVER w AS py, lag(no_p) OVER w AS pn FROM shaped2 WHERE NOT closed
    WINDOW w AS (PARTITION BY condition_id ORDER BY POLL_TIMESTAMP, question_id))
  WHERE NOT (py IS NOT NULL AND py = yes_p AND pn = no_p)
),
pred AS (
  SELECT * FROM suppressed WHERE yes_p BETWEEN 0 AND 1 AND no_p BETWEEN 0 AND 1
),
wx AS (
  SELECT city AS LOCATION_NAME, poll_ts AS POLL_TIMESTAMP,
         CASE WHEN event_id % 3 = 0 THEN 'historical' ELSE 'forecast' END AS data_type,
         CASE WHEN event_id % 3 = 0 THEN strftime(poll_ts - to_days(1), '%Y-%m-%d') END AS date,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE 8 + CAST(cents % 150 AS DOUBLE) / 10 END AS cur_t,
         10 + CAST(cents % 150 AS DOUBLE) / 10 AS dmax,
         4 + CAST(cents % 150 AS DOUBLE) / 10 AS dmin,
         CAST(k * 3 - 36 AS DOUBLE) AS latitude, CAST(k * 13 - 156 AS DOUBLE) AS longitude,
         event_id
  FROM base WHERE event_type = 'error'
),
geo AS (
  SELECT city, CAST(i * 3 - 36 AS DOUBLE) AS lat, CAST(i * 13 - 156 AS DOUBLE) AS lon
  FROM (SELECT unnest({_list(CITIES)}) AS city, unnest(range({len(CITIES)})) AS i)
  WHERE city <> '{GEO_MISSING_CITY}'
),
pm AS (SELECT *, CASE WHEN closed THEN 'hist' ELSE 'fcst' END AS cls FROM pred),
wc AS (SELECT *, CASE WHEN data_type = 'historical' THEN 'hist' ELSE 'fcst' END AS cls FROM wx),
pairs AS (
  SELECT pm.*, wc.data_type AS w_type, wc.cur_t, wc.dmax, wc.dmin, wc.POLL_TIMESTAMP AS w_poll
  FROM pm ASOF JOIN wc
    ON pm.LOCATION_NAME = wc.LOCATION_NAME AND pm.cls = wc.cls AND pm.POLL_TIMESTAMP >= wc.POLL_TIMESTAMP
),
typed AS (
  SELECT *, lower(question) AS lq,
    CASE WHEN lower(question) LIKE '%highest%' OR lower(question) LIKE '%maximum%' OR lower(question) LIKE '%high temp%' THEN 'HIGHEST'
         WHEN lower(question) LIKE '%lowest%' OR lower(question) LIKE '%minimum%' OR lower(question) LIKE '%low temp%' THEN 'LOWEST'
         ELSE 'EXACT' END AS qt,
    CAST(regexp_extract(question, '(\\d+(?:\\.\\d+)?)\\s*°?([CF])', 1) AS DOUBLE) AS t_raw,
    regexp_extract(question, '(\\d+(?:\\.\\d+)?)\\s*°?([CF])', 2) AS t_unit
  FROM pairs
),
valued AS (
  SELECT *,
    CASE qt WHEN 'HIGHEST' THEN dmax WHEN 'LOWEST' THEN dmin ELSE coalesce(cur_t, dmax) END AS actual,
    CASE WHEN t_unit = 'F' THEN (t_raw - 32) * CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE) ELSE t_raw END AS target
  FROM typed
),
outcomes AS (
  SELECT *,
    CAST(CASE WHEN closed AND yes_win IS NOT NULL THEN yes_win
         WHEN lq LIKE '%above%' OR lq LIKE '%exceed%' OR lq LIKE '%more than%' OR lq LIKE '%at least%' THEN actual > target
         WHEN lq LIKE '%below%' OR lq LIKE '%under%' OR lq LIKE '%less than%' THEN actual < target
         ELSE abs(actual - target) <= 1.0 END AS INTEGER) AS outcome
  FROM valued WHERE actual IS NOT NULL AND target IS NOT NULL
),
corr_ext AS (
  SELECT condition_id, question, qt AS question_type, LOCATION_NAME, yes_p AS yes_price,
         target AS target_temp, actual AS actual_temp, w_type AS data_type, closed AS market_closed,
         outcome AS ACTUAL_OUTCOME, {r4('abs(yes_p - outcome)')} AS PREDICTION_ERROR,
         CAST(abs(epoch_us(w_poll) - epoch_us(POLL_TIMESTAMP)) // 1000000 AS BIGINT) AS CORRELATION_LATENCY_SEC,
         arbitrage_flag, POLL_TIMESTAMP, volume, price_sum, question_id
  FROM outcomes
),
corr AS (
  SELECT condition_id, question, question_type, LOCATION_NAME, yes_price, target_temp, actual_temp,
         data_type, market_closed, ACTUAL_OUTCOME, PREDICTION_ERROR, CORRELATION_LATENCY_SEC,
         arbitrage_flag, POLL_TIMESTAMP
  FROM corr_ext
),
cv AS (
  SELECT *, CAST(floor(PREDICTION_ERROR * 10000 + 0.5) AS BIGINT) AS err_i,
         CAST(floor(coalesce(yes_price - ACTUAL_OUTCOME, 0) * 100000000 + 0.5) AS BIGINT) AS bias_i
  FROM corr_ext
  WHERE {VALID_LOC} AND ACTUAL_OUTCOME IS NOT NULL AND PREDICTION_ERROR IS NOT NULL AND NOT isnan(PREDICTION_ERROR)
),
cw AS (
  SELECT *, TIMESTAMP '1970-01-01 00:00:00' + to_microseconds((epoch_us(POLL_TIMESTAMP) // 900000000 - j) * 900000000) AS window_start
  FROM (SELECT *, unnest([0, 1, 2, 3]) AS j FROM cv)
),
acc AS (
  SELECT LOCATION_NAME, window_start, window_start + INTERVAL 1 HOUR AS window_end,
         count(*) AS total_count,
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
  FROM cw GROUP BY LOCATION_NAME, window_start
),
af AS (
  SELECT *, CAST(floor(accuracy_rate * 10000 + 0.5) AS BIGINT) AS r
  FROM acc WHERE {VALID_LOC} AND accuracy_rate IS NOT NULL AND total_count >= 3
),
ab AS (
  SELECT *, count(*) OVER w AS n, sum(r) OVER w AS s1, sum(r * r) OVER w AS s2,
         lag(accuracy_rate) OVER w0 AS prev
  FROM af
  WINDOW w AS (PARTITION BY LOCATION_NAME ORDER BY window_end, window_start
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         w0 AS (PARTITION BY LOCATION_NAME ORDER BY window_end, window_start)
),
ab2 AS (
  SELECT *, s1 / n AS mean_r,
         CASE WHEN n >= 2 THEN sqrt((n * s2 - s1 * s1) / (n * (n - 1))) ELSE 0.0 END AS sigma_r
  FROM ab
),
alerts AS (
  SELECT 'ACCURACY_DROP' AS alert_type, LOCATION_NAME, CAST(NULL AS VARCHAR) AS condition_id,
         'accuracy dropped ' || {fmt('prev * 100', 1)} || '% → ' || {fmt('accuracy_rate * 100', 1)}
           || '% (delta=' || {fmt('(prev - accuracy_rate) * 100', 1)} || '%)' AS detail,
         window_end AS POLL_TIMESTAMP, window_end AS ALERT_TIMESTAMP
  FROM ab2 WHERE prev IS NOT NULL AND (prev - accuracy_rate) > 0.20
  UNION ALL
  SELECT 'ACCURACY_ANOMALY', LOCATION_NAME, NULL,
         'accuracy=' || {fmt('accuracy_rate * 100', 1)} || '% deviates >2σ from baseline mean='
           || {fmt('mean_r / 100', 1)} || '% σ=' || {fmt('sigma_r / 10000', 3)},
         window_end, window_end
  FROM ab2 WHERE n >= 10 AND sigma_r > 100 AND abs(r - mean_r) > 2 * sigma_r
  UNION ALL
  SELECT 'ARBITRAGE', LOCATION_NAME, condition_id, 'price sum != 1.0 | question: ' || question,
         POLL_TIMESTAMP, POLL_TIMESTAMP
  FROM corr WHERE {VALID_LOC} AND arbitrage_flag
  UNION ALL
  SELECT 'HIGH_ERROR', LOCATION_NAME, condition_id,
         'prediction_error=' || {fmt('PREDICTION_ERROR', 3)} || ' yes_price=' || {fmt('yes_price', 3)}
           || ' target=' || {fmt('target_temp', 1)} || '°C actual=' || {fmt('actual_temp', 1)} || '°C',
         POLL_TIMESTAMP, POLL_TIMESTAMP
  FROM corr WHERE {VALID_LOC} AND PREDICTION_ERROR > 0.70
),
correlations AS (
  SELECT condition_id, question, question_type, LOCATION_NAME AS location_name,
         CAST(yes_price AS DECIMAL(6,4)) AS yes_price, CAST(target_temp AS DECIMAL(6,2)) AS target_temp,
         CAST(actual_temp AS DECIMAL(6,2)) AS actual_temp, data_type, market_closed,
         CAST(ACTUAL_OUTCOME AS SMALLINT) AS actual_outcome,
         CAST(PREDICTION_ERROR AS DECIMAL(6,4)) AS prediction_error,
         CAST(CORRELATION_LATENCY_SEC AS INTEGER) AS correlation_latency_sec, arbitrage_flag,
         POLL_TIMESTAMP AS poll_timestamp, POLL_TIMESTAMP AS inserted_at
  FROM corr
),
accuracy_windows AS (
  SELECT LOCATION_NAME AS location_name, window_start, window_end,
         CAST(total_count AS INTEGER) AS total_count, CAST(correct_count AS INTEGER) AS correct_count,
         CAST(accuracy_rate AS DECIMAL(6,4)) AS accuracy_rate,
         CAST(avg_prediction_error AS DECIMAL(6,4)) AS avg_prediction_error,
         CAST(max_prediction_error AS DECIMAL(6,4)) AS max_prediction_error,
         CAST(bias_score AS DECIMAL(8,4)) AS bias_score,
         CAST(closed_count AS INTEGER) AS closed_count,
         CAST(closed_correct_count AS INTEGER) AS closed_correct_count,
         CAST(closed_accuracy_rate AS DECIMAL(6,4)) AS closed_accuracy_rate,
         window_end AS inserted_at
  FROM acc
),
alerts_t AS (
  SELECT alert_type, LOCATION_NAME AS location_name, condition_id, detail,
         POLL_TIMESTAMP AS poll_timestamp, ALERT_TIMESTAMP AS alert_timestamp,
         ALERT_TIMESTAMP AS inserted_at
  FROM alerts
),
as_of AS (SELECT max(POLL_TIMESTAMP) AS t FROM corr)
"""


def q(body: str) -> str:
    """Full oracle statement: the shared prelude plus the query's own SELECT (a leading WITH
    of the body is merged into the prelude's CTE list)."""
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + PRELUDE.strip() + ",\n" + body[5:]
    return "WITH " + PRELUDE.strip() + "\n" + body
