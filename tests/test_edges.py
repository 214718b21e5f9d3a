"""Edge rows from FIXTURES.md §3: validation, suppression, arbitrage tolerance, missing weather
values and the 10-point anomaly threshold."""
import datetime as dt
import math

from pyspark.sql import functions as F

from wxodds import schemas
from wxodds.operators import anomaly, correlate, ingest


def _event(spark, rows):
    """rows: (title, question, prices_json, outcomes_json, winner, cond, qid, closed, poll_text)"""
    data = []
    for title, q, prices, outcomes, winner, cond, qid, closed, poll in rows:
        day = poll[:10]
        end = (dt.date.fromisoformat(day) - dt.timedelta(days=1 if closed else 0)).isoformat() + "T12:00:00Z"
        market = (q, prices, outcomes, winner, cond, qid, "s", end, end, closed, not closed, 1.0)
        data.append((title, "slug", ["daily-temperature"], [market], poll))
    return spark.createDataFrame(data, schemas.RAW_EVENT)


def test_validation_and_suppression(spark):
    q = "Will the highest temperature in Tokyo be 20°C on June 3?"
    raw = _event(spark, [
        ("T", q, '["0.4","0.6"]', '["Yes","No"]', None, "c1", "1", False, "2024-06-03T10:00:00Z"),
        ("T", q, '["0.4","0.6"]', '["Yes","No"]', None, "c1", "2", False, "2024-06-03T10:05:00Z"),  # repeat: suppressed
        ("T", q, '["0.5","0.5"]', '["Yes","No"]', None, "c1", "3", False, "2024-06-03T10:10:00Z"),
        ("T", q, '["1.0","0.0"]', '["Yes","No"]', "Yes", "c2", "4", True, "2024-06-03T10:00:00Z"),
        ("T", q, '["1.0","0.0"]', '["Yes","No"]', "Yes", "c2", "5", True, "2024-06-03T10:05:00Z"),  # closed repeat: kept
        ("T", q, '["1.0"]', '["Yes"]', None, "c3", "6", False, "2024-06-03T10:00:00Z"),              # one token
        ("T", q, '["0.4","0.6"]', '["Yes","No"]', None, "c4", "7", False, "2024-06-03T10:00:00.5Z"), # fractional s
        ("T", q, '["1.2","0.6"]', '["Yes","No"]', None, "c5", "8", False, "2024-06-03T10:00:00Z"),  # price > 1
    ])
    shaped = ingest.shaped_predictions(raw)
    kept = ingest.price_change_only(shaped)
    good, bad = ingest.validate_prediction(kept)
    assert sorted(r.question_id for r in good.collect()) == ["1", "3", "4", "5"]
    assert {r.question_id: r.reject_reason for r in bad.collect()} == {"6": "tokens", "7": "poll_timestamp", "8": "token"}
    winners = {r.question_id: [t.winner for t in r.tokens] for r in good.collect()}
    assert winners["4"] == [True, False] and winners["1"] == [None, None]


def test_arbitrage_tolerance(spark):
    q = "Will the temperature in Lima be 20°C?"
    raw = _event(spark, [
        ("T", q, '["0.51","0.50"]', '["Yes","No"]', None, "a", "1", False, "2024-06-03T10:00:00Z"),
        ("T", q, '["0.5101","0.50"]', '["Yes","No"]', None, "b", "2", False, "2024-06-03T10:00:00Z"),
        ("T", q, '["0.505","0.50"]', '["Yes","No"]', None, "c", "3", False, "2024-06-03T10:00:00Z"),
    ])
    got = {r.question_id: (r.price_sum, r.arbitrage_flag) for r in ingest.shaped_predictions(raw).collect()}
    # the flag is decided on the unrounded sum, like the reference (0.51 + 0.50 - 1 > 0.01 in doubles)
    assert got["1"] == (1.01, abs(0.51 + 0.50 - 1.0) > 0.01)
    assert got["2"] == (1.0101, True) and got["3"] == (1.005, False)


def test_missing_daily_max_drops_highest_question(spark):
    pairs = spark.sql("""
      SELECT 'c' AS condition_id, q AS question, false AS closed,
             array(named_struct('outcome','Yes','price',0.5D,'winner',CAST(NULL AS BOOLEAN))) AS tokens,
             'X' AS LOCATION_NAME, TIMESTAMP'2024-06-03 12:00:00' AS POLL_TIMESTAMP, false AS arbitrage_flag,
             'forecast' AS w_data_type, 15.0D AS w_current_temp, CAST(NULL AS DOUBLE) AS w_daily_max,
             10.0D AS w_daily_min, TIMESTAMP'2024-06-03 11:55:00' AS w_poll
      FROM VALUES ('Will the highest temperature in X be 20°C?'), ('Will the temperature in X be 15°C?') AS t(q)""")
    got = correlate.score_pairs(pairs).collect()
    assert [(r.question_type, r.actual_temp, r.ACTUAL_OUTCOME) for r in got] == [("EXACT", 15.0, 1)]


def test_anomaly_needs_ten_points(spark):
    def acc_rows(n_points):
        base = dt.datetime(2024, 1, 1)
        rates = [0.5, 0.52] * 20
        rows = [("X", base + dt.timedelta(minutes=15 * i), base + dt.timedelta(minutes=15 * i + 60), 5, rates[i])
                for i in range(n_points - 1)]
        i = n_points - 1
        rows.append(("X", base + dt.timedelta(minutes=15 * i), base + dt.timedelta(minutes=15 * i + 60), 5, 0.95))
        return spark.createDataFrame(rows, "LOCATION_NAME string, window_start timestamp, window_end timestamp, "
                                           "total_count long, accuracy_rate double")
    nine = anomaly.alert_accuracy_anomaly(anomaly.running_baseline(acc_rows(9))).count()
    ten = anomaly.alert_accuracy_anomaly(anomaly.running_baseline(acc_rows(10))).collect()
    assert nine == 0 and len(ten) == 1
    assert ten[0].detail.startswith("accuracy=95.0% deviates >2σ from baseline mean=")
    few = acc_rows(10).withColumn("total_count", F.lit(2))
    assert anomaly.running_baseline(few).count() == 0           # windows with < 3 rows are ignored


def test_baseline_of_more_windows_than_a_long_holds_the_squares_of(spark):
    n = 400_000                                                 # n * sum r^2 is about 1.4e19
    acc = spark.range(0, n, 1, 4).selectExpr(
        "'X' as LOCATION_NAME", "timestamp_seconds(id * 900) as window_start", "timestamp_seconds(id * 900 + 3600) as window_end",
        "5L as total_count", "if(id % 2 = 0, 1.0d, 0.9d) as accuracy_rate")
    last = anomaly.running_baseline(acc).orderBy(F.col("window_end").desc()).first()
    s1, s2 = n // 2 * 19_000, n // 2 * 181_000_000
    assert n * s2 > 2 ** 63
    assert (last.baseline_n, last.baseline_mean, last.prev_accuracy_rate) == (n, s1 / n / 10_000.0, 1.0)
    assert last.baseline_sigma == math.sqrt(float(n * s2 - s1 * s1) / (n * (n - 1))) / 10_000.0


def test_baseline_sums_up_to_the_largest_longs(spark):
    top = 2 ** 63 - 1
    rows = [(2, 7, 37), (3_000_000, 3 * 10 ** 10, 3 * 10 ** 14), (2_000_000_000, 10 ** 9, top), (1, 5, 25)]
    base = spark.createDataFrame(rows, "baseline_n long, _s1 long, _s2 long")
    got = {r.baseline_n: r.baseline_sigma for r in anomaly.baseline_columns(base).collect()}
    assert got == {n: math.sqrt(float(n * s2 - s1 * s1) / (n * (n - 1))) / 10_000.0 if n > 1 else 0.0 for n, s1, s2 in rows}
