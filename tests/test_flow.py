"""Independent second forms for the engine's operators, and plan checks."""
import datetime as dt
import math
import pathlib
import random

import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wxodds.functions.core import python_round4
from wxodds.operators import accuracy, anomaly, asof, correlate, ingest, quality, serving
from wxodds.operators.ordered import BLOCK_SECONDS, running_sums_by_key, time_block
from wxodds.plans.flow import Flow
from wxodds.schemas import ACCURACY_TABLE
from wxodds.sources import fixtures, sinks, tables, topics


def _key(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_asof_equals_union_last_form(flow):
    cols = ["question_id", "w_poll", "w_data_type", "w_daily_max"]
    fast = asof.asof_weather_join(flow.pred, flow.wx)
    plain = asof.asof_weather_join_plain(flow.pred, flow.wx)
    assert _key(fast, cols) == _key(plain, cols)


def test_asof_equals_pandas_merge_asof(flow):
    p = flow.pred.select("question_id", "LOCATION_NAME", "closed", "POLL_TIMESTAMP").toPandas()
    w = flow.wx.select("LOCATION_NAME", "data_type", "POLL_TIMESTAMP").toPandas()
    p["cls"] = p["closed"].map({True: "hist", False: "fcst"})
    w["cls"] = (w["data_type"] == "historical").map({True: "hist", False: "fcst"})
    w["w_poll"] = w["POLL_TIMESTAMP"]
    m = pd.merge_asof(p.sort_values("POLL_TIMESTAMP"), w.sort_values("POLL_TIMESTAMP")[["POLL_TIMESTAMP", "LOCATION_NAME", "cls", "w_poll"]],
                      on="POLL_TIMESTAMP", by=["LOCATION_NAME", "cls"], direction="backward", allow_exact_matches=True)
    expected = sorted((r.question_id, r.w_poll.to_pydatetime()) for r in m.dropna(subset=["w_poll"]).itertuples())
    got = sorted((r.question_id, r.w_poll) for r in asof.asof_weather_join(flow.pred, flow.wx).collect())
    assert got == expected


def test_asof_ties_and_no_weather(spark):
    pred = spark.sql("""
      SELECT * FROM VALUES
        ('q1', 'A', false, TIMESTAMP'2024-01-01 10:00:00'),
        ('q2', 'A', false, TIMESTAMP'2024-01-01 09:00:00'),
        ('q3', 'B', false, TIMESTAMP'2024-01-01 10:00:00')
      AS t(question_id, LOCATION_NAME, closed, POLL_TIMESTAMP)""")
    wx = spark.sql("""
      SELECT 'A' AS LOCATION_NAME, 'forecast' AS data_type, CAST(NULL AS STRING) AS date,
             named_struct('temperature_2m', 1.0D) AS current,
             named_struct('temperature_2m_max', 2.0D, 'temperature_2m_min', 0.0D) AS daily,
             TIMESTAMP'2024-01-01 10:00:00' AS POLL_TIMESTAMP""")
    got = {r.question_id: r.w_poll for r in asof.asof_weather_join(pred, wx).collect()}
    assert set(got) == {"q1"}        # same instant counts as seen; q2 before any weather; B has none


def test_panes_equal_window_function(flow):
    cols = ["LOCATION_NAME", "window_start", "total_count", "correct_count", "accuracy_rate",
            "avg_prediction_error", "max_prediction_error", "bias_score", "closed_accuracy_rate"]
    assert _key(accuracy.accuracy_sliding(flow.corr), cols) == _key(accuracy.accuracy_sliding_plain(flow.corr), cols)


def test_baseline_equals_welford_loop(flow):
    base = anomaly.running_baseline(flow.acc).toPandas()
    acc = anomaly.min_sample_filter(flow.acc).toPandas().sort_values(["LOCATION_NAME", "window_end", "window_start"])
    expected = {}
    for city, g in acc.groupby("LOCATION_NAME"):
        n, mean, m2, prev = 0, 0.0, 0.0, None
        for r in g.itertuples():
            x = r.accuracy_rate
            n += 1
            d = x - mean
            mean += d / n
            m2 += d * (x - mean)
            sd = math.sqrt(m2 / (n - 1)) if n >= 2 else 0.0
            expected[(city, r.window_end)] = (n, mean, sd, prev)
            prev = x
    assert len(base) == len(expected)
    for r in base.itertuples():
        n, mean, sd, prev = expected[(r.LOCATION_NAME, r.window_end)]
        assert r.baseline_n == n and abs(r.baseline_mean - mean) < 1e-9 and abs(r.baseline_sigma - sd) < 1e-9
        assert (r.prev_accuracy_rate is None or math.isnan(r.prev_accuracy_rate)) if prev is None else r.prev_accuracy_rate == prev


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_asof_broadcasts_weather_found_small_at_run_time(flow):
    df = asof.asof_weather_join(flow.pred, flow.wx)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "Cartesian" not in final and "NestedLoop" not in final


def _hour_rows(spark, sf, match):
    f = Flow(spark, f"/root/testdata/{sf}")
    wx = f.wx.cache()
    return asof.interval_buckets(asof.weather_intervals(wx, match)).count(), wx.count()


def test_hour_rows_grow_linearly_in_both_match_modes(spark):
    for match in ("city", "city_date"):
        (small, n), (large, m) = _hour_rows(spark, "sf0.001", match), _hour_rows(spark, "sf0.01", match)
        assert large / small < 2 * m / n


def _wx(spark, rows):
    return spark.createDataFrame(rows, "LOCATION_NAME string, data_type string, date string, t string").select(
        "LOCATION_NAME", "data_type", "date", F.struct(F.lit(1.0).alias("temperature_2m")).alias("current"),
        F.struct(F.lit(2.0).alias("temperature_2m_max"), F.lit(0.0).alias("temperature_2m_min")).alias("daily"),
        F.col("t").cast("timestamp").alias("POLL_TIMESTAMP"))


def test_asof_with_far_future_polls_and_a_gap_of_ten_years(spark):
    wx = _wx(spark, [("A", "forecast", None, "2014-01-01 10:00:00"), ("A", "forecast", None, "2024-01-01 10:00:00"),
                     ("B", "historical", "2024-01-01", "2024-01-01 10:30:00")])
    pred = spark.createDataFrame([("q1", "A", False, "2020-06-01 00:00:00"), ("q2", "A", False, "9000-01-01 00:00:00"),
                                  ("q3", "B", True, "3000-01-01 00:00:00"), ("q4", "B", True, "2024-01-01 10:29:59"),
                                  ("q5", "A", False, "2013-01-01 00:00:00")], "question_id string, LOCATION_NAME string, closed boolean, t string"
                                 ).select("question_id", "LOCATION_NAME", "closed", F.lit("2024-01-01T00:00:00Z").alias("end_date_iso"),
                                          F.col("t").cast("timestamp").alias("POLL_TIMESTAMP"))
    for match in ("city", "city_date"):
        got = {r.question_id: r.w_poll.year for r in asof.asof_weather_join(pred, wx, match).collect()}
        assert got == {"q1": 2014, "q2": 2024, "q3": 2024}
        assert asof.interval_buckets(asof.weather_intervals(wx, match)).count() < 100_000


def test_building_queries_starts_no_job_and_writes_nothing(spark, tmp_path):
    f = Flow(spark, SF_SMALL)
    f.raw_events, f.raw_weather                     # reading a Parquet footer is a job of Spark's own
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    serving.p_alerts_24h(f.alerts_table)
    quality.pending_predictions(f.pred, f.wx)
    accuracy.accuracy_running_total(f.corr)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_stage_tables_are_reused_and_dropped(spark, tmp_path):
    f = Flow(spark, SF_SMALL, stage_dir=str(tmp_path))
    n = f.pred.count()
    written = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert Flow(spark, SF_SMALL, stage_dir=str(tmp_path)).pred.count() == n and written
    assert {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")} == written
    f.drop_stages()
    assert not list(tmp_path.rglob("*.parquet"))


def test_panels_two_days_past_the_data_are_empty(spark, flow):
    late = flow.corr.agg(F.max("POLL_TIMESTAMP")).first()[0] + dt.timedelta(days=2)
    c, a, al = flow.correlations_table, flow.accuracy_table, flow.alerts_table
    assert [x.first()[0] for x in (serving.p_alerts_24h(al, late), serving.p_active_cities(c, late))] == [0, 0]
    assert serving.p_avg_accuracy(a, late).first()[0] is None and serving.p_avg_error(c, late).first()[0] is None
    for df in (serving.p_city_leaderboard(a, late), serving.p_accuracy_by_city(a, as_of=late), serving.v_accuracy_24h_line(a, late),
               serving.p_error_by_city(a, as_of=late), serving.p_alerts_over_time(al, late)):
        assert df.count() == 0
    assert serving.p_alerts_over_time(al, late, hours=24 * 30).count() > 0
    silent = {r.feed: r.alarm for r in quality.producer_silence_now(flow.pred, flow.wx, late).collect()}
    assert silent == {"market": True, "weather": True}


def test_volume_correlation_takes_large_volumes(spark):
    rows = [(f"m{k}", 2.2e9 + k * 1e9, 0.9 if k % 2 else 0.1, 1) for k in range(6)] * 3
    df = spark.createDataFrame(rows, "condition_id string, volume double, yes_price double, ACTUAL_OUTCOME int")
    row = serving.v_volume_accuracy_corr(df).first()
    assert row.n == 6 and -1 <= row.volume_accuracy_corr <= 1


def test_leaderboard_keeps_ties(spark):
    rows = [(f"m{k:02d}", 0.9, 1, 0.1) for k in range(30)]
    df = spark.createDataFrame(rows, "condition_id string, yes_price double, ACTUAL_OUTCOME int, PREDICTION_ERROR double")
    assert quality.market_leaderboard(df).groupBy("board").count().collect()[0]["count"] == 30


def test_dedup_keeps_the_first_of_a_key(spark):
    rows = [("c", "2024-01-01 10:00:00", "q2"), ("c", "2024-01-01 10:00:00", "q1"), ("c", "2024-01-01 11:30:00", "q1"), (None, None, "q9")]
    df = spark.createDataFrame(rows, "condition_id string, t string, question_id string").select(
        "condition_id", F.col("t").cast("timestamp").alias("POLL_TIMESTAMP"), "question_id")
    assert sorted(r.question_id for r in quality.dedup_keys(df).collect()) == ["q1", "q1", "q9"]


def test_dense_city_day_spreads_over_blocks(spark):
    df = spark.range(5000).select(F.lit("A").alias("LOCATION_NAME"), F.timestamp_seconds(F.col("id") * 17 + 1_700_006_400).alias("ts"), "id")
    assert df.select(time_block("ts", BLOCK_SECONDS)).distinct().count() >= 20
    got = running_sums_by_key(df, ["LOCATION_NAME"], "ts", ["id"], {"n": F.lit(1).cast("long")})
    assert [r.n for r in got.orderBy("ts", "id").collect()] == list(range(1, 5001))


def test_rounding_equals_python(spark):
    rng = random.Random(1)
    values = [k / 100_000 for k in range(0, 200_000, 7)] + [rng.random() * 3 for _ in range(3000)] + [0.90025, 1.00005, 0.00005, 2.5e-5, 0.0, -0.90025]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", python_round4("v").alias("r"))
    assert [(r.v, r.r) for r in df.collect() if r.r != round(r.v, 4)] == []


def test_rows_that_do_not_fit_are_kept_aside(spark, flow):
    df = flow.acc.limit(3).withColumn("accuracy_rate", F.lit(12345.0)).unionByName(flow.acc.limit(2))
    assert sinks.accuracy_rows(df).count() == 2
    assert sinks.misfits(df, ACCURACY_TABLE, sinks.ACC_SOURCE).count() == 3


def test_malformed_topic_records_are_counted(spark, flow, tmp_path):
    topics.write_topic(flow.acc.limit(4), str(tmp_path / "t"))
    spark.createDataFrame([("{broken",), ("nothing",)], "value string").write.mode("append").text(str(tmp_path / "t"))
    assert topics.read_topic(spark, str(tmp_path / "t"), flow.acc.schema).count() == 4
    assert topics.malformed_count(spark, str(tmp_path / "t"), flow.acc.schema).first()[0] == 2


def test_plan_has_no_python_udf_in_batch(flow):
    for df in (flow.corr, flow.acc, flow.alerts):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_plan_prunes_columns_at_scan(flow):
    plan = flow.corr.select("LOCATION_NAME").where(F.col("ACTUAL_OUTCOME") == 1)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "ReadSchema: struct<LOCATION_NAME:string,ACTUAL_OUTCOME:int>" in plan
    assert "PushedFilters: [IsNotNull(ACTUAL_OUTCOME), EqualTo(ACTUAL_OUTCOME,1)]" in plan


def test_parsing_is_dealt_to_tasks_of_a_like_size_however_large_the_table(spark, scratch, monkeypatch):
    """One file of one row group, ids null in half of its rows: the tasks grow in number, not in size."""
    rows = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("event_id"), (F.col("id") % 997).alias("user_id"),
                                      F.lit("view").alias("event_type"), (F.col("id") / 100.0).alias("value"))
    rows.coalesce(1).write.parquet(f"{scratch}/events.parquet")
    size = sum(f.stat().st_size for f in pathlib.Path(f"{scratch}/events.parquet").glob("*.parquet"))
    cores = spark.sparkContext.defaultParallelism
    assert tables.shares(size, cores) == cores and tables.shares(10 * cores * tables.SHARE_BYTES, cores) == 10 * cores
    monkeypatch.setattr(tables, "SHARE_BYTES", size // (5 * cores))
    dealt = tables.spread(tables.table(spark, scratch, "events"), *fixtures.DEALT_BY)
    per_task = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 40_000 and max(per_task) < 3 * 40_000 / (5 * cores)
    raw = fixtures.raw_events(spark, scratch)
    assert raw.rdd.getNumPartitions() >= 5 * cores
    # events without markets and of other topics come out as before: one main event a row, the others by id
    ids = spark.range(0, 40_000, 2)
    assert raw.count() == 40_000 + ids.where("id % 7 = 3").count() + ids.where("id % 11 = 5").count()
    assert raw.where(F.size("markets") == 0).count() == ids.where("id % 11 = 5").count()
    assert raw.where("slug is null and title is null and markets is null").count() == 0


def test_price_sum_is_summed_once_a_row(spark):
    """The rounding names its argument many times; the plan holds one sum over the tokens."""
    m = spark.createDataFrame([("c", "q", "Will the highest temperature in Rome be 20°C on May 1?", None, "2024-01-01T00:00:00Z", "s", "2024-01-01",
                                "2024-01-01", False, True, 1.0, "t", [("Yes", 0.3, None), ("No", 0.70004, None)])],
                              "conditionId string, id string, question string, event_slug string, poll_text string, slug string, endDate string, "
                              "startDate string, closed boolean, active boolean, volume double, title string, "
                              "tokens array<struct<outcome string, price double, winner boolean>>")
    shaped = ingest.shape_prediction(m.union(m).repartition(1))
    assert {(r.price_sum, r.arbitrage_flag) for r in shaped.collect()} == {(1.0, False)}
    plan = shaped._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(tokens") == 1


def test_question_is_parsed_before_the_join_not_once_a_condition(spark):
    """On the pairs, the conditions of scoring repeated the parsing wherever they named a column of it."""
    m = spark.createDataFrame([("c", "q", "Will the highest temperature in Rome be 20°C or above on May 1?", False, "Rome", 1704067200)] * 2
                              + [("d", "r", "Will the temperature in Rome be 77°F on May 1?", True, "Rome", 1704067200)],
                              "condition_id string, question_id string, question string, closed boolean, LOCATION_NAME string, s long")
    token = F.struct(F.lit("Yes").alias("outcome"), F.lit(0.25).alias("price"), F.lit(None).cast("boolean").alias("winner"))
    m = m.select("*", F.timestamp_seconds("s").alias("POLL_TIMESTAMP"), F.array(token).alias("tokens"), F.lit(False).alias("arbitrage_flag")).drop("s")
    w = spark.createDataFrame([("forecast", "Rome", 21.0, 25.0), ("historical", "Rome", 25.5, 27.0)], "data_type string, LOCATION_NAME string, now double, high double")
    w = w.select("data_type", "LOCATION_NAME", F.lit("2024-01-01").alias("date"), F.timestamp_seconds(F.lit(1704067200)).alias("POLL_TIMESTAMP"),
                 F.struct(F.col("now").alias("temperature_2m")).alias("current"),
                 F.struct(F.col("high").alias("temperature_2m_max"), F.lit(1.0).alias("temperature_2m_min")).alias("daily"))
    scored = correlate.correlate(m, w)
    got = sorted((r.condition_id, r.question_type, r.target_temp, r.actual_temp, r.ACTUAL_OUTCOME, r.yes_price) for r in scored.collect())
    assert got == [("c", "HIGHEST", 20.0, 25.0, 1, 0.25)] * 2 + [("d", "EXACT", 25.0, 25.5, 1, 0.25)]
    above_the_join = scored._jdf.queryExecution().optimizedPlan().toString().split("Join ")[0]
    assert "regexp_extract" not in above_the_join and "lower(" not in above_the_join
