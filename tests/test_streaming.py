"""Stream = batch: the streaming jobs fed with the batch stages, one hour per file, give the
batch results; restarts and replayed batches add no duplicates."""
import glob
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from wxodds import schemas
from wxodds.sources import sinks
from wxodds.streaming import jobs


def _slices(df, ts_col, out_dir, fmt="parquet", seconds=3600):
    """Write df as one file per time slice, in time order (the file source reads oldest first)."""
    os.makedirs(out_dir, exist_ok=True)
    tmp = out_dir + "_tmp"
    d = df.withColumn("_slice", F.floor(F.unix_seconds(F.col(ts_col)) / seconds))
    ids = sorted(r[0] for r in d.select("_slice").distinct().collect())
    for n, i in enumerate(ids):
        part = d.where(F.col("_slice") == i).drop("_slice").coalesce(1)
        part.write.mode("overwrite").format(fmt).save(f"{tmp}/{i}")
        src = [p for p in glob.glob(f"{tmp}/{i}/part-*") if not p.endswith(".crc")][0]
        shutil.move(src, f"{out_dir}/{i:012d}.{fmt}")
        t = 1_700_000_000 + 10 * n                 # arrival order = time order
        os.utime(f"{out_dir}/{i:012d}.{fmt}", (t, t))
    return ids


def _run(df, out, ck, key):
    q = jobs.start_sink(df, out, ck, key)
    q.awaitTermination()
    return q


def _keyset(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def landed(spark, flow, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("landing"))
    _slices(flow.pred, "POLL_TIMESTAMP", f"{base}/pred")
    _slices(flow.wx, "POLL_TIMESTAMP", f"{base}/wx")
    _slices(flow.corr, "POLL_TIMESTAMP", f"{base}/corr")
    _slices(flow.acc, "window_end", f"{base}/acc")
    return base


def test_correlation_stream_equals_batch(spark, flow, landed, scratch):
    pred = jobs.read_stream(spark, f"{landed}/pred", flow.pred.schema, max_files_per_trigger=1)
    wx = jobs.read_stream(spark, f"{landed}/wx", flow.wx.schema, max_files_per_trigger=1)
    _run(jobs.correlation_stream(pred, wx), f"{scratch}/out", f"{scratch}/ck", sinks.CORRELATIONS_KEY[:2])
    got = spark.read.parquet(f"{scratch}/out").drop("batch_id")
    cols = schemas.CORR_COLUMNS
    assert _keyset(got, cols) == _keyset(flow.corr, cols)


def test_accuracy_stream_emits_closed_windows_equal_to_batch(spark, flow, landed, scratch):
    corr = jobs.read_stream(spark, f"{landed}/corr", flow.corr.schema, max_files_per_trigger=1)
    _run(jobs.accuracy_stream(corr), f"{scratch}/out", f"{scratch}/ck", ["LOCATION_NAME", "window_start"])
    got = spark.read.parquet(f"{scratch}/out").drop("batch_id")
    cols = schemas.ACC_COLUMNS
    got_rows, all_rows = _keyset(got, cols), set(_keyset(flow.acc, cols))
    assert got_rows and set(got_rows) <= all_rows and len(got_rows) == len(set(got_rows))
    max_ts = flow.corr.agg(F.max("POLL_TIMESTAMP")).first()[0]
    closed = flow.acc.where(F.col("window_end") <= F.lit(max_ts) - F.expr("INTERVAL 30 MINUTES"))
    assert set(_keyset(closed, cols)) <= set(got_rows)


def test_alert_stream_equals_batch(spark, flow, landed, scratch):
    acc = jobs.read_stream(spark, f"{landed}/acc", flow.acc.schema, max_files_per_trigger=1)
    corr = jobs.read_stream(spark, f"{landed}/corr", flow.corr.schema, max_files_per_trigger=1)
    _run(jobs.alert_stream(acc, corr), f"{scratch}/out", f"{scratch}/ck", sinks.ALERTS_KEY)
    got = spark.read.parquet(f"{scratch}/out").drop("batch_id")
    cols = schemas.ALERT_COLUMNS
    assert _keyset(got, cols) == _keyset(flow.alerts, cols)


def test_prediction_stream_equals_batch(spark, flow, scratch):
    raw = flow.raw_events.withColumn("_t", F.to_timestamp("POLL_TIMESTAMP", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    _slices(raw, "_t", f"{scratch}/raw", fmt="json")
    stream = jobs.read_stream(spark, f"{scratch}/raw", schemas.RAW_EVENT, fmt="json", max_files_per_trigger=1)
    _run(jobs.predictions_stream(stream), f"{scratch}/out", f"{scratch}/ck", ["question_id"])
    got = spark.read.parquet(f"{scratch}/out")
    assert _keyset(got, ["question_id", "POLL_TIMESTAMP"]) == _keyset(flow.pred, ["question_id", "POLL_TIMESTAMP"])


def test_prices_are_forgotten_after_their_span(spark, flow, scratch):
    from wxodds.operators import ingest
    raw = flow.raw_events.withColumn("_t", F.to_timestamp("POLL_TIMESTAMP", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    _slices(raw, "_t", f"{scratch}/raw", fmt="json")
    key = ["question_id", "POLL_TIMESTAMP"]
    shaped = ingest.shaped_predictions(flow.raw_events)
    counts = {}
    for span in (60, 36_000_000):
        stream = jobs.read_stream(spark, f"{scratch}/raw", schemas.RAW_EVENT, fmt="json", max_files_per_trigger=24)
        _run(jobs.predictions_stream(stream, span, "2 hours"), f"{scratch}/out{span}", f"{scratch}/ck{span}", ["question_id"])
        want, _ = ingest.validate_prediction(ingest.price_change_only(shaped, span))
        got = _keyset(spark.read.parquet(f"{scratch}/out{span}"), key)
        assert got == _keyset(want, key)
        counts[span] = len(got)
    assert counts[60] > counts[36_000_000] == flow.pred.count()      # the shorter span does forget, the longer one nothing


def test_restart_and_replay_add_no_duplicates(spark, flow, landed, scratch):
    src = f"{scratch}/corr_in"
    files = sorted(glob.glob(f"{landed}/corr/*.parquet"))
    os.makedirs(src)
    half = len(files) // 2
    for f in files[:half]:
        shutil.copy(f, src)
    corr = lambda: jobs.read_stream(spark, src, flow.corr.schema, max_files_per_trigger=2)
    key = ["alert_type", "condition_id", "POLL_TIMESTAMP"]
    _run(jobs.correlation_alerts_stream(corr()), f"{scratch}/out", f"{scratch}/ck", key)
    for f in files[half:]:
        shutil.copy(f, src)
    _run(jobs.correlation_alerts_stream(corr()), f"{scratch}/out", f"{scratch}/ck", key)
    got = spark.read.parquet(f"{scratch}/out")
    # replaying batch 0 (as after a failure between write and commit) rewrites, not appends
    first = got.where(F.col("batch_id") == 0).drop("batch_id")
    sinks.write_batch(first, f"{scratch}/out", 0, key)
    got = spark.read.parquet(f"{scratch}/out").drop("batch_id")
    cols = ["alert_type", "condition_id", "POLL_TIMESTAMP", "detail"]
    rows = _keyset(got, cols)
    assert len(rows) == len(set(rows))
    batch = flow.alerts.where(F.col("alert_type").isin("ARBITRAGE", "HIGH_ERROR"))
    assert rows == _keyset(batch, cols)


def test_dedup_stream_drops_redelivered_polls(spark, flow, landed, scratch):
    src = f"{scratch}/pred_in"
    os.makedirs(src)
    files = sorted(glob.glob(f"{landed}/pred/*.parquet"))
    t0 = 1_700_000_000
    for i, f in enumerate(files):
        shutil.copy(f, f"{src}/{i:06d}a.parquet")
        os.utime(f"{src}/{i:06d}a.parquet", (t0 + 10 * i, t0 + 10 * i))   # arrival order = hour order
    shutil.copy(files[0], f"{src}/{0:06d}b.parquet")        # hour 0 redelivered right after itself
    os.utime(f"{src}/{0:06d}b.parquet", (t0 + 5, t0 + 5))
    pred = jobs.read_stream(spark, src, flow.pred.schema, max_files_per_trigger=1)
    _run(jobs.dedup_stream(pred), f"{scratch}/out", f"{scratch}/ck", ["question_id"])
    got = spark.read.parquet(f"{scratch}/out")
    assert got.count() == flow.pred.count()


def test_interval_join_stream_equals_batch(spark, flow, landed, scratch):
    from wxodds.operators import quality
    pred = jobs.read_stream(spark, f"{landed}/pred", flow.pred.schema, max_files_per_trigger=1)
    wx = jobs.read_stream(spark, f"{landed}/wx", flow.wx.schema, max_files_per_trigger=1)
    _run(jobs.interval_join_stream(pred, wx), f"{scratch}/out", f"{scratch}/ck", ["question_id", "w_poll"])
    got = spark.read.parquet(f"{scratch}/out")
    cols = ["question_id", "POLL_TIMESTAMP", "w_poll", "w_data_type"]
    assert _keyset(got, cols) == _keyset(quality.interval_weather_join(flow.pred, flow.wx), cols)


def test_pending_join_stream_first_match_equals_batch(spark, flow, landed, scratch):
    from wxodds.operators import quality
    pred = jobs.read_stream(spark, f"{landed}/pred", flow.pred.schema, max_files_per_trigger=1)
    wx = jobs.read_stream(spark, f"{landed}/wx", flow.wx.schema, max_files_per_trigger=1)
    _run(jobs.pending_join_stream(pred, wx), f"{scratch}/out", f"{scratch}/ck", ["question_id", "w_poll"])
    got = spark.read.parquet(f"{scratch}/out")
    first = got.groupBy("question_id").agg(F.min("w_poll").alias("w_poll"))
    batch = quality.pending_predictions(flow.pred, flow.wx).where(F.col("resolved_by").isNotNull())
    want = dict((r.question_id, r.resolved_by) for r in batch.collect())
    have = dict((r.question_id, r.w_poll) for r in first.collect())
    assert want and all(have.get(q) == t for q, t in want.items())


def test_late_rows_are_dropped_and_counted(spark, flow, landed, scratch):
    src = f"{scratch}/corr_in"
    os.makedirs(src)
    files = sorted(glob.glob(f"{landed}/corr/*.parquet"))
    t0 = 1_700_000_000
    for i, f in enumerate(files):
        shutil.copy(f, f"{src}/{i:06d}.parquet")
        os.utime(f"{src}/{i:06d}.parquet", (t0 + 10 * i, t0 + 10 * i))
    stream = lambda: jobs.read_stream(spark, src, flow.corr.schema, max_files_per_trigger=1)
    key = ["LOCATION_NAME", "window_start"]
    _run(jobs.accuracy_stream(stream()), f"{scratch}/out", f"{scratch}/ck", key)
    before = _keyset(spark.read.parquet(f"{scratch}/out").drop("batch_id"), schemas.ACC_COLUMNS)
    shutil.copy(files[0], f"{src}/late.parquet")        # the first hour arrives again, hours late
    os.utime(f"{src}/late.parquet", (t0 + 10 * len(files), t0 + 10 * len(files)))
    late = jobs.LateRows()
    spark.streams.addListener(late)
    q = _run(jobs.accuracy_stream(stream()), f"{scratch}/out", f"{scratch}/ck", key)
    for _ in range(100):                                # progress events come a little later
        if late.rows[str(q.id)]:
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    after = _keyset(spark.read.parquet(f"{scratch}/out").drop("batch_id"), schemas.ACC_COLUMNS)
    assert late.rows[str(q.id)] > 0
    assert after == before


def test_whole_streaming_flow_from_landing_json(spark, flow, scratch):
    raw = flow.raw_events.withColumn("_t", F.to_timestamp("POLL_TIMESTAMP", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    _slices(raw, "_t", f"{scratch}/events", fmt="json", seconds=2 * 3600)
    rw = flow.raw_weather.withColumn("_t", F.to_timestamp("POLL_TIMESTAMP", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    _slices(rw, "_t", f"{scratch}/weather", fmt="json", seconds=2 * 3600)
    jobs.run_flow(spark, f"{scratch}/events", f"{scratch}/weather", f"{scratch}/out", f"{scratch}/ck")
    out = f"{scratch}/out"
    cols = ["question_id", "POLL_TIMESTAMP"]
    assert _keyset(spark.read.parquet(f"{out}/pred"), cols) == _keyset(flow.pred, cols)
    assert _keyset(spark.read.parquet(f"{out}/corr"), schemas.CORR_COLUMNS) == _keyset(flow.corr, schemas.CORR_COLUMNS)
    table = spark.read.parquet(f"{out}/correlations_table").drop("batch_id")
    assert _keyset(table, table.columns) == _keyset(flow.correlations_table, table.columns)
    assert spark.read.schema(flow.corr.schema).parquet(f"{out}/quarantine_correlations_table").count() == 0
    assert spark.read.parquet(f"{out}/accuracy_table").count() == spark.read.parquet(f"{out}/acc").count()
    acc = spark.read.parquet(f"{out}/acc")
    assert set(_keyset(acc, schemas.ACC_COLUMNS)) <= set(_keyset(flow.acc, schemas.ACC_COLUMNS))
    last_end = acc.agg(F.max("window_end")).first()[0]
    alerts = spark.read.parquet(f"{out}/alerts").drop("batch_id")
    # accuracy alerts exist for the windows the watermark has closed; correlation alerts for all rows
    want = flow.alerts.where(F.col("condition_id").isNotNull() | (F.col("POLL_TIMESTAMP") <= F.lit(last_end)))
    assert _keyset(alerts, schemas.ALERT_COLUMNS) == _keyset(want, schemas.ALERT_COLUMNS)


def test_a_poll_redelivered_in_a_later_batch_and_a_replayed_batch_leave_one_row(spark, flow, scratch):
    rows = sinks.correlations_rows(flow.corr)
    n = rows.dropDuplicates(sinks.CORRELATIONS_KEY).count()
    for batch_id in (0, 1, 1):
        sinks.write_batch(rows, f"{scratch}/t", batch_id, sinks.CORRELATIONS_KEY, "poll_timestamp")
    assert spark.read.parquet(f"{scratch}/t").count() == n


def test_asof_stream_with_an_older_weather_record_arriving_last(spark, flow, scratch):
    w = flow.wx.where("data_type <> 'historical'").orderBy("POLL_TIMESTAMP").limit(1)
    city = w.first()["LOCATION_NAME"]
    at = lambda df, t: df.withColumn("LOCATION_NAME", F.lit(city)).withColumn("POLL_TIMESTAMP", F.lit(t).cast("timestamp"))
    market = flow.pred.where("not closed").limit(1)
    for n, (df, sub) in enumerate([(at(w, "2024-01-01 10:00:00"), "wx"), (at(w, "2024-01-01 09:00:00"), "wx"), (at(market, "2024-01-01 10:30:00"), "pred")]):
        df.coalesce(1).write.mode("append").parquet(f"{scratch}/{sub}")
        if sub == "wx" and n == 0:
            market.limit(0).write.mode("append").parquet(f"{scratch}/pred")
        pred = jobs.read_stream(spark, f"{scratch}/pred", flow.pred.schema)
        wx = jobs.read_stream(spark, f"{scratch}/wx", flow.wx.schema)
        q = (jobs.correlation_stream(pred, wx).writeStream.format("parquet").option("path", f"{scratch}/out")
             .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    row, = spark.read.parquet(f"{scratch}/out").collect()
    assert row.CORRELATION_LATENCY_SEC == 30 * 60
