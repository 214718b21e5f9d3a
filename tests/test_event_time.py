"""Event-time joins equal the batch joins under shuffled, late and throttled input; live silence alarm; chained panes."""
import glob
import os
import random
import shutil
import time

import pytest
from pyspark.sql import functions as F

from wxodds import schemas
from wxodds.operators import quality
from wxodds.sources import sinks
from wxodds.streaming import jobs

HOUR = 3600


def _hours(df, base):
    """`df` as one file an hour, its rows shuffled; the hours in order."""
    d = df.withColumn("_h", F.floor(F.unix_seconds("POLL_TIMESTAMP") / HOUR)).persist()
    out = {}
    for h in sorted(r[0] for r in d.select("_h").distinct().collect()):
        d.where(F.col("_h") == h).drop("_h").orderBy(F.rand(7)).coalesce(1).write.parquet(f"{base}/{h}")
        out[h], = glob.glob(f"{base}/{h}/part-*.parquet")
    d.unpersist()
    return out


def _arrive(files, out_dir):
    """Put files into a source folder, arriving in the order given."""
    os.makedirs(out_dir)
    for n, f in enumerate(files):
        to = f"{out_dir}/{n:06d}.parquet"
        shutil.copy(f, to)
        os.utime(to, (1_700_000_000 + 10 * n, 1_700_000_000 + 10 * n))


def _one(df, base):
    df.coalesce(1).write.parquet(base)
    return glob.glob(f"{base}/part-*.parquet")[0]


def _swapped(files, seed):
    """Neighbouring hours change places here and there, so a file is at most two hours late."""
    out, r, k = list(files), random.Random(seed), 0
    while k + 1 < len(out):
        if r.random() < .5:
            out[k], out[k + 1] = out[k + 1], out[k]
            k += 1
        k += 1
    return out


@pytest.fixture(scope="module")
def disorder(spark, flow, tmp_path_factory):
    """Landing folders of both feeds: hours out of order, weather a micro-batch behind, then rows far ahead
    that let the watermark pass all others."""
    base = str(tmp_path_factory.mktemp("disorder"))
    pred, wx = _hours(flow.pred, f"{base}/p"), _hours(flow.wx, f"{base}/w")
    ahead = lambda df: df.limit(1).withColumn("POLL_TIMESTAMP", F.timestamp_seconds(F.lit((max(pred) + 30 * 24) * HOUR)))
    none = _one(flow.wx.limit(0), f"{base}/none")
    late = _one(ahead(flow.wx), f"{base}/wx-ahead")
    hours = sorted(set(pred) | set(wx))
    empty = _one(flow.pred.limit(0), f"{base}/p-none")
    _arrive([*_swapped([pred.get(h, empty) for h in hours], 1), empty, _one(ahead(flow.pred), f"{base}/p-ahead"), empty], f"{base}/pred")
    _arrive([none, *_swapped([wx.get(h, none) for h in hours], 2), late, none], f"{base}/wx")
    return base


def _feeds(spark, flow, base, files=1):
    return (jobs.read_stream(spark, f"{base}/pred", flow.pred.schema, max_files_per_trigger=files),
            jobs.read_stream(spark, f"{base}/wx", flow.wx.schema, max_files_per_trigger=files))


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=str)


def _run(df, out, ck, mode="append"):
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


@pytest.mark.parametrize("files", [1, 3])
def test_asof_stream_equals_batch_in_any_order(spark, flow, disorder, scratch, files):
    pred, wx = _feeds(spark, flow, disorder, files)
    q = _run(jobs.correlation_stream(pred, wx, watermark="6 hours"), f"{scratch}/out", f"{scratch}/ck")
    got = _rows(spark.read.parquet(f"{scratch}/out"), schemas.CORR_COLUMNS)
    assert len(q.recentProgress) > 2
    assert got == _rows(flow.corr, schemas.CORR_COLUMNS)
    held = spark.read.format("statestore").option("stateVarName", "markets").load(f"{scratch}/ck")
    assert held.count() <= 1                           # the market far ahead, at most
    kept = spark.read.format("statestore").option("stateVarName", "weather").load(f"{scratch}/ck").count()
    keys = flow.wx.select("LOCATION_NAME").distinct().count() * jobs.SALT_BUCKETS
    assert kept <= 2 * keys + jobs.SALT_BUCKETS        # the newest of each class, not the history


def test_arrival_order_loses_rows_where_event_time_does_not(spark, flow, disorder, scratch):
    """What the form without a watermark does on the same input (the reference's behaviour)."""
    pred, wx = _feeds(spark, flow, disorder)
    _run(jobs.correlation_stream(pred, wx), f"{scratch}/out", f"{scratch}/ck")
    got = _rows(spark.read.parquet(f"{scratch}/out"), schemas.CORR_COLUMNS)
    assert got != _rows(flow.corr, schemas.CORR_COLUMNS)


def test_an_old_weather_record_that_comes_last_changes_nothing(spark, flow, scratch):
    w = flow.wx.where("data_type <> 'historical'").limit(1)
    city = w.first()["LOCATION_NAME"]
    at = lambda df, t: df.withColumn("LOCATION_NAME", F.lit(city)).withColumn("POLL_TIMESTAMP", F.lit(t).cast("timestamp"))
    m = flow.pred.where("not closed").limit(1)
    p = [_one(at(m, t), f"{scratch}/p{n}") for n, t in enumerate(["2024-01-01 10:30:00", "2024-01-01 10:45:00", "2024-01-02 12:00:00", "2024-01-02 12:30:00"])]
    wf = [_one(at(w, t), f"{scratch}/w{n}") for n, t in enumerate(["2024-01-01 10:00:00", "2024-01-01 09:00:00", "2024-01-02 12:00:00", "2024-01-02 12:30:00"])]
    _arrive(p, f"{scratch}/pred")
    _arrive(wf, f"{scratch}/wx")
    _run(jobs.correlation_stream(*_feeds(spark, flow, scratch), watermark="3 hours"), f"{scratch}/out", f"{scratch}/ck")
    assert sorted(r.CORRELATION_LATENCY_SEC for r in spark.read.parquet(f"{scratch}/out").collect()) == [30 * 60, 45 * 60]


def test_pending_stream_equals_batch_row_by_row(spark, flow, disorder, scratch):
    _run(jobs.pending_stream(*_feeds(spark, flow, disorder), watermark="6 hours"), f"{scratch}/out", f"{scratch}/ck")
    cols = ["question_id", "POLL_TIMESTAMP", "resolved_by", "wait_seconds"]
    got, want = _rows(spark.read.parquet(f"{scratch}/out"), cols), _rows(quality.pending_predictions(flow.pred, flow.wx), cols)
    assert got == want and any(r[2] for r in want)
    held = spark.read.format("statestore").option("stateVarName", "markets").load(f"{scratch}/ck")
    assert held.count() <= 1                           # 24 h later none but the market far ahead


def test_pending_stream_expires_and_resolves_at_the_limit(spark, flow, scratch):
    city = lambda df, c, t: df.withColumn("LOCATION_NAME", F.lit(c)).withColumn("POLL_TIMESTAMP", F.lit(t).cast("timestamp"))
    m, w = flow.pred.where("not closed").limit(1), flow.wx.where("data_type <> 'historical'").limit(1)
    pred = [city(m, "Aa", "2024-01-01 00:00:00"), city(m, "Bb", "2024-01-01 00:00:00"), city(m, "Cc", "2024-01-01 00:00:00"),
            city(m, "Aa", "2024-01-02 00:00:00"), city(m, "Dd", "2024-01-09 00:00:00")]
    wx = [city(w, "Zz", "2024-01-01 00:00:00"), city(w, "Aa", "2024-01-02 00:00:00"), city(w, "Bb", "2024-01-02 00:00:01"), city(w, "Zz", "2024-01-09 00:00:00")]
    for name, rows in (("pred", pred), ("wx", wx)):
        _arrive([_one(df, f"{scratch}/{name}{n}") for n, df in enumerate(rows)], f"{scratch}/{name}")
    _run(jobs.pending_stream(*_feeds(spark, flow, scratch), watermark="3 days"), f"{scratch}/out", f"{scratch}/ck")
    cols = ["POLL_TIMESTAMP", "resolved_by", "wait_seconds"]
    union = lambda rows: [df for df in rows if df is not None][0].sparkSession.createDataFrame([r for df in rows for r in df.collect()], rows[0].schema)
    want = quality.pending_predictions(union(pred[:4]), union(wx))
    assert _rows(spark.read.parquet(f"{scratch}/out"), cols) == _rows(want, cols)
    assert sorted(r[2] or 0 for r in _rows(want, cols)) == [0, 0, 24 * HOUR]


def test_silence_raises_one_alarm_and_a_returning_feed_clears_it(spark, flow, scratch):
    for name, df in (("pred", flow.pred), ("wx", flow.wx)):
        _arrive([_one(df.limit(3), f"{scratch}/{name}0")], f"{scratch}/{name}")
    q = (jobs.silence_stream(*_feeds(spark, flow, scratch, None), silence_seconds=6).writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{scratch}/ck").trigger(processingTime="500 milliseconds").start())

    def events():
        rows = spark.read.schema("feed string, event string, at timestamp, last_poll timestamp").parquet(f"{scratch}/out").collect()
        return sorted((r.feed, r.event) for r in rows), rows

    def wait(n):
        for _ in range(240):
            if os.path.isdir(f"{scratch}/out/_spark_metadata") and len(events()[0]) >= n:
                return events()[0]
            time.sleep(0.5)
        raise AssertionError(f"{n} events expected")

    try:
        assert wait(2) == [("market", "silent"), ("weather", "silent")]
        time.sleep(8)                                     # stays silent: no further alarm
        assert len(events()[0]) == 2
        shutil.copy(glob.glob(f"{scratch}/pred0/part-*.parquet")[0], f"{scratch}/pred/again.parquet")
        assert wait(3) == [("market", "back"), ("market", "silent"), ("weather", "silent")]
        assert wait(4) == [("market", "back"), ("market", "silent"), ("market", "silent"), ("weather", "silent")]
        newest = flow.pred.limit(3).agg(F.max("POLL_TIMESTAMP")).first()[0]
        assert {r.last_poll for r in events()[1] if r.feed == "market"} == {newest}
    finally:
        q.stop()


def test_chained_panes_equal_sliding_windows(spark, flow, scratch):
    base = f"{scratch}/corr"
    files = _hours(flow.corr, f"{scratch}/h")
    ahead = flow.corr.limit(1).withColumn("POLL_TIMESTAMP", F.timestamp_seconds(F.lit((max(files) + 99) * HOUR)))
    _arrive([*files.values(), _one(ahead, f"{scratch}/a")], base)
    stream = lambda: jobs.read_stream(spark, base, flow.corr.schema, max_files_per_trigger=2)
    out = {}
    for name, job in (("windows", jobs.accuracy_stream), ("panes", jobs.accuracy_panes_stream)):
        q = _run(job(stream()), f"{scratch}/{name}", f"{scratch}/ck-{name}")
        out[name] = _rows(spark.read.parquet(f"{scratch}/{name}"), schemas.ACC_COLUMNS), q
    assert out["panes"][0] == out["windows"][0] == _rows(flow.acc, schemas.ACC_COLUMNS)
    held = {n: max(sum(op.numRowsTotal for op in p.stateOperators) for p in q.recentProgress) for n, (_, q) in out.items()}
    first = max(p.stateOperators[-1].numRowsTotal for p in out["panes"][1].recentProgress)
    assert first < held["windows"]
