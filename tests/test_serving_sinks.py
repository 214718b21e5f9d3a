"""Upserted serving tables and topic routing: unique rows, constant cost, replays, quarantine."""
import glob
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from wxodds import schemas
from wxodds.sources import sinks, topics, upsert
from wxodds.streaming import jobs, routing

T = "poll_timestamp"
DDL = "k string, poll_timestamp timestamp, v int"


@pytest.fixture()
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _table(spark, path, **kw):
    return upsert.read_table(spark, path, spark.createDataFrame([], DDL).schema, **kw)


def _rows(df, cols=None):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k string, t string, v int").select("k", F.to_timestamp("t").alias(T), "v")


def test_upsert_replaces_rows_and_survives_replays(spark, scratch):
    path, key = f"{scratch}/t", ["k", T]
    one = _batch(spark, [("a", "2024-01-01 01:00:00", 1), ("b", "2024-01-01 02:00:00", 1), ("a", "2024-01-01 01:00:00", 3), (None, None, 7)])
    two = _batch(spark, [("b", "2024-01-01 02:00:00", 2), ("c", "2024-01-02 02:00:00", 5), (None, None, 8)])
    want = [("a", 3), ("b", 2), ("c", 5), (None, 8)]
    upsert.upsert(one, path, key, T)
    for batch in (two, two, two.limit(0)):
        upsert.upsert(batch, path, key, T)
    assert _rows(_table(spark, path), ["k", "v"]) == want
    upsert.upsert(one, path, key, T)                      # delivered again after a later batch: still one row a key
    assert len(_rows(_table(spark, path))) == 4
    assert _rows(_table(spark, path, days=["2024-01-02"]), ["k", "v"]) == [("c", 5)]


def test_a_batch_that_broke_off_half_way_is_made_whole_by_its_replay(spark, scratch):
    path, key = f"{scratch}/t", ["k", T]
    rows = [(f"k{n}", "2024-01-01 01:00:00", n) for n in range(40)]
    upsert.upsert(_batch(spark, rows), path, key, T)
    more = [(f"k{n}", "2024-01-01 01:00:00", -n) for n in range(20, 60)]
    upsert.upsert(_batch(spark, more), path, key, T)
    lost = sorted(glob.glob(f"{path}/day=*/part=*/version=1"))[:2]
    for folder in lost:                                   # as if these two hadn't been moved into place
        shutil.rmtree(folder)
    upsert.upsert(_batch(spark, more), path, key, T)
    assert _rows(_table(spark, path), ["k", "v"]) == sorted([(k, v) for k, _, v in [*rows[:20], *more]], key=str)


def test_a_late_batch_reads_and_keeps_what_an_early_one_does(spark, scratch, monkeypatch, few_partitions):
    """A batch lists and reads its own days' buckets alone, and no bucket holds more than two versions."""
    path, key, asked = f"{scratch}/t", ["k", T], []
    listed = upsert._folders
    monkeypatch.setattr(upsert, "_folders", lambda s, p: asked.append(p) or listed(s, p))
    cost = []
    for n in range(12):
        day = 1 + n // 2
        rows = [(f"k{n}-{i}", f"2024-01-{day:02d} {n % 2:02d}:{i:02d}:00", i) for i in range(20)]
        asked.clear()
        upsert.upsert(_batch(spark, rows), path, key, T, parts=2)
        cost.append(len(asked))
        assert all(f"day=2024-01-{day:02d}" in p for p in asked)
    assert len(set(cost)) == 1
    per_bucket = [len(glob.glob(f"{b}/version=*")) for b in glob.glob(f"{path}/day=*/part=*")]
    assert max(per_bucket) <= 2 and len(per_bucket) == 12
    assert _table(spark, path).count() == 12 * 20


def test_topics_are_routed_to_their_tables_with_a_quarantine(spark, flow, scratch, few_partitions):
    root, out = f"{scratch}/topics", f"{scratch}/serving"
    frames = {"correlations": flow.corr, "accuracy": flow.acc, "alerts": flow.alerts}
    assert [(f.name, f.dataType) for f in schemas.ACC] == [(f.name, f.dataType) for f in flow.acc.schema]
    for name, df in frames.items():
        topics.write_topic(df.coalesce(1), routing.topic_folder(root, name))
    huge = flow.corr.limit(1).withColumn("yes_price", F.lit(1234.5)).withColumn("condition_id", F.lit("huge"))
    topics.write_topic(huge.coalesce(1), routing.topic_folder(root, "correlations"))
    spark.createDataFrame([("{not json",), (json.dumps({"alert_type": 5, "POLL_TIMESTAMP": "no time"}),)], "value string").coalesce(1).write.mode(
        "append").text(routing.topic_folder(root, "alerts"))
    spark.createDataFrame([("{}",)], "value string").write.text(routing.topic_folder(root, "strange"))
    run = lambda: routing.start_routing(routing.read_topics_stream(spark, root, 3), out, f"{scratch}/ck").awaitTermination()
    run()
    want = {"correlations": (flow.correlations_table, sinks.CORRELATIONS_KEY), "accuracy": (flow.accuracy_table, sinks.ACCURACY_KEY),
            "alerts": (flow.alerts_table, sinks.ALERTS_KEY)}

    def check():
        for name, (table, key) in want.items():
            got = upsert.read_table(spark, f"{out}/{name}", table.schema)
            assert got.select(*key).distinct().count() == got.count() == table.select(*key).distinct().count()
            assert set(_rows(got)) <= set(_rows(table))
        bad = spark.read.schema(routing.QUARANTINE).parquet(f"{out}/quarantine").collect()
        assert sorted((r.topic, r.reason) for r in bad)[-2:] == [("correlations", "value"), ("strange", "topic")]
        assert ("alerts", "record") in {(r.topic, r.reason) for r in bad}

    check()
    for name, df in frames.items():                       # everything is delivered once more, in later batches
        topics.write_topic(df.coalesce(1), routing.topic_folder(root, name))
    run()
    check()


def test_flow_by_event_time_into_routed_tables(spark, flow, scratch, few_partitions):
    for name, raw in (("events", flow.raw_events), ("weather", flow.raw_weather)):
        lines = raw.select("POLL_TIMESTAMP", F.to_json(F.struct(*raw.columns)).alias("value")).repartitionByRange(4, "POLL_TIMESTAMP")
        lines.sortWithinPartitions("POLL_TIMESTAMP").select("value").write.text(f"{scratch}/{name}")
        # a poll months ahead, which lets the watermark pass all others
        lines.orderBy("POLL_TIMESTAMP").limit(1).select(F.replace("value", F.lit("2024-01-01"), F.lit("2024-03-01")).alias("value")).coalesce(1).write.mode(
            "append").text(f"{scratch}/{name}")
        files = sorted(glob.glob(f"{scratch}/{name}/part-*.txt"), key=lambda f: open(f).readline().split('"POLL_TIMESTAMP":"')[1][:20])
        assert len(files) == 5
        for n, f in enumerate(files):
            os.utime(f, (1_700_000_000 + 10 * n, 1_700_000_000 + 10 * n))
    out = f"{scratch}/out"
    jobs.run_flow(spark, f"{scratch}/events", f"{scratch}/weather", out, f"{scratch}/ck", files_per_trigger=3, watermark="12 hours", upsert=True)
    corr = spark.read.parquet(f"{out}/corr")
    assert _rows(corr, schemas.CORR_COLUMNS) == _rows(flow.corr, schemas.CORR_COLUMNS)
    table = upsert.read_table(spark, f"{out}/serving/correlations", flow.correlations_table.schema)
    assert table.count() == sinks.correlations_rows(corr).dropDuplicates(sinks.CORRELATIONS_KEY).count()
    alerts = upsert.read_table(spark, f"{out}/serving/alerts", flow.alerts_table.schema)
    assert alerts.count() == alerts.dropDuplicates(sinks.ALERTS_KEY).count() > 0
    assert upsert.read_table(spark, f"{out}/serving/accuracy", flow.accuracy_table.schema).count() == spark.read.parquet(f"{out}/acc").count()


def test_buckets_of_a_routed_table_are_months_whatever_the_span_of_a_batch(spark, scratch, few_partitions):
    """A row a day over three years: a bucket a month and part, not one a day; rows as by day, null times included."""
    path, key = f"{scratch}/t", ["k", T]
    rows = (spark.range(1096).select(F.concat(F.lit("k"), F.col("id")).alias("k"),
                                     F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias(T), F.col("id").cast("int").alias("v"))
            .union(_batch(spark, [(None, None, 7)])))
    for value in (rows, rows.withColumn("v", -F.col("v")), rows):      # delivered again: still one row a key
        upsert.upsert(value, path, key, T, span=routing.SPAN)
    buckets = glob.glob(f"{path}/day=*/part=*")
    assert len(buckets) <= 37 * upsert.PARTS and max(len(glob.glob(f"{b}/version=*")) for b in buckets) <= 2
    got = _table(spark, path)
    assert got.count() == 1097 and got.where("v >= 0").count() == 1097
    assert _table(spark, path, days=["2024-02-01"]).count() == 29
