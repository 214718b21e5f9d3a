"""Landing folders by day, rollups from sketches, subtotals, and observed rejects of the ingest streams."""
import datetime as dt
import glob
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from wxodds import schemas
from wxodds.operators import ingest, rollups, serving
from wxodds.sources import fixtures, landing
from wxodds.streaming import jobs


@pytest.fixture(scope="module")
def landed(spark, flow, tmp_path_factory):
    """Both feeds over three days, with every kind of reject."""
    base = str(tmp_path_factory.mktemp("landing"))
    lines = {"events": fixtures.landing_events(flow.raw_events), "weather": fixtures.landing_weather(flow.raw_weather)}
    for name, df in lines.items():
        # the small table spans some hours, so polls are dealt to three days' folders
        spread = df.withColumn("day", F.date_add("day", F.pmod(F.xxhash64("value"), F.lit(3)).cast("int")))
        landing.write_landing(spread.coalesce(2), f"{base}/{name}")
    return base


def _days(path):
    return sorted(os.path.basename(d).removeprefix("day=") for d in glob.glob(f"{path}/day=*"))


def test_a_day_is_read_from_its_folder_alone(spark, landed):
    path = f"{landed}/events"
    days = _days(path)
    assert len(days) == 3
    one = landing.read_landing(spark, path, schemas.RAW_EVENT, [days[1]])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan
    read = {r[0].rsplit("/", 2)[1] for r in one.select(F.input_file_name()).distinct().collect()}
    assert read == {f"day={days[1]}"}
    whole = landing.read_landing(spark, path, schemas.RAW_EVENT)
    assert one.count() == whole.where(F.col("day") == days[1]).count() < whole.count()
    two = landing.read_landing(spark, path, schemas.RAW_EVENT, days[:2])
    assert two.count() == whole.where(F.col("day") < days[2]).count()


def test_corrupt_lines_are_kept_apart_and_none_is_lost(spark, flow, landed):
    path = f"{landed}/events"
    good, bad = landing.read_landing(spark, path, schemas.RAW_EVENT), landing.corrupt_lines(spark, path, schemas.RAW_EVENT)
    assert bad.count() > 0 and good.count() + bad.count() == flow.raw_events.count()
    assert all(not r.value.endswith("}") or r.value.count("{") != r.value.count("}") for r in bad.collect())


def test_each_filter_of_the_scans_drops_rows(spark, flow, landed):
    events = landing.read_landing(spark, f"{landed}/events", schemas.RAW_EVENT)
    markets = ingest.explode_markets(events)
    is_open, closed = ingest.scan_open_markets(events), ingest.scan_closed_markets(events)
    assert 0 < is_open.count() < flow.pred.count() and closed.count() > 0
    rest = markets.where(~F.array_contains("event_tags", ingest.MARKET_TAG)).count(), markets.where("not active and not closed").count(), \
        markets.where("substring(endDate, 1, 10) > substring(poll_text, 1, 10)").count()
    assert all(n > 0 for n in rest)
    weather = ingest.shape_weather(landing.read_landing(spark, f"{landed}/weather", schemas.RAW_WEATHER))
    reasons = {r.reject_reason: r.rejected for r in ingest.schema_error_count(ingest.validate_weather(weather)[1]).collect()}
    assert set(reasons) == {"coordinates", "data_type", "location", "poll_timestamp"}


def _files_a_day(path):
    return {os.path.basename(d).removeprefix("day="): len(glob.glob(f"{d}/part-*")) for d in glob.glob(f"{path}/day=*")}


def _polls(spark, n, day):
    """`n` lines in 8 tasks, each of which holds polls of every day."""
    return spark.range(0, n, 1, 8).selectExpr("concat('{\"id\":', id, '}') as value", f"{day} as day").repartition(8, "value")


def test_a_day_is_one_file_however_many_tasks_hold_its_polls(spark, scratch):
    lines = _polls(spark, 4000, "if(id % 41 = 40, null, date_add(date'2024-01-01', cast(id % 41 as int)))")
    landing.write_landing(landing.dealt_by_day(lines), f"{scratch}/in")
    files = _files_a_day(f"{scratch}/in")
    assert len(files) == 41 and set(files.values()) == {1}
    read = spark.read.schema(landing.LINE).format("text").load(f"{scratch}/in")
    assert sorted(map(tuple, read.collect()), key=str) == sorted(map(tuple, lines.collect()), key=str)


def test_a_large_day_is_cut_among_several_tasks(spark, scratch):
    lines = _polls(spark, 20_000, "if(id % 100 = 0, date'2024-01-02', date'2024-01-01')")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advisory, "16k")
    try:
        landing.write_landing(landing.dealt_by_day(lines), f"{scratch}/in")
    finally:
        spark.conf.unset(advisory)
    files = _files_a_day(f"{scratch}/in")
    assert files["2024-01-01"] > 1 and files["2024-01-02"] == 1
    assert spark.read.schema(landing.LINE).format("text").load(f"{scratch}/in").groupBy("day").count().orderBy("day").collect() == \
        lines.groupBy("day").count().orderBy("day").collect()


def test_landing_queries_write_one_file_a_day(spark):
    from wxodds.plans import registry
    from wxodds.plans.flow import Flow
    lines = _polls(spark, 400, "date_add(date'2024-01-01', cast(id % 5 as int))")
    files = _files_a_day(registry._landing(Flow(spark, "no tables"), lines, "polls"))
    assert len(files) == 5 and set(files.values()) == {1}


def test_landing_stream_reads_days_as_the_batch_does(spark, landed, scratch):
    day = _days(f"{landed}/weather")[0]
    stream = landing.read_landing_stream(spark, f"{landed}/weather", schemas.RAW_WEATHER, [day])
    (stream.writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck")
     .trigger(availableNow=True).start().awaitTermination())
    assert spark.read.parquet(f"{scratch}/out").count() == landing.read_landing(spark, f"{landed}/weather", schemas.RAW_WEATHER, [day]).count() > 0


@pytest.mark.parametrize("feed", ["weather", "events"])
def test_observed_rejects_equal_the_quarantine_over_micro_batches(spark, flow, scratch, feed):
    raw = flow.raw_weather if feed == "weather" else flow.raw_events
    lines = fixtures.landing_weather(raw) if feed == "weather" else fixtures.landing_events(raw)
    schema = schemas.RAW_WEATHER if feed == "weather" else schemas.RAW_EVENT
    landing.write_landing(lines.repartition(3), f"{scratch}/in")
    stream = jobs.read_stream(spark, f"{scratch}/in/day=*", schema, "json", 1)
    tagged = jobs.tagged_observations_stream(stream) if feed == "weather" else jobs.tagged_predictions_stream(stream)
    seen = jobs.Rejects()
    spark.streams.addListener(seen)
    try:
        q = jobs.start_ingest(tagged, feed, f"{scratch}/good", f"{scratch}/bad", f"{scratch}/ck")
        q.awaitTermination()
        good, bad = (spark.read.parquet(f"{scratch}/{k}").count() for k in ("good", "bad"))
        for _ in range(100):                              # progress events come a little later
            if seen.records[feed] >= good + bad:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    assert len([p for p in q.recentProgress if p.numInputRows]) >= 3
    assert (seen.records[feed], seen.rejected[feed]) == (good + bad, bad) and bad > 0


def test_rank_error_of_merged_latency_sketches(spark):
    r = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=r.randrange(24 * 3600)), int(r.paretovariate(1.1) * 10)) for _ in range(60_000)]
    corr = spark.createDataFrame(rows, "POLL_TIMESTAMP timestamp, CORRELATION_LATENCY_SEC long")
    lat = np.sort([x for _, x in rows])
    rollup = rollups.latency_rollup(corr)
    assert rollup.count() == 24
    for rank in (0.5, 0.9, 0.99):
        row = rollups.latency_quantile(rollup, rank=rank).first()
        below, upto = np.searchsorted(lat, row.latency_sec, "left") / len(lat), np.searchsorted(lat, row.latency_sec, "right") / len(lat)
        assert below <= rank + rollups.RANK_ERROR and upto >= rank - rollups.RANK_ERROR
        assert row.correlations == 60_000 and row.max_latency_sec == lat[-1]


def test_active_cities_from_hourly_sketches(spark, flow):
    rollup = rollups.city_rollup(flow.correlations_table)
    assert rollup.count() <= 24 * 10
    last = flow.correlations_table.agg(F.date_trunc("hour", F.max("inserted_at"))).first()[0]
    exact = flow.correlations_table.where(F.date_trunc("hour", "inserted_at") > F.lit(last) - F.expr("INTERVAL 2 HOURS")).select("location_name").distinct().count()
    assert rollups.active_cities(rollup, 2).first()[0] == rollups.active_cities(rollup, 2, last).first()[0] == exact
    assert rollups.active_cities(rollup.limit(0), 2).first()[0] == 0
    many = spark.range(200_000).selectExpr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(id % 24)) as inserted_at", "string(id % 50000) as location_name")
    assert abs(rollups.active_cities(rollups.city_rollup(many)).first()[0] / 50_000 - 1) < 0.05


def test_heatmap_subtotals_in_one_pass(flow):
    cube = rollups.heatmap_cube(flow.corr)
    assert cube._jdf.queryExecution().optimizedPlan().toString().count("Expand") == 1
    rows = cube.collect()
    finest = serving.v_heatmap(flow.corr)
    assert sorted(tuple(r[c] for c in finest.columns) for r in rows if r.level == 0) == sorted(map(tuple, finest.collect()))
    total, = [r for r in rows if r.level == 7]
    assert total.total == flow.corr.count() == sum(r.total for r in rows if r.level == 5)
