"""Streaming jobs: the batch flow as four streaming queries with durable hand-offs.

    landing JSON ──► predictions_stream ──► pred sink ─┐
    landing JSON ──► observations_stream ─► wx sink ───┴─► correlation_stream ─► corr sink
    corr sink ──► accuracy_stream (event-time 1 h / 15 min windows, 15 min watermark) ─► acc sink
    acc sink + corr sink ──► alert_stream ─► alerts sink

Every stateless step is the batch function itself; state lives in transformWithStateInPandas
processors (RocksDB state store) or in Spark's windowed aggregation state.  Sinks go through
foreachBatch with idempotent per-batch folders, so a restarted query that replays a batch
rewrites it instead of duplicating it.
"""
from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wxodds import schemas
from wxodds.functions.core import scaled_int
from wxodds.functions.market import location_key, yes_price, yes_winner
from wxodds.operators import accuracy, anomaly, correlate, ingest
from wxodds.operators.asof import WEATHER_PAYLOAD, market_class, weather_class
from wxodds.operators.quality import PENDING_TTL_SECONDS, SILENCE_SECONDS
from wxodds.sources import sinks, topics
from wxodds.streaming import event_time, routing
from wxodds.streaming.processors import (
    ASOF_OUTPUT, BASELINE_OUTPUT, PRICE_OUTPUT, AsOfWeatherProcessor, BaselineProcessor,
    EXPIRING_COLUMNS,
    ExpiringPriceChangeProcessor,
    PriceChangeProcessor,
)

WATERMARK = "15 minutes"
DEDUP_WATERMARK = "1 hour"


# ------------------------------------------------------------------ sources

def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File-based topic source with a fixed schema (a Kafka source slots in here unchanged)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


# ------------------------------------------------------------------ predictions

_PRED_FIELDS = [f.name for f in schemas.PRED.fields]


def predictions_stream(raw_events: DataFrame, price_ttl_seconds: int | None = None, watermark: str = "30 minutes") -> DataFrame:
    """Raw polled events -> shaped -> price-change suppression (keyed state) -> validated.

    By default the price of each market ever seen is kept, as in the reference.  With `price_ttl_seconds`, a timer
    forgets a market that long (event time) after its last open poll, so the state holds the markets of that span;
    equal to ingest.price_change_only of the same span.  Open polls later than `watermark`, or without a time, are then dropped as late rows.
    """
    good, _ = ingest.split_rejects(tagged_predictions_stream(raw_events, price_ttl_seconds, watermark))
    return good


def tagged_predictions_stream(raw_events: DataFrame, price_ttl_seconds: int | None = None, watermark: str = "30 minutes") -> DataFrame:
    """What `predictions_stream` validates, with the reason why a record is rejected, or null."""
    shaped = ingest.shaped_predictions(raw_events)
    payload = F.to_json(F.struct(*_PRED_FIELDS, "poll_text"))
    open_rows = (shaped.where(~F.col("closed"))
                 .select(F.coalesce(F.col("condition_id"), F.lit("\u0000")).alias("_ck"),
                         F.col("POLL_TIMESTAMP").alias("_ts"),
                         F.coalesce(F.col("question_id"), F.lit("")).alias("_qid"),
                         F.to_json(F.transform("tokens", lambda t: t["price"])).alias("_prices"),
                         payload.alias("_payload")))
    if price_ttl_seconds is None:
        kept = open_rows.groupBy("_ck").transformWithStateInPandas(
            statefulProcessor=PriceChangeProcessor(), outputStructType=PRICE_OUTPUT,
            outputMode="Append", timeMode="None")
    else:
        timed = open_rows.withColumn("_us", F.coalesce(F.unix_micros("_ts"), F.lit(0)))
        kept = timed.select(*EXPIRING_COLUMNS).withWatermark("_ts", watermark).groupBy("_ck").transformWithStateInPandas(
            statefulProcessor=ExpiringPriceChangeProcessor(price_ttl_seconds * 1_000_000), outputStructType=PRICE_OUTPUT,
            outputMode="Append", timeMode="EventTime")
    pred_schema = T.StructType(schemas.PRED.fields + [T.StructField("poll_text", T.StringType())])
    kept = kept.select(F.from_json("_payload", pred_schema).alias("r")).select("r.*")
    closed = shaped.where(F.col("closed")).select(*_PRED_FIELDS, "poll_text")
    shaped = kept.unionByName(closed)
    return shaped.withColumn("reject_reason", ingest.prediction_reject_reason(shaped))


def dedup_stream(pred: DataFrame) -> DataFrame:
    """Drop redelivered polls (same market and poll time) within one hour."""
    return (pred.withWatermark("POLL_TIMESTAMP", DEDUP_WATERMARK)
            .dropDuplicatesWithinWatermark(["condition_id", "POLL_TIMESTAMP"]))


def observations_stream(raw_weather: DataFrame) -> DataFrame:
    return ingest.observations(raw_weather)


def tagged_observations_stream(raw_weather: DataFrame) -> DataFrame:
    """What `observations_stream` validates, with the reason why a record is rejected, or null."""
    shaped = ingest.shape_weather(raw_weather)
    return shaped.withColumn("reject_reason", ingest.weather_reject_reason(shaped))


# ------------------------------------------------------------------ correlation

SALT_BUCKETS = 8


def _market_feed(pred: DataFrame, salt_buckets: int) -> DataFrame:
    """Markets as rows of a keyed join, spread over salt buckets by a hash of the market."""
    market_fields = ["condition_id", "question_id", "question", "closed", "LOCATION_NAME",
                     "POLL_TIMESTAMP", "arbitrage_flag", "price_sum", "volume"]
    salt = F.pmod(F.xxhash64("condition_id", "question_id"), F.lit(salt_buckets)).cast("int")
    return pred.select(
        location_key(F.col("LOCATION_NAME")).alias("_city"), salt.alias("_salt"), F.lit(1).alias("_src"),
        market_class().alias("_cls"), F.col("POLL_TIMESTAMP").alias("_ts"),
        F.lit(0).cast("long").alias("_tb"),
        F.to_json(F.struct(*market_fields,
                           yes_price(F.col("tokens")).alias("_yes_p"),
                           yes_winner(F.col("tokens")).alias("_yes_win"))).alias("_payload"))


def _weather_feed(wx: DataFrame, salt_buckets: int) -> DataFrame:
    """Weather as rows of a keyed join; each record goes to all salt buckets of its city."""
    hist = F.coalesce(F.col("data_type") == "historical", F.lit(False))
    return wx.select(
        location_key(F.col("LOCATION_NAME")).alias("_city"),
        F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))).alias("_salt"), F.lit(0).alias("_src"),
        weather_class(hist).alias("_cls"), F.col("POLL_TIMESTAMP").alias("_ts"),
        F.xxhash64(F.to_json(F.struct(*wx.columns))).alias("_tb"),
        F.to_json(F.struct(*[F.col(c).alias(n) for n, c in WEATHER_PAYLOAD.items()])).alias("_payload"))


def _by_event_time(markets: DataFrame, weather: DataFrame, watermark: str, processor, output: T.StructType) -> DataFrame:
    """Both feeds, each with its own watermark (Spark goes by the lesser one), through an event-time join."""
    both = [df.where(F.col("_ts").isNotNull()).withColumn("_us", F.unix_micros("_ts")).select(*event_time.INPUT).withWatermark("_ts", watermark)
            for df in (markets, weather)]
    return both[0].unionByName(both[1]).groupBy("_city", "_salt").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime")


def correlation_stream(pred: DataFrame, wx: DataFrame, keep_extra: bool = False,
                       salt_buckets: int = SALT_BUCKETS, watermark: str | None = None) -> DataFrame:
    """As-of pairing with keyed weather state, then the batch scoring.

    The state key is (city, salt): market rows are spread over `salt_buckets` buckets by a hash
    of the market, and every weather record is copied to all buckets of its city (weather is
    tiny), so each bucket keeps its own latest-weather state and a hot city is processed by
    several tasks instead of one.

    Without `watermark`, weather counts as seen once it has arrived, as in the reference: rows come out
    at once, and a market that arrives ahead of its weather has none.  With a `watermark` (the delay of
    either feed that is waited for), a market comes out when the watermark has passed it, with the
    weather that the batch join gives it, whatever the order of arrival (see event_time.py)."""
    m, w = _market_feed(pred, salt_buckets), _weather_feed(wx, salt_buckets)
    if watermark:
        pairs = _by_event_time(m, w, watermark, event_time.AsOfJoin(), event_time.ASOF_OUTPUT)
    else:
        pairs = m.unionByName(w).groupBy("_city", "_salt").transformWithStateInPandas(
            statefulProcessor=AsOfWeatherProcessor(), outputStructType=ASOF_OUTPUT,
            outputMode="Append", timeMode="None")
    market_schema = ("condition_id string, question_id string, question string, closed boolean, "
                     "LOCATION_NAME string, POLL_TIMESTAMP timestamp, arbitrage_flag boolean, "
                     "price_sum double, volume double, _yes_p double, _yes_win boolean")
    weather_schema = ("w_data_type string, w_current_temp double, w_daily_max double, "
                      "w_daily_min double, w_poll timestamp, w_date string")
    flat = pairs.select(F.from_json("_payload", market_schema).alias("m"),
                        F.from_json("_w_payload", weather_schema).alias("w")).select("m.*", "w.*")
    return correlate.score_pairs(flat, keep_extra)


def pending_stream(pred: DataFrame, wx: DataFrame, ttl_seconds: int = PENDING_TTL_SECONDS, watermark: str = WATERMARK,
                   salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """The stream form of quality.pending_predictions, row by row: each market that found no weather, once,
    with the first weather within `ttl_seconds`, or with nulls when the watermark has passed that time.
    Its state is empty of markets from then on."""
    m = _market_feed(pred, salt_buckets).withColumn("_payload", F.get_json_object("_payload", "$.question_id"))
    w = _weather_feed(wx, salt_buckets).withColumn("_payload", F.lit(""))
    out = _by_event_time(m, w, watermark, event_time.PendingJoin(ttl_seconds * 1_000_000), event_time.PENDING_OUTPUT)
    polled, by = F.timestamp_micros("_us"), F.timestamp_micros("_by_us")
    return out.select("question_id", polled.alias("POLL_TIMESTAMP"), by.alias("resolved_by"),
                      (F.unix_seconds(by) - F.unix_seconds(polled)).alias("wait_seconds"))


def silence_stream(pred: DataFrame, wx: DataFrame, silence_seconds: int = SILENCE_SECONDS) -> DataFrame:
    """The live alarm of quality.producer_silence: a row when a feed has sent nothing for `silence_seconds`
    of processing time, and one when it is back.  Needs a processing-time trigger.  Each partition of a
    micro-batch sends one row a feed and Arrow batch, so a busy feed costs its task next to nothing."""
    feeds = pred.select(F.lit("market").alias("feed"), F.unix_micros("POLL_TIMESTAMP").alias("us")).unionByName(
        wx.select(F.lit("weather").alias("feed"), F.unix_micros("POLL_TIMESTAMP").alias("us")))

    def newest(batches):
        for pdf in batches:
            yield pdf.groupby("feed", as_index=False).agg(polled_us=("us", "max"), records=("us", "size"))

    beats = feeds.mapInPandas(newest, "feed string, polled_us long, records long")
    out = beats.groupBy("feed").transformWithStateInPandas(
        statefulProcessor=event_time.Silence(silence_seconds * 1000), outputStructType=event_time.SILENCE_OUTPUT,
        outputMode="Append", timeMode="ProcessingTime")
    return out.select("feed", "event", F.timestamp_millis("at_ms").alias("at"), F.timestamp_micros("last_poll_us").alias("last_poll"))


def interval_join_stream(pred: DataFrame, wx: DataFrame, tolerance: str = "15 minutes") -> DataFrame:
    """Event-time join on city with a ±tolerance band (stream-stream inner join; both sides
    watermarked so that join state is dropped once the band has passed)."""
    # buckets of an hour spread a city's state over tasks; weather goes to each bucket its band touches
    hour = lambda ts: F.floor(F.unix_seconds(ts) / 3600)
    band = F.expr(f"INTERVAL {tolerance}")
    p = pred.withWatermark("POLL_TIMESTAMP", tolerance).select(
        location_key(F.col("LOCATION_NAME")).alias("_city"), hour(F.col("POLL_TIMESTAMP")).alias("_b"), "question_id", "POLL_TIMESTAMP")
    w = wx.withWatermark("POLL_TIMESTAMP", tolerance).select(
        location_key(F.col("LOCATION_NAME")).alias("_wcity"), F.col("POLL_TIMESTAMP").alias("w_poll"),
        F.col("data_type").alias("w_data_type"),
        F.explode(F.sequence(hour(F.col("POLL_TIMESTAMP") - band), hour(F.col("POLL_TIMESTAMP") + band))).alias("_wb"))
    cond = ((F.col("_city") == F.col("_wcity")) & (F.col("_b") == F.col("_wb"))
            & (F.col("w_poll") >= F.col("POLL_TIMESTAMP") - F.expr(f"INTERVAL {tolerance}"))
            & (F.col("w_poll") <= F.col("POLL_TIMESTAMP") + F.expr(f"INTERVAL {tolerance}")))
    return p.join(w, cond, "inner").select("question_id", "POLL_TIMESTAMP", "w_poll", "w_data_type")


def pending_join_stream(pred: DataFrame, wx: DataFrame, ttl: str = "24 hours",
                        watermark: str = WATERMARK) -> DataFrame:
    """Predictions wait up to `ttl` for weather of their city and class arriving after them
    (stream-stream left outer join; unmatched predictions are emitted with nulls once the
    watermark passes their TTL).  Every match within the TTL is emitted; the batch
    `pending_predictions` keeps the first one."""
    p = pred.withWatermark("POLL_TIMESTAMP", watermark).select(
        location_key(F.col("LOCATION_NAME")).alias("_city"), market_class().alias("_cls"),
        "question_id", "POLL_TIMESTAMP")
    hist = F.coalesce(F.col("data_type") == "historical", F.lit(False))
    w = wx.withWatermark("POLL_TIMESTAMP", watermark).select(
        location_key(F.col("LOCATION_NAME")).alias("_wcity"), weather_class(hist).alias("_wcls"),
        F.col("POLL_TIMESTAMP").alias("w_poll"))
    cond = ((F.col("_city") == F.col("_wcity")) & (F.col("_cls") == F.col("_wcls"))
            & (F.col("w_poll") > F.col("POLL_TIMESTAMP"))
            & (F.col("w_poll") <= F.col("POLL_TIMESTAMP") + F.expr(f"INTERVAL {ttl}")))
    return p.join(w, cond, "leftOuter").select("question_id", "POLL_TIMESTAMP", "w_poll")


# ------------------------------------------------------------------ accuracy

def accuracy_stream(corr: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Event-time sliding windows (1 h / 15 min); a window is emitted once the watermark passes
    its end.  Same inputs and metric expressions as the batch form."""
    v = accuracy.accuracy_skip_invalid(corr).withWatermark("POLL_TIMESTAMP", watermark)
    sums, maxes = accuracy._accuracy_inputs(v)
    g = v.groupBy("LOCATION_NAME", F.window("POLL_TIMESTAMP", "1 hour", "15 minutes")).agg(
        *[F.sum(e).alias(n) for n, e in sums.items()], *[F.max(e).alias(n) for n, e in maxes.items()])
    g = g.withColumn("window_start", F.col("window.start")).withColumn("window_end", F.col("window.end"))
    return accuracy.accuracy_metrics(g)


def accuracy_panes_stream(corr: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """`accuracy_stream` as two chained event-time aggregations: 15-minute panes first, then hours over
    the closed panes' times.  A row is added to one state row (its pane) instead of four windows, and
    the second aggregation sees one row a pane and city."""
    v = accuracy.accuracy_skip_invalid(corr).withWatermark("POLL_TIMESTAMP", watermark)
    sums, maxes = accuracy._accuracy_inputs(v)
    panes = v.groupBy("LOCATION_NAME", F.window("POLL_TIMESTAMP", "15 minutes").alias("pane")).agg(
        *[F.sum(e).alias(n) for n, e in sums.items()], *[F.max(e).alias(n) for n, e in maxes.items()])
    g = panes.groupBy("LOCATION_NAME", F.window(F.window_time("pane"), "1 hour", "15 minutes").alias("window")).agg(
        *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxes])
    g = g.withColumn("window_start", F.col("window.start")).withColumn("window_end", F.col("window.end"))
    return accuracy.accuracy_metrics(g)


# ------------------------------------------------------------------ alerts

def baseline_stream(acc: DataFrame) -> DataFrame:
    """Running baseline per city from keyed state (same columns as anomaly.running_baseline)."""
    a = anomaly.min_sample_filter(acc).select(
        "LOCATION_NAME", "window_start", "window_end", "accuracy_rate",
        scaled_int(F.col("accuracy_rate"), 10_000).cast("long").alias("_r"))
    base = a.groupBy("LOCATION_NAME").transformWithStateInPandas(
        statefulProcessor=BaselineProcessor(), outputStructType=BASELINE_OUTPUT,
        outputMode="Append", timeMode="None")
    return anomaly.baseline_columns(base)


def correlation_alerts_stream(corr: DataFrame) -> DataFrame:
    """ARBITRAGE / HIGH_ERROR: stateless, straight from the correlation stream."""
    return anomaly.correlation_alerts(corr)


def alert_stream(acc: DataFrame, corr: DataFrame) -> DataFrame:
    """All four alert rules as one stream (same rule expressions as batch)."""
    return anomaly.accuracy_alerts_from_baseline(baseline_stream(acc)).unionByName(
        anomaly.correlation_alerts(corr))


# ------------------------------------------------------------------ monitoring

class LateRows(StreamingQueryListener):
    """Adds up, by query id, the rows that came behind the watermark and were left out of windowed state.
    Register it with spark.streams.addListener before the queries start; every progress is counted,
    however long they run."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = defaultdict(int)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for op in event.progress.stateOperators or []:
            self.rows[str(event.progress.id)] += int(op.numRowsDroppedByWatermark or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class Rejects(StreamingQueryListener):
    """Adds up, by feed, the records that passed validation and that didn't, from the metrics that
    `start_ingest` observes; register it as LateRows."""

    def __init__(self) -> None:
        self.records: dict[str, int] = defaultdict(int)
        self.rejected: dict[str, int] = defaultdict(int)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in (event.progress.observedMetrics or {}).items():
            if name.startswith(OBSERVED):
                self.records[name.removeprefix(OBSERVED)] += row["records"] or 0
                self.rejected[name.removeprefix(OBSERVED)] += row["rejected"] or 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


# ------------------------------------------------------------------ sinks

OBSERVED = "ingest_"


def start_ingest(tagged: DataFrame, feed: str, out: str, quarantine: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write a validated feed and its quarantine (with reasons) from one pass over each micro-batch, and
    observe how many records it had and rejected (see Rejects).  A replayed batch rewrites its folders."""
    counted = tagged.observe(OBSERVED + feed, F.count(F.lit(1)).alias("records"),
                             F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for rows, path in zip(ingest.split_rejects(batch), (out, quarantine), strict=True):
                (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_id").parquet(path))
        finally:
            batch.unpersist()

    return (counted.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def start_sink(df: DataFrame, path: str, checkpoint: str, key: list[str], trigger: dict | None = None,
               name: str | None = None, time: str | None = None) -> StreamingQuery:
    """Idempotent foreachBatch sink (replayed batch ids overwrite their own folder); with `time`, rows are
    unique on the key across batches, too."""
    w = (df.writeStream.foreachBatch(lambda batch, batch_id: sinks.write_batch(batch, path, batch_id, key, time))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


# ------------------------------------------------------------------ the whole streaming flow

def _file_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Parquet file sink: exactly-once through its own metadata log; readers honour the log."""
    return (df.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**trigger).start())


def run_flow(spark: SparkSession, events_landing: str, weather_landing: str, out: str,
             checkpoints: str, trigger: dict | None = None, files_per_trigger: int | None = None,
             watermark: str | None = None, upsert: bool = False) -> dict:
    """Run the streaming flow stage by stage, one streaming query per topic:

        landing events  -> {out}/pred      landing weather -> {out}/wx
        pred            -> {out}/polls     (each poll once, see dedup_stream)
        polls + wx      -> {out}/corr      corr            -> {out}/acc
        acc + corr      -> {out}/alerts    (topic and serving table)
        corr, acc       -> {out}/correlations_table, {out}/accuracy_table (serving tables)
        misfits of both -> {out}/quarantine_*  (rows with a value that their table can't hold)

    With the default availableNow trigger each stage drains what is available and stops (the
    scheduled-run pattern); with a processing-time trigger the queries keep running.  The
    correlation stage reads its two inputs unthrottled, so a micro-batch holds both
    feeds for the same time span (rows are put in event-time order inside the processor).

    With `watermark` it joins by event time instead (see `correlation_stream`): input is throttled
    as elsewhere, and rows come out once the watermark has passed them.  With `upsert`, the
    results go to {out}/topics as JSON records and one query deals all of them out to {out}/serving:
    correlations, accuracy and alerts, merged by natural key (routing.py), with a quarantine.
    Returns the started queries by topic."""
    trigger = trigger or {"availableNow": True}
    wait = "availableNow" in trigger
    queries = {}

    def go(name, q):
        queries[name] = q
        if wait:
            q.awaitTermination()

    events = read_stream(spark, events_landing, schemas.RAW_EVENT, "json", files_per_trigger)
    go("pred", _file_sink(predictions_stream(events), f"{out}/pred", f"{checkpoints}/pred", trigger))
    weather = read_stream(spark, weather_landing, schemas.RAW_WEATHER, "json", files_per_trigger)
    go("wx", _file_sink(observations_stream(weather), f"{out}/wx", f"{checkpoints}/wx", trigger))
    pred_schema = schemas.PRED
    wx_schema = observations_stream(spark.createDataFrame([], schemas.RAW_WEATHER)).schema
    go("polls", _file_sink(dedup_stream(read_stream(spark, f"{out}/pred", pred_schema)), f"{out}/polls", f"{checkpoints}/polls", trigger))
    throttle = files_per_trigger if watermark else None
    corr = correlation_stream(read_stream(spark, f"{out}/polls", pred_schema, max_files_per_trigger=throttle),
                              read_stream(spark, f"{out}/wx", wx_schema, max_files_per_trigger=throttle), watermark=watermark)
    go("corr", _file_sink(corr, f"{out}/corr", f"{checkpoints}/corr", trigger))
    corr_schema = schemas.CORR
    acc = accuracy_stream(read_stream(spark, f"{out}/corr", corr_schema, max_files_per_trigger=files_per_trigger))
    go("acc", _file_sink(acc, f"{out}/acc", f"{checkpoints}/acc", trigger))
    acc_in = read_stream(spark, f"{out}/acc", acc.schema, max_files_per_trigger=files_per_trigger)
    corr_in = read_stream(spark, f"{out}/corr", corr_schema, max_files_per_trigger=files_per_trigger)
    if upsert:
        root = f"{out}/topics"
        for name, rows in (("correlations", corr_in), ("accuracy", acc_in), ("alerts", alert_stream(acc_in, corr_in))):
            go(f"topic_{name}", topics.write_topic_stream(rows, routing.topic_folder(root, name), f"{checkpoints}/topic_{name}", trigger))
        go("serving", routing.start_routing(routing.read_topics_stream(spark, root, files_per_trigger), f"{out}/serving", f"{checkpoints}/serving", trigger))
        return queries
    go("alerts", start_sink(alert_stream(acc_in, corr_in), f"{out}/alerts", f"{checkpoints}/alerts",
                            sinks.ALERTS_KEY, trigger))
    for name, table, source, rows, key, time in (
            ("correlations_table", schemas.CORRELATIONS_TABLE, sinks.CORR_SOURCE, sinks.correlations_rows, sinks.CORRELATIONS_KEY, "poll_timestamp"),
            ("accuracy_table", schemas.ACCURACY_TABLE, sinks.ACC_SOURCE, sinks.accuracy_rows, sinks.ACCURACY_KEY, "window_start")):
        topic = read_stream(spark, f"{out}/{'corr' if name.startswith('corr') else 'acc'}",
                            corr_schema if name.startswith("corr") else acc.schema, max_files_per_trigger=files_per_trigger)
        go(name, start_sink(rows(topic), f"{out}/{name}", f"{checkpoints}/{name}", key, trigger, time=time))
        go(f"quarantine_{name}", _file_sink(sinks.misfits(topic, table, source), f"{out}/quarantine_{name}",
                                            f"{checkpoints}/quarantine_{name}", trigger))
    return queries
