"""Ingest: raw polled payloads -> validated MarketPrediction and WeatherObservation rows.

Every step is a projection or filter on columns (JSON is parsed once, at the edge), so the same
functions serve the batch landing scan and the file/stream source.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.functions.core import python_round4
from wxodds.functions.market import is_weather_text, parse_city
from wxodds.operators.ordered import lag_by_key

# ---------------------------------------------------------------------------
# Fixed values (ingest contract of the reference).
# ---------------------------------------------------------------------------
MARKET_TAG = "daily-temperature"
POLL_TEXT_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ARBITRAGE_TOLERANCE = 0.01
MIN_QUESTION_CHARS = 5
MIN_TOKENS = 2
WEATHER_KINDS = ["forecast", "historical"]
# ---------------------------------------------------------------------------


def explode_markets(raw_events: DataFrame) -> DataFrame:
    """Event -> one row per market; events with no markets produce nothing."""
    return raw_events.select(
        F.col("title"), F.col("slug").alias("event_slug"), F.col("tags").alias("event_tags"),
        F.col("POLL_TIMESTAMP").alias("poll_text"), F.explode("markets").alias("m"),
    ).select("title", "event_slug", "event_tags", "poll_text", "m.*")


def _end_day(c: str = "endDate") -> Column:
    return F.substring(F.col(c), 1, 10)


def _poll_day(days_back: int) -> Column:
    day = F.to_date(F.substring(F.col("poll_text"), 1, 10))
    return F.date_format(F.date_sub(day, days_back), "yyyy-MM-dd")


def _tagged() -> Column:
    return F.coalesce(F.array_contains(F.col("event_tags"), MARKET_TAG), F.lit(False))


def _open_filter() -> Column:
    return (_tagged() & F.coalesce(F.col("active"), F.lit(False))
            & ~F.coalesce(F.col("closed"), F.lit(True)) & (_end_day() == _poll_day(0)))


def _closed_filter() -> Column:
    return _tagged() & F.coalesce(F.col("closed"), F.lit(False)) & (_end_day() == _poll_day(1))


def scan_open_markets(raw_events: DataFrame) -> DataFrame:
    """Tagged, active, not closed, ending on the poll day (the poller's 'today')."""
    return explode_markets(raw_events).where(_open_filter())


def scan_closed_markets(raw_events: DataFrame) -> DataFrame:
    """Tagged, resolved markets that ended the day before the poll."""
    return explode_markets(raw_events).where(_closed_filter())


def open_plus_closed(raw_events: DataFrame) -> DataFrame:
    """Both polls of a cycle processed as one feed: one pass with the two scan predicates OR'ed
    (the predicates are disjoint, so this equals the union of the two scans)."""
    return explode_markets(raw_events).where(_open_filter() | _closed_filter())


def weather_keyword_filter(markets: DataFrame) -> DataFrame:
    return markets.where(is_weather_text(F.col("question")) | is_weather_text(F.col("title")))


def parse_price_arrays(markets: DataFrame) -> DataFrame:
    """Decode the JSON-encoded outcome and price lists; rows without prices are dropped."""
    return (markets
            .withColumn("_prices", F.from_json("outcomePrices", "array<string>"))
            .withColumn("_outcomes", F.from_json("outcomes", "array<string>"))
            .where(F.coalesce(F.size("_prices"), F.lit(0)) > 0))


def build_tokens(markets: DataFrame) -> DataFrame:
    """Zip outcomes with prices by position; label = position when the outcome is missing;
    winner = (outcome = market winner) once the market has a winner, else null."""
    n_out = F.coalesce(F.size("_outcomes"), F.lit(0))
    has_winner = F.coalesce(F.col("winner") != "", F.lit(False))

    def token(p, i):
        outcome = F.when(i < n_out, F.get(F.col("_outcomes"), i)).otherwise(i.cast("string"))
        winner = F.when(has_winner & (i < n_out),
                        F.coalesce(F.get(F.col("_outcomes"), i) == F.col("winner"), F.lit(False)))
        return F.struct(outcome.alias("outcome"), p.try_cast("double").alias("price"),
                        winner.alias("winner"))

    return markets.withColumn("tokens", F.transform("_prices", token))


def price_sum_raw(tokens) -> Column:
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.aggregate(t, F.lit(0.0), lambda acc, x: acc + x["price"])


def arbitrage_flag(raw_sum: Column) -> Column:
    return F.abs(raw_sum - 1.0) > ARBITRAGE_TOLERANCE


def shape_prediction(markets: DataFrame) -> DataFrame:
    """Rename/default into the MarketPrediction record; keeps the poll text for validation."""
    raw_sum = F.col("_sum")           # a column of its own, summed once however often the rounding names it
    return markets.withColumn("_sum", price_sum_raw("tokens")).select(
        F.col("conditionId").alias("condition_id"), F.col("id").alias("question_id"),
        F.coalesce(F.col("question"), F.lit("")).alias("question"),
        F.col("slug").alias("market_slug"), F.col("endDate").alias("end_date_iso"),
        F.col("startDate").alias("game_start_time"),
        F.coalesce(F.col("closed"), F.lit(False)).alias("closed"),
        F.coalesce(F.col("active"), F.lit(True)).alias("active"),
        "tokens",
        F.array(F.coalesce(F.col("event_slug"), F.lit(""))).alias("tags"),
        parse_city(F.col("question"), F.col("title")).alias("LOCATION_NAME"),
        F.try_to_timestamp(F.col("poll_text"), F.lit(ISO_SECONDS)).alias("POLL_TIMESTAMP"),
        python_round4(raw_sum).alias("price_sum"),
        arbitrage_flag(raw_sum).alias("arbitrage_flag"),
        F.col("volume"),
        F.col("poll_text"),
    )


def shaped_predictions(raw_events: DataFrame) -> DataFrame:
    """scan -> explode -> keyword filter -> price arrays -> tokens -> city -> record."""
    m = weather_keyword_filter(open_plus_closed(raw_events))
    return shape_prediction(build_tokens(parse_price_arrays(m)))


def price_change_only(pred: DataFrame, ttl_seconds: int | None = None) -> DataFrame:
    """Drop an open market row whose price tuple equals the previous open row of the same market.

    The previous-tuple memory is updated by every open row, valid or not (it is primed before
    validation); closed rows always pass and do not touch it.  With `ttl_seconds`, a market is
    forgotten that long after its last open row, and the next one passes.
    """
    open_rows = pred.where(~F.col("closed"))
    keyed = (open_rows.withColumn("_ck", F.coalesce(F.col("condition_id"), F.lit("\u0000")))
             .withColumn("_px", F.transform("tokens", lambda t: t["price"]))
             .withColumn("_ts", F.coalesce(F.col("POLL_TIMESTAMP"), F.timestamp_seconds(F.lit(0))))
             .withColumn("_qid", F.coalesce(F.col("question_id"), F.lit(""))))
    if ttl_seconds is None:
        lagged = lag_by_key(keyed, ["_ck"], "_ts", ["_qid"], ["_px"])
        same = F.col("prev__px") == F.col("_px")
    else:
        lagged = lag_by_key(keyed.withColumn("_us", F.unix_micros("_ts")), ["_ck"], "_ts", ["_qid"], ["_px", "_us"])
        same = (F.col("prev__px") == F.col("_px")) & (F.col("_us") - F.col("prev__us") <= ttl_seconds * 1_000_000)
    kept = lagged.where(~F.coalesce(same, F.lit(False)))
    kept = kept.drop("_ck", "_px", "_ts", "_qid", "_us", "prev__px", "prev__us")
    return kept.unionByName(pred.where(F.col("closed")))


def prediction_reject_reason(df: DataFrame) -> Column:
    """First failing rule of the record contract, null when the record is valid."""
    bad_token = F.exists("tokens", lambda t: t["outcome"].isNull() | t["price"].isNull()
                         | (t["price"] < 0) | (t["price"] > 1))
    return (F.when(F.col("question").isNull()
                   | (F.length("question") < MIN_QUESTION_CHARS), F.lit("question"))
            .when(F.col("tokens").isNull() | (F.size("tokens") < MIN_TOKENS), F.lit("tokens"))
            .when(F.coalesce(bad_token, F.lit(True)), F.lit("token"))
            .when(~F.coalesce(F.col("poll_text").rlike(POLL_TEXT_PATTERN), F.lit(False)),
                  F.lit("poll_timestamp"))
            .when(F.col("price_sum").isNull() | (F.col("price_sum") < 0), F.lit("price_sum")))


def validate_prediction(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (valid records, quarantined records with a `reject_reason`)."""
    return split_rejects(df.withColumn("reject_reason", prediction_reject_reason(df)))


def split_rejects(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid records, quarantined records) of records with a `reject_reason`."""
    good = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason", "poll_text")
    return good, tagged.where(F.col("reject_reason").isNotNull())


def published_predictions(shaped: DataFrame) -> DataFrame:
    """Shaped records -> change-suppressed -> validated (what the producer publishes)."""
    good, _ = validate_prediction(price_change_only(shaped))
    return good


def predictions(raw_events: DataFrame) -> DataFrame:
    """The published prediction feed from raw polled events."""
    return published_predictions(shaped_predictions(raw_events))


def schema_error_count(bad: DataFrame) -> DataFrame:
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rejected"))


# ----------------------------------------------------------------- weather

def daily_first_element(raw_weather: DataFrame) -> DataFrame:
    return raw_weather.withColumn("daily", F.struct(
        F.get(F.col("daily.temperature_2m_max"), 0).alias("temperature_2m_max"),
        F.get(F.col("daily.temperature_2m_min"), 0).alias("temperature_2m_min")))


def shape_weather(raw_weather: DataFrame) -> DataFrame:
    """Forecast / historical observation record (historical carries the date, no current)."""
    d = daily_first_element(raw_weather)
    hist = F.col("kind") == "historical"
    return d.select(
        "latitude", "longitude", F.col("kind").alias("data_type"),
        F.when(hist, F.col("date")).alias("date"),
        F.when(~hist, F.col("current")).alias("current"),
        F.when(~hist, F.col("current_units")).alias("current_units"),
        "daily", "LOCATION_NAME",
        F.try_to_timestamp(F.col("POLL_TIMESTAMP"), F.lit(ISO_SECONDS)).alias("POLL_TIMESTAMP"),
        F.col("POLL_TIMESTAMP").alias("poll_text"),
    )


def scan_forecast(raw_weather: DataFrame) -> DataFrame:
    return shape_weather(raw_weather.where(F.col("kind") == "forecast"))


def scan_historical(raw_weather: DataFrame) -> DataFrame:
    return shape_weather(raw_weather.where(F.col("kind") == "historical"))


def weather_reject_reason(df: DataFrame) -> Column:
    return (F.when(F.col("latitude").isNull() | F.col("longitude").isNull(), F.lit("coordinates"))
            .when(~F.coalesce(F.col("data_type").isin(*WEATHER_KINDS), F.lit(False)), F.lit("data_type"))
            .when(F.coalesce(F.length("LOCATION_NAME"), F.lit(0)) < 1, F.lit("location"))
            .when(~F.coalesce(F.col("poll_text").rlike(POLL_TEXT_PATTERN), F.lit(False)),
                  F.lit("poll_timestamp"))
            .when(F.col("daily").isNull(), F.lit("daily")))


def validate_weather(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_rejects(df.withColumn("reject_reason", weather_reject_reason(df)))


def observations(raw_weather: DataFrame) -> DataFrame:
    """Forecast and historical polls shaped and validated in one pass (other kinds are rejected
    by validation, as in the union of the two scans)."""
    good, _ = validate_weather(shape_weather(raw_weather))
    return good


# ----------------------------------------------------------------- worklists

def city_worklist_open(pred: DataFrame) -> DataFrame:
    """Distinct cities with open markets (null/empty excluded), sorted."""
    return (pred.where(~F.col("closed") & (F.coalesce(F.length("LOCATION_NAME"), F.lit(0)) > 0))
            .select(F.col("LOCATION_NAME").alias("city")).distinct().orderBy("city"))


def city_worklist_closed(pred: DataFrame) -> DataFrame:
    """City -> end date (first 10 chars) of the first closed market seen for it, sorted."""
    c = pred.where(F.col("closed") & (F.coalesce(F.length("LOCATION_NAME"), F.lit(0)) > 0)
                   & (F.coalesce(F.length(F.substring("end_date_iso", 1, 10)), F.lit(0)) > 0))
    first = c.groupBy(F.col("LOCATION_NAME").alias("city")).agg(
        F.min_by(F.substring("end_date_iso", 1, 10),
                 F.struct("POLL_TIMESTAMP", "question_id")).alias("end_date"))
    return first.orderBy("city")
