"""Landing-zone data derived from the `events` table.

The reference ships no data, so every market poll and weather poll is derived row by row from
`events` (one event row -> one polled record).  Market rows come from non-'error' events and
weather rows from 'error' events.  The derivation is a plain projection, so it scales with the
table and keeps its partitioning.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxodds.sources.tables import spread, table

# ---------------------------------------------------------------------------
# Fixed values of the fixture (our own test design, see FIXTURES.md).
# ---------------------------------------------------------------------------
CITIES = ["Seattle", "Tokyo", "London", "Paris", "Warsaw", "Chicago", "New York City", "Miami",
          "Denver", "Boston", "Madrid", "Rome", "Berlin", "Seoul", "Chengdu", "Hong Kong",
          "Singapore", "Toronto", "Sydney", "Dubai", "Cairo", "Lima", "Austin", "Dallas", "Ankara"]
GEO_MISSING_CITY = "Ankara"          # left out of the coordinate dimension on purpose
EPOCH_2024 = 1704067200              # 2024-01-01T00:00:00Z
POLL_STEP_SECONDS = 30               # poll time = EPOCH_2024 + event_id * 30 s
QUESTION_KINDS = ["highest temperature", "lowest temperature", "temperature"]
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DEALT_BY = ["event_id", "user_id", "value"]     # more than one, since any may be null in many rows
# ---------------------------------------------------------------------------


def _base(ev: DataFrame) -> DataFrame:
    cents = F.floor(F.col("value") * 100.0 + 0.5)
    k = (F.col("user_id") % 25).cast("int")
    city = F.element_at(F.array(*[F.lit(c) for c in CITIES]), k + 1)
    poll_ts = F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("event_id") * POLL_STEP_SECONDS)
    return ev.select(
        "event_id", "user_id", "event_type", cents.alias("cents"), k.alias("k"),
        city.alias("city"), poll_ts.alias("poll_ts"),
        F.date_format(poll_ts, ISO_SECONDS).alias("poll_text"),
    )


def _day_text(ts: Column, days_back: Column, time_part: str) -> Column:
    return F.concat(F.date_format(F.date_sub(F.to_date(ts), days_back), "yyyy-MM-dd"), F.lit(time_part))


def _weather_market() -> Column:
    e, cents, k = F.col("event_id"), F.col("cents"), F.col("k")
    closed = (e % 4) == 0
    is_f = (k % 5) == 1
    t = F.when(is_f, 50 + cents % 27).otherwise(10 + cents % 15)
    unit = F.when(is_f, F.lit("°F")).otherwise(F.lit("°C"))
    suffix = (F.when(e % 5 == 0, F.lit(" or above")).when(e % 5 == 1, F.lit(" or below"))
              .otherwise(F.lit("")))
    kind = F.element_at(F.array(*[F.lit(q) for q in QUESTION_KINDS]), (e % 3).cast("int") + 1)
    question = F.concat(F.lit("Will the "), kind, F.lit(" in "), F.col("city"), F.lit(" be "),
                        t.cast("string"), unit, suffix, F.lit(" on January 5?"))
    yes_cents = (e * 37 + cents) % 101
    no_cents = 100 - yes_cents + F.when(e % 20 == 0, 3).otherwise(0)
    prices = F.to_json(F.array((yes_cents / 100.0).cast("string"), (no_cents / 100.0).cast("string")))
    winner = F.when(closed & (e % 12 != 0), F.when(cents % 2 == 0, F.lit("Yes")).otherwise(F.lit("No")))
    days_back = F.when(closed, 1).otherwise(0)
    return F.struct(
        question.alias("question"), prices.alias("outcomePrices"),
        F.lit('["Yes","No"]').alias("outcomes"), winner.alias("winner"),
        F.concat(F.lit("0x"), (F.col("user_id") % 50).cast("string")).alias("conditionId"),
        e.cast("string").alias("id"),
        F.concat(F.lit("wx-"), e.cast("string")).alias("slug"),
        _day_text(F.col("poll_ts"), days_back, "T12:00:00Z").alias("endDate"),
        _day_text(F.col("poll_ts"), days_back + 1, "T00:00:00Z").alias("startDate"),
        closed.alias("closed"), (~closed).alias("active"),
        cents.cast("double").alias("volume"),
    )


def _other_market() -> Column:
    return F.struct(
        F.lit("Will the home side win the match?").alias("question"),
        F.lit('["0.5","0.5"]').alias("outcomePrices"), F.lit('["Yes","No"]').alias("outcomes"),
        F.lit(None).cast("string").alias("winner"),
        F.concat(F.lit("0xs"), F.col("event_id").cast("string")).alias("conditionId"),
        F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("id"),
        F.lit("match").alias("slug"),
        _day_text(F.col("poll_ts"), F.lit(0), "T12:00:00Z").alias("endDate"),
        _day_text(F.col("poll_ts"), F.lit(1), "T00:00:00Z").alias("startDate"),
        F.lit(False).alias("closed"), F.lit(True).alias("active"), F.lit(0.0).alias("volume"),
    )


def raw_events_from(ev: DataFrame) -> DataFrame:
    """One polled weather event per non-error row, plus noise events that ingest must drop:
    a non-weather market (event_id % 7 = 3) and an event without markets (event_id % 11 = 5)."""
    b = _base(ev).where(F.col("event_type") != "error")
    tags = F.array(F.lit("weather"), F.lit("daily-temperature"))
    city_slug = F.lower(F.regexp_replace(F.col("city"), " ", "-"))
    main = F.struct(
        F.concat(F.lit("Daily temperature in "), F.col("city")).alias("title"),
        F.concat(F.lit("daily-temperature-"), city_slug).alias("slug"),
        tags.alias("tags"), F.array(_weather_market()).alias("markets"),
        F.col("poll_text").alias("POLL_TIMESTAMP"),
    )
    other_markets = F.array(_other_market())
    other = F.struct(
        F.lit("Match day special").alias("title"), F.lit("match-day").alias("slug"),
        F.array(F.lit("daily-temperature")).alias("tags"), other_markets.alias("markets"),
        F.col("poll_text").alias("POLL_TIMESTAMP"),
    )
    empty = F.struct(
        F.concat(F.lit("Temperature outlook for "), F.col("city")).alias("title"),
        F.lit("outlook").alias("slug"), F.array(F.lit("daily-temperature")).alias("tags"),
        F.slice(other_markets, 1, 0).alias("markets"),                      # an event with no markets
        F.col("poll_text").alias("POLL_TIMESTAMP"),
    )
    e = F.col("event_id")
    events = F.array(main, F.when(e % 7 == 3, other), F.when(e % 11 == 5, empty))
    return b.select(F.explode(events).alias("ev")).where(F.col("ev").isNotNull()).select("ev.*")


def raw_weather_from(ev: DataFrame) -> DataFrame:
    """One weather poll per 'error' row: historical when event_id % 3 = 0, else forecast."""
    b = _base(ev).where(F.col("event_type") == "error")
    e, cents, k = F.col("event_id"), F.col("cents"), F.col("k")
    hist = (e % 3) == 0
    c150 = (cents % 150) / 10.0
    current = F.struct(
        F.date_format(F.col("poll_ts"), "yyyy-MM-dd'T'HH:mm").alias("time"),
        (8 + c150).alias("temperature_2m"), ((cents % 7) / 10.0).alias("precipitation"),
        ((cents % 7) / 10.0).alias("rain"), (cents % 4).cast("int").alias("weather_code"),
        ((cents % 40) / 2.0).alias("wind_speed_10m"), (cents % 100).cast("double").alias("relative_humidity_2m"),
    )
    units = F.struct(F.lit("iso8601").alias("time"), F.lit("°C").alias("temperature_2m"))
    return b.select(
        (k * 3 - 36).cast("double").alias("latitude"),
        (k * 13 - 156).cast("double").alias("longitude"),
        F.when(~hist, units).alias("current_units"),
        F.when(~hist, current).alias("current"),
        F.struct(F.array(10 + c150).alias("temperature_2m_max"),
                 F.array(4 + c150).alias("temperature_2m_min")).alias("daily"),
        F.when(hist, F.lit("historical")).otherwise(F.lit("forecast")).alias("kind"),
        F.when(hist, F.date_format(F.date_sub(F.to_date("poll_ts"), 1), "yyyy-MM-dd")).alias("date"),
        F.col("city").alias("LOCATION_NAME"),
        F.col("poll_text").alias("POLL_TIMESTAMP"),
    )


def geo_dim(spark: SparkSession) -> DataFrame:
    """City -> coordinates dimension (the geocode cache); bounded by the city list."""
    rows = [(c, float(i * 3 - 36), float(i * 13 - 156)) for i, c in enumerate(CITIES)
            if c != GEO_MISSING_CITY]
    return spark.createDataFrame(rows, "city string, lat double, lon double")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events_from(spread(table(spark, sf_dir, "events"), *DEALT_BY))


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_weather_from(spread(table(spark, sf_dir, "events"), *DEALT_BY))


# ------------------------------------------------------------------ landing lines with every kind of reject

#: what is wrong with the payloads of a poll, by event_id % modulus = rest
UNTAGGED, INACTIVE, OTHER_DAY, TRUNCATED = (13, 4), (17, 6), (19, 7), (23, 8)
UNKNOWN_KIND, NO_CITY, NO_PLACE, ODD_TIME = (13, 2), (17, 5), (19, 6), (29, 9)


def _poll_is(rule: tuple[int, int]) -> Column:
    event_id = (F.unix_seconds(F.to_timestamp("POLL_TIMESTAMP", ISO_SECONDS)) - EPOCH_2024) / POLL_STEP_SECONDS
    return event_id.cast("long") % rule[0] == rule[1]


def _lines(df: DataFrame, cut: Column, day: Column) -> DataFrame:
    """(value, day): each payload as a line of JSON; those with `cut` have lost their end."""
    value = F.to_json(F.struct(*df.columns))
    return df.select(F.when(cut, F.left(value, F.length(value) - 20)).otherwise(value).alias("value"), day.alias("day"))


def landing_events(raw: DataFrame) -> DataFrame:
    """Lines of polled events: some without the tag, some of whose markets are inactive or end on another day."""
    later = F.date_format(F.date_add(F.to_date(F.substring("POLL_TIMESTAMP", 1, 10)), 2), "yyyy-MM-dd'T12:00:00Z'")
    markets = F.transform("markets", lambda m: m.withField("active", F.when(_poll_is(INACTIVE), F.lit(False)).otherwise(m["active"]))
                          .withField("endDate", F.when(_poll_is(OTHER_DAY), later).otherwise(m["endDate"])))
    tags = F.when(_poll_is(UNTAGGED), F.array(F.lit("weather"))).otherwise(F.col("tags"))
    return _lines(raw.withColumns({"markets": markets, "tags": tags}), _poll_is(TRUNCATED), F.to_date(F.substring("POLL_TIMESTAMP", 1, 10)))


def landing_weather(raw: DataFrame) -> DataFrame:
    """Lines of weather polls: some of another kind, some without city, coordinates or a proper poll time."""
    odd = F.concat(F.substring("POLL_TIMESTAMP", 1, 19), F.lit(".5Z"))
    changed = raw.withColumns({
        "kind": F.when(_poll_is(UNKNOWN_KIND), F.lit("current")).otherwise(F.col("kind")),
        "LOCATION_NAME": F.when(_poll_is(NO_CITY), F.lit("")).otherwise(F.col("LOCATION_NAME")),
        "latitude": F.when(~_poll_is(NO_PLACE), F.col("latitude")),
        "POLL_TIMESTAMP": F.when(_poll_is(ODD_TIME), odd).otherwise(F.col("POLL_TIMESTAMP"))})
    seconds = F.unix_seconds(F.to_timestamp(F.substring("POLL_TIMESTAMP", 1, 19)))
    cut = ((seconds - EPOCH_2024) / POLL_STEP_SECONDS).cast("long") % TRUNCATED[0] == TRUNCATED[1]
    return _lines(changed, cut, F.to_date(F.substring("POLL_TIMESTAMP", 1, 10)))
