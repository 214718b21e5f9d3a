"""As-of join of market polls with the latest weather seen for the same city.

Semantics: per city, an open market row takes the latest *forecast* record with
POLL_TIMESTAMP <= its own, a closed one the latest *historical* record (weather at the same
instant counts as already seen).  No weather -> no row (inner) or null weather (left).

Plan: weather is turned into validity intervals [from, to) with a per-key lead (see ordered.py).
Intervals between two records are cut at hour boundaries, and markets equi-join on (city, class,
hour) with the range test as a residual, so a hot city is spread over hours.  The interval after the
last record has no end: it is one row for each (city, class), put into the hour of its start, and is
looked up by a second equi-join on (city, class) for the markets that the first leaves unmatched and
that lie behind it.  So the table grows with the span of each class's records, whatever the markets'
times.  Spark chooses the join strategy from the sizes it finds at run time.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.functions.core import int_floor_div
from wxodds.functions.market import location_key
from wxodds.operators.ordered import lag_by_key, lead_by_key

HOUR_MICROS = 3600 * 1_000_000

WEATHER_PAYLOAD = {
    "w_data_type": "data_type",
    "w_current_temp": "current.temperature_2m",
    "w_daily_max": "daily.temperature_2m_max",
    "w_daily_min": "daily.temperature_2m_min",
    "w_poll": "POLL_TIMESTAMP",
    "w_date": "date",
}


def weather_class(hist: Column | None = None, match: str = "city") -> Column:
    """Historical records feed closed markets, everything else feeds open ones.
    `hist` is the is-historical flag (default: derived from `data_type`)."""
    if hist is None:
        hist = F.coalesce(F.col("data_type") == "historical", F.lit(False))
    if match == "city_date":
        return F.when(hist, F.concat(F.lit("hist:"), F.coalesce(F.col("date"), F.lit("")))).otherwise(F.lit("fcst"))
    return F.when(hist, F.lit("hist")).otherwise(F.lit("fcst"))


def market_class(match: str = "city") -> Column:
    closed = F.coalesce(F.col("closed"), F.lit(False))
    if match == "city_date":
        return F.when(closed, F.concat(F.lit("hist:"), F.coalesce(F.substring("end_date_iso", 1, 10), F.lit(""))))\
            .otherwise(F.lit("fcst"))
    return F.when(closed, F.lit("hist")).otherwise(F.lit("fcst"))


def _weather_keyed(wx: DataFrame, match: str) -> DataFrame:
    hist = F.coalesce(F.col("data_type") == "historical", F.lit(False))
    return (wx.where(F.col("POLL_TIMESTAMP").isNotNull())
            .select(location_key(F.col("LOCATION_NAME")).alias("_city"),
                    weather_class(hist, match=match).alias("_cls"),
                    F.col("POLL_TIMESTAMP").alias("_from"),
                    # deterministic order among records stamped with the same instant
                    F.xxhash64(F.to_json(F.struct(*wx.columns))).alias("_tb"),
                    *[F.col(e).alias(n) for n, e in WEATHER_PAYLOAD.items()]))


def weather_intervals(wx: DataFrame, match: str = "city") -> DataFrame:
    """One row per weather record with its validity [_from, next__from) in its (city, class)."""
    return lead_by_key(_weather_keyed(wx, match), ["_city", "_cls"], "_from", ["_tb"], ["_from"])


def _hour(ts: Column) -> Column:
    return int_floor_div(F.unix_micros(ts), HOUR_MICROS)


def interval_buckets(iv: DataFrame) -> DataFrame:
    """The intervals that end, cut at hour boundaries."""
    iv = iv.withColumnRenamed("next__from", "_to").where(F.col("_to") > F.col("_from"))
    last_micro = F.unix_micros(F.col("_to")) - 1
    hours = F.sequence(_hour(F.col("_from")), int_floor_div(last_micro, HOUR_MICROS))
    return iv.withColumn("_hour", F.explode(hours)).drop("_tb")


def asof_weather_join(pred: DataFrame, wx: DataFrame, match: str = "city", how: str = "inner") -> DataFrame:
    """pred rows + w_* weather columns of the matched record (see module doc); `how` is
    'inner' (only markets with weather) or 'left' (keep markets without weather)."""
    p = (pred.withColumn("_city", location_key(F.col("LOCATION_NAME")))
         .withColumn("_cls", market_class(match))
         .withColumn("_hour", _hour(F.col("POLL_TIMESTAMP"))))
    iv = weather_intervals(wx, match)
    names = list(WEATHER_PAYLOAD)

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{tag}{c}") for c in ("_city", "_cls", "_from", *[x for x in ("_hour", "_to") if x in df.columns])],
                         F.struct(*names).alias(f"{tag}_w"))

    last = side(iv.where(F.col("next__from").isNull()), "l")
    cut = side(interval_buckets(iv), "c")
    j = p.join(last, [p["_city"] == last["l_city"], p["_cls"] == last["l_cls"]], "left")
    behind = F.coalesce(F.col("POLL_TIMESTAMP") >= F.col("l_from"), F.lit(False))
    j = j.withColumn("_last", F.when(behind, F.col("l_w"))).drop("l_city", "l_cls", "l_from", "l_w")
    cond = [F.col("_last").isNull(), F.col("_city") == F.col("c_city"), F.col("_cls") == F.col("c_cls"),
            F.col("_hour") == F.col("c_hour"), F.col("POLL_TIMESTAMP") >= F.col("c_from"), F.col("POLL_TIMESTAMP") < F.col("c_to")]
    j = j.join(cut, cond, "left").withColumn("_w", F.coalesce("_last", "c_w"))
    if how == "inner":
        j = j.where(F.col("_w").isNotNull())
    own = [c for c in pred.columns if c not in names]
    return j.select(*own, *[F.col("_w")[n].alias(n) for n in names])


def asof_weather_join_plain(pred: DataFrame, wx: DataFrame, match: str = "city") -> DataFrame:
    """Reference form: union both feeds and carry the last weather forward per (city, class).

    Kept as an independent cross-check (tests); it partitions by city, so it is not the engine.
    """
    from pyspark.sql import Window
    w = _weather_keyed(wx, match).withColumn("_is_w", F.lit(1))
    p = (pred.withColumn("_city", location_key(F.col("LOCATION_NAME")))
         .withColumn("_cls", market_class(match)).withColumn("_from", F.col("POLL_TIMESTAMP"))
         .withColumn("_is_w", F.lit(0)).withColumn("_tb", F.lit(None).cast("long")))
    u = p.unionByName(w, allowMissingColumns=True)
    win = (Window.partitionBy("_city", "_cls").orderBy("_from", F.col("_is_w").desc(), "_tb")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.withColumn("_wp", F.last(F.when(F.col("_is_w") == 1, F.struct(*WEATHER_PAYLOAD.keys())),
                                   ignorenulls=True).over(win))
    out = u.where((F.col("_is_w") == 0) & F.col("_wp").isNotNull())
    for n in WEATHER_PAYLOAD:
        out = out.drop(n).withColumn(n, F.col(f"_wp.{n}"))
    return out.drop("_wp", "_city", "_cls", "_from", "_is_w", "_tb")


def forward_weather_join(pred: DataFrame, wx: DataFrame, horizon_seconds: int = 86400,
                         match: str = "city") -> DataFrame:
    """Pending predictions: each market row with the first weather of its city and class that
    arrives strictly after it, within `horizon_seconds`; unmatched rows keep null weather
    (they expire).  Intervals (prev, this] are bucketed by hour like the as-of join."""
    w = lag_by_key(_weather_keyed(wx, match), ["_city", "_cls"], "_from", ["_tb"], ["_from"])
    lo = F.coalesce(F.col("prev__from"), F.col("_from") - F.expr(f"INTERVAL {horizon_seconds} SECONDS"))
    lo = F.greatest(lo, F.col("_from") - F.expr(f"INTERVAL {horizon_seconds} SECONDS"))
    last_micro = F.unix_micros(F.col("_from")) - 1
    iv = (w.withColumn("_lo", lo).where(F.col("_lo") < F.col("_from"))
          .withColumn("_hour", F.explode(F.sequence(_hour(F.col("_lo")),
                                                    int_floor_div(last_micro, HOUR_MICROS))))
          .drop("prev__from", "_tb"))
    iv = iv.withColumnRenamed("_city", "_wcity").withColumnRenamed("_cls", "_wcls")\
        .withColumnRenamed("_hour", "_whour")
    p = (pred.withColumn("_city", location_key(F.col("LOCATION_NAME")))
         .withColumn("_cls", market_class(match))
         .withColumn("_hour", _hour(F.col("POLL_TIMESTAMP"))))
    cond = [p["_city"] == iv["_wcity"], p["_cls"] == iv["_wcls"], p["_hour"] == iv["_whour"],
            p["POLL_TIMESTAMP"] >= iv["_lo"], p["POLL_TIMESTAMP"] < iv["_from"]]
    j = p.join(iv, cond, "left")
    return (j.withColumn("resolved_by", F.col("_from"))
            .withColumn("wait_seconds", F.unix_seconds(F.col("_from")) - F.unix_seconds(F.col("POLL_TIMESTAMP")))
            .drop("_city", "_cls", "_hour", "_wcity", "_wcls", "_whour", "_lo", "_from"))
