"""Explicit schemas for every stream and table; nothing is inferred."""
from __future__ import annotations

from pyspark.sql import types as T

S, D, B, L, I = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType(), T.IntegerType()
TS = T.TimestampType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_MARKET = _struct(
    ("question", S), ("outcomePrices", S), ("outcomes", S), ("winner", S), ("conditionId", S),
    ("id", S), ("slug", S), ("endDate", S), ("startDate", S), ("closed", B), ("active", B),
    ("volume", D),
)

# One polled event: API payload plus the poll time the poller stamped on it (text, '...Z').
RAW_EVENT = _struct(
    ("title", S), ("slug", S), ("tags", T.ArrayType(S)), ("markets", T.ArrayType(RAW_MARKET)),
    ("POLL_TIMESTAMP", S),
)

CURRENT = _struct(
    ("time", S), ("temperature_2m", D), ("precipitation", D), ("rain", D), ("weather_code", I),
    ("wind_speed_10m", D), ("relative_humidity_2m", D),
)
CURRENT_UNITS = _struct(("time", S), ("temperature_2m", S))

RAW_WEATHER = _struct(
    ("latitude", D), ("longitude", D), ("current_units", CURRENT_UNITS), ("current", CURRENT),
    ("daily", _struct(("temperature_2m_max", T.ArrayType(D)), ("temperature_2m_min", T.ArrayType(D)))),
    # landing metadata written by the poller
    ("kind", S), ("date", S), ("LOCATION_NAME", S), ("POLL_TIMESTAMP", S),
)

TOKEN = _struct(("outcome", S), ("price", D), ("winner", B))

PRED = _struct(
    ("condition_id", S), ("question_id", S), ("question", S), ("market_slug", S),
    ("end_date_iso", S), ("game_start_time", S), ("closed", B), ("active", B),
    ("tokens", T.ArrayType(TOKEN)), ("tags", T.ArrayType(S)), ("LOCATION_NAME", S),
    ("POLL_TIMESTAMP", TS), ("price_sum", D), ("arbitrage_flag", B), ("volume", D),
)

WX = _struct(
    ("latitude", D), ("longitude", D), ("data_type", S), ("date", S), ("current", CURRENT),
    ("current_units", CURRENT_UNITS),
    ("daily", _struct(("temperature_2m_max", D), ("temperature_2m_min", D))),
    ("LOCATION_NAME", S), ("POLL_TIMESTAMP", TS),
)

CORR_COLUMNS = [
    "condition_id", "question", "question_type", "LOCATION_NAME", "yes_price", "target_temp",
    "actual_temp", "data_type", "market_closed", "ACTUAL_OUTCOME", "PREDICTION_ERROR",
    "CORRELATION_LATENCY_SEC", "arbitrage_flag", "POLL_TIMESTAMP",
]

CORR = _struct(
    ("condition_id", S), ("question", S), ("question_type", S), ("LOCATION_NAME", S),
    ("yes_price", D), ("target_temp", D), ("actual_temp", D), ("data_type", S),
    ("market_closed", B), ("ACTUAL_OUTCOME", I), ("PREDICTION_ERROR", D),
    ("CORRELATION_LATENCY_SEC", L), ("arbitrage_flag", B), ("POLL_TIMESTAMP", TS),
)

ACC_COLUMNS = [
    "LOCATION_NAME", "window_start", "window_end", "total_count", "correct_count", "accuracy_rate",
    "avg_prediction_error", "max_prediction_error", "bias_score", "closed_count",
    "closed_correct_count", "closed_accuracy_rate",
]

ACC = _struct(
    ("LOCATION_NAME", S), ("window_start", TS), ("window_end", TS), ("total_count", L),
    ("correct_count", L), ("accuracy_rate", D), ("avg_prediction_error", D),
    ("max_prediction_error", D), ("bias_score", D), ("closed_count", L),
    ("closed_correct_count", L), ("closed_accuracy_rate", D),
)

ALERT_COLUMNS = ["alert_type", "LOCATION_NAME", "condition_id", "detail", "POLL_TIMESTAMP",
                 "ALERT_TIMESTAMP"]

ALERT = _struct(
    ("alert_type", S), ("LOCATION_NAME", S), ("condition_id", S), ("detail", S),
    ("POLL_TIMESTAMP", TS), ("ALERT_TIMESTAMP", TS),
)

# Serving-table types (the sink narrows numerics like the SQL store does).
CORRELATIONS_TABLE = [
    ("condition_id", "string"), ("question", "string"), ("question_type", "string"),
    ("location_name", "string"), ("yes_price", "decimal(6,4)"), ("target_temp", "decimal(6,2)"),
    ("actual_temp", "decimal(6,2)"), ("data_type", "string"), ("market_closed", "boolean"),
    ("actual_outcome", "smallint"), ("prediction_error", "decimal(6,4)"),
    ("correlation_latency_sec", "int"), ("arbitrage_flag", "boolean"),
    ("poll_timestamp", "timestamp"),
]
ACCURACY_TABLE = [
    ("location_name", "string"), ("window_start", "timestamp"), ("window_end", "timestamp"),
    ("total_count", "int"), ("correct_count", "int"), ("accuracy_rate", "decimal(6,4)"),
    ("avg_prediction_error", "decimal(6,4)"), ("max_prediction_error", "decimal(6,4)"),
    ("bias_score", "decimal(8,4)"), ("closed_count", "int"), ("closed_correct_count", "int"),
    ("closed_accuracy_rate", "decimal(6,4)"),
]
ALERTS_TABLE = [
    ("alert_type", "string"), ("location_name", "string"), ("condition_id", "string"),
    ("detail", "string"), ("poll_timestamp", "timestamp"), ("alert_timestamp", "timestamp"),
]
