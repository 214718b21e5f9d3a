"""Stateful processors for transformWithStateInPandas.

Each processor sees one key's rows of a micro-batch, orders them by event time and carries the
minimum per-key state across batches (keyed value states).  Nested record
fields travel as one JSON `_payload` string, so the Python side only touches keys, times and
state; all parsing and scoring stays in JVM expressions before and after the processor.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

def _frame(rows, columns: list[str]) -> pd.DataFrame:
    """Concatenate a key's batches; columns may arrive positionally named (_0, _1, ...), so
    they are mapped to the processor's declared input order."""
    pdf = pd.concat(list(rows), ignore_index=True)
    if list(pdf.columns) != columns and len(pdf.columns) == len(columns):
        pdf.columns = columns
    return pdf


# ------------------------------------------------------------------ as-of weather

ASOF_COLUMNS = ["_city", "_salt", "_src", "_cls", "_ts", "_tb", "_payload"]
ASOF_OUTPUT = T.StructType([
    T.StructField("_city", T.StringType()), T.StructField("_ts", T.TimestampType()),
    T.StructField("_payload", T.StringType()), T.StructField("_w_payload", T.StringType()),
])
_WEATHER_STATE = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("tb", T.LongType()),
                               T.StructField("payload", T.StringType())])


class AsOfWeatherProcessor(StatefulProcessor):
    """Per (city, salt bucket): remember the newest forecast and the newest historical record, with
    their times; each market row takes the latest record of its class at or before its own time, of
    those in its micro-batch and the remembered one.  A record older than the remembered one, arriving
    late, never replaces it.  A market row that comes in an earlier micro-batch than its weather has no
    match (see README, open points)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.states = {"fcst": handle.getValueState("newest_forecast", _WEATHER_STATE),
                       "hist": handle.getValueState("newest_historical", _WEATHER_STATE)}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, ASOF_COLUMNS)[["_src", "_cls", "_ts", "_tb", "_payload"]]
        known = [(0, cls, *state.get()) for cls, state in self.states.items() if state.exists()]
        if known:
            pdf = pd.concat([pd.DataFrame(known, columns=pdf.columns), pdf], ignore_index=True)
        # weather (_src = 0) before markets (_src = 1) at equal instants
        pdf = pdf.sort_values(["_ts", "_src", "_tb"], kind="stable")
        weather = pdf["_src"] == 0
        pdf["_w_payload"] = pdf["_payload"].where(weather).groupby(pdf["_cls"]).ffill()
        newest = pdf[weather].groupby("_cls").tail(1)
        for cls, ts, tb, payload in zip(newest["_cls"], newest["_ts"], newest["_tb"], newest["_payload"]):
            self.states[cls].update((ts.to_pydatetime(), int(tb), payload))
        out = pdf[~weather & pdf["_w_payload"].notna()]
        if len(out):
            yield pd.DataFrame({"_city": [key[0]] * len(out), "_ts": out["_ts"].array, "_payload": out["_payload"].array,
                                "_w_payload": out["_w_payload"].array})

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ accuracy baseline

BASELINE_OUTPUT = T.StructType([
    T.StructField("LOCATION_NAME", T.StringType()), T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()), T.StructField("accuracy_rate", T.DoubleType()),
    T.StructField("baseline_n", T.LongType()), T.StructField("_s1", T.LongType()),
    T.StructField("_s2", T.LongType()), T.StructField("prev_accuracy_rate", T.DoubleType()),
])
BASELINE_COLUMNS = ["LOCATION_NAME", "window_start", "window_end", "accuracy_rate", "_r"]
_BASELINE_STATE = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("s1", T.LongType()),
    T.StructField("s2", T.LongType()), T.StructField("prev", T.DoubleType()),
])


class BaselineProcessor(StatefulProcessor):
    """Per city, in window_end order: running n, sum r, sum r^2 (r = rate * 1e4, exact) and the
    previous rate; never expires, like the reference's Welford state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("baseline", _BASELINE_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, BASELINE_COLUMNS).sort_values(["window_end", "window_start"], kind="stable")
        n, s1, s2, prev = self.state.get() if self.state.exists() else (0, 0, 0, None)
        if not len(pdf):
            return
        r = pdf["_r"].astype("int64")
        out = pd.DataFrame({
            "LOCATION_NAME": key[0], "window_start": pdf["window_start"], "window_end": pdf["window_end"],
            "accuracy_rate": pdf["accuracy_rate"].astype(float), "baseline_n": n + r.reset_index(drop=True).index.to_numpy() + 1,
            "_s1": s1 + r.cumsum(), "_s2": s2 + (r * r).cumsum(), "prev_accuracy_rate": pdf["accuracy_rate"].shift().astype(float)})
        if prev is not None:
            out.iloc[0, out.columns.get_loc("prev_accuracy_rate")] = prev
        last = out.iloc[-1]
        self.state.update((int(last["baseline_n"]), int(last["_s1"]), int(last["_s2"]), float(last["accuracy_rate"])))
        yield out

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ price-change cache

PRICE_OUTPUT = T.StructType([T.StructField("_payload", T.StringType())])
PRICE_COLUMNS = ["_ck", "_ts", "_qid", "_prices", "_payload"]
_PRICE_STATE = T.StructType([T.StructField("prices", T.StringType())])


class PriceChangeProcessor(StatefulProcessor):
    """Per market: pass an open row only when its price tuple differs from the last one seen;
    the memory is updated by every open row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_prices", _PRICE_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, PRICE_COLUMNS).sort_values(["_ts", "_qid"], kind="stable")
        if not len(pdf):
            return
        before = pdf["_prices"].shift()
        if self.last.exists():
            before.iloc[0] = self.last.get()[0]
        kept = pdf["_payload"][pdf["_prices"].fillna("\0") != before.fillna("\0")]
        newest = pdf["_prices"].iloc[-1]
        if newest is not None:
            self.last.update((newest,))
        if len(kept):
            yield pd.DataFrame({"_payload": kept.array})

    def close(self) -> None:
        pass


EXPIRING_COLUMNS = ["_ck", "_ts", "_us", "_qid", "_prices", "_payload"]
_EXPIRING_STATE = T.StructType([T.StructField("prices", T.StringType()), T.StructField("us", T.LongType())])


class ExpiringPriceChangeProcessor(StatefulProcessor):
    """`PriceChangeProcessor` that forgets a market `ttl_us` after its last open row.  A row later than that passes
    whether or not the timer has fired yet, so the result doesn't depend on when it fires."""

    def __init__(self, ttl_us: int):
        self.ttl_us = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_prices", _EXPIRING_STATE)

    def _end(self, us: int) -> int:
        """The first millisecond at which a market last seen at `us` is forgotten."""
        return (us + self.ttl_us) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _frame(rows, EXPIRING_COLUMNS).sort_values(["_us", "_qid"], kind="stable")
        if not len(pdf):
            return
        before, at = pdf["_prices"].shift(), pdf["_us"].shift(fill_value=pdf["_us"].iloc[0])
        known, seen = self.last.get() if self.last.exists() else (None, None)
        if seen is not None:
            before.iloc[0], at.iloc[0] = known, seen
        kept = (pdf["_prices"].fillna("\0") != before.fillna("\0")) | (pdf["_us"] - at > self.ttl_us)
        newest, us = pdf["_prices"].iloc[-1], int(pdf["_us"].iloc[-1])
        if seen is None or us >= seen:
            if seen is not None:
                self.handle.deleteTimer(self._end(seen))
            self.last.update((known if newest is None else newest, us))
            self.handle.registerTimer(self._end(us))
        if kept.any():
            yield pd.DataFrame({"_payload": pdf["_payload"][kept].array})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists() and self._end(self.last.get()[1]) <= timerValues.getCurrentWatermarkInMs():
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass
