"""Keyed joins of markets and weather that don't depend on how rows arrive.

Rows wait in list state until the watermark has passed them; event-time timers then settle them in the
order of their own times.  So files may be shuffled, a feed may lag behind the other by any number of
micro-batches (the watermark is the lesser of both feeds'), and input may be throttled: what comes out is
what the batch operators give, as long as no row is later than the watermark's delay.  Rows that are later
still are dropped by Spark before they reach the state and counted (jobs.LateRows).

State of a key: rows that the watermark hasn't passed, and what `settle` must remember of older ones
(the newest record of each class for the as-of join; for pending markets, the first record's time and
the markets that still wait).
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: one row of either feed: _src is 0 for weather, 1 for a market; _us is its time in microseconds
INPUT = ["_city", "_salt", "_src", "_cls", "_ts", "_us", "_tb", "_payload"]
_ROW = T.StructType([T.StructField("kind", T.StringType()), T.StructField("us", T.LongType()), T.StructField("tb", T.LongType()),
                     T.StructField("payload", T.StringType())])
_SETTLED = T.StructType([T.StructField("ms", T.LongType())])
_COLUMNS = ["kind", "us", "tb", "payload"]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_COLUMNS).astype({"kind": object, "us": "int64", "tb": "int64", "payload": object})


class EventTimeJoin(StatefulProcessor):
    """Base: collects both feeds of a key and calls `settle` each time the watermark passes a row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.markets = handle.getListState("markets", _ROW)
        self.weather = handle.getListState("weather", _ROW)
        self.settled = handle.getValueState("settled", _SETTLED)

    def settle(self, key, markets: pd.DataFrame, weather: pd.DataFrame, us: int) -> tuple[pd.DataFrame | None, pd.DataFrame, pd.DataFrame, list[int]]:
        """Both feeds' rows in time order and the time up to which they are complete -> what to emit,
        the markets and the weather to keep, and the times (us) at which to look again at the latest."""
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = {}
        for pdf in rows:                       # chunk by chunk: a key's rows of a micro-batch aren't joined to one frame
            if list(pdf.columns) != INPUT and len(pdf.columns) == len(INPUT):
                pdf.columns = INPUT
            for src, state in ((1, self.markets), (0, self.weather)):
                part = pdf[pdf["_src"] == src]
                if len(part):
                    state.appendList(list(zip(part["_cls"], part["_us"].astype("int64").tolist(), part["_tb"].astype("int64").tolist(), part["_payload"])))
                    first[src] = min(first.get(src, part["_us"].min()), part["_us"].min())
        for us in {int(x) for x in first.values()}:
            self._look_at(us)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ms = timerValues.getCurrentWatermarkInMs()
        if self.settled.exists() and self.settled.get()[0] >= ms:
            return                             # several timers of a key may end at once
        markets, weather = (_frame(list(s.get()) if s.exists() else []) for s in (self.markets, self.weather))
        out, markets, weather, later = self.settle(key, markets.sort_values(["us", "payload"], kind="stable"),
                                                   weather.sort_values(["us", "tb"], kind="stable"), ms * 1000)
        for state, kept in ((self.markets, markets), (self.weather, weather)):
            if len(kept):
                state.put(list(kept.itertuples(index=False, name=None)))
            elif state.exists():
                state.clear()
        self.settled.update((ms,))
        waiting = [int(x["us"].min()) for x in (markets[markets["us"] > ms * 1000], weather[weather["us"] > ms * 1000]) if len(x)]
        for us in {*waiting, *later}:
            self._look_at(us)
        if out is not None and len(out):
            yield out

    def _look_at(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def close(self) -> None:
        pass


ASOF_OUTPUT = T.StructType([T.StructField(n, T.StringType()) for n in ("_city", "_payload", "_w_payload")])


class AsOfJoin(EventTimeJoin):
    """Each market with the newest weather record of its class at or before its own time; at one instant,
    the record with the greatest tie-break counts, as in the batch join.  Markets without any are dropped."""

    def settle(self, key, markets, weather, us):
        ready, known = markets[markets["us"] <= us], weather[weather["us"] <= us]
        found = []
        for cls, part in ready.groupby("kind", sort=False):
            seen = known[known["kind"] == cls]
            at = seen["us"].searchsorted(part["us"], side="right") - 1
            has = at >= 0
            found.append(pd.DataFrame({"_city": key[0], "_payload": part["payload"].to_numpy()[has], "_w_payload": seen["payload"].to_numpy()[at[has]]}))
        newest = known.groupby("kind", sort=False).tail(1)
        return (pd.concat(found, ignore_index=True) if found else None, markets[markets["us"] > us],
                pd.concat([newest, weather[weather["us"] > us]]), [])


PENDING_OUTPUT = T.StructType([T.StructField("question_id", T.StringType()), T.StructField("_us", T.LongType()), T.StructField("_by_us", T.LongType())])


class PendingJoin(EventTimeJoin):
    """Markets of a class that had no weather yet, each once: with the first record after it within the
    time to live, or with none when that has passed.  Of older weather only the first record's time is
    kept for each class: a market after it isn't pending, one before it is resolved by it."""

    def __init__(self, ttl_us: int) -> None:
        self.ttl_us = ttl_us

    def settle(self, key, markets, weather, us):
        known = weather[weather["us"] <= us].groupby("kind", sort=False).head(1)
        first = dict(zip(known["kind"], known["us"]))
        ready = markets[markets["us"] <= us]
        began = ready["kind"].map(first).astype("float64")
        told = ready[~(began <= ready["us"])]                     # no weather at or before the market
        by = told["kind"].map(first).astype("Int64")
        in_time = (by <= told["us"] + self.ttl_us).fillna(False).astype(bool)
        over = in_time | by.notna() | (told["us"] + self.ttl_us <= us)
        out = pd.DataFrame({"question_id": told["payload"], "_us": told["us"], "_by_us": by.where(in_time)})[over]
        wait = told[~over]
        return (out, pd.concat([wait, markets[markets["us"] > us]]), pd.concat([known, weather[weather["us"] > us]]),
                [int(wait["us"].min()) + self.ttl_us] if len(wait) else [])


# ------------------------------------------------------------------ silence

SILENCE_INPUT = ["feed", "polled_us", "records"]
SILENCE_OUTPUT = T.StructType([T.StructField("feed", T.StringType()), T.StructField("event", T.StringType()),
                               T.StructField("at_ms", T.LongType()), T.StructField("last_poll_us", T.LongType())])
_FEED = T.StructType([T.StructField("polled_us", T.LongType()), T.StructField("alarm", T.BooleanType())])


class Silence(StatefulProcessor):
    """Per feed: one 'silent' event when nothing has come for `silence_ms` of processing time, which a
    timer tells without any input, and one 'back' event when the feed returns."""

    def __init__(self, silence_ms: int) -> None:
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.feed = handle.getValueState("feed", _FEED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        polled, alarm = self.feed.get() if self.feed.exists() else (None, False)
        for pdf in rows:
            if list(pdf.columns) != SILENCE_INPUT:
                pdf.columns = SILENCE_INPUT
            newest = pdf["polled_us"].max()
            if pd.notna(newest):
                polled = max(int(newest), polled or 0)
        now = timerValues.getCurrentProcessingTimeInMs()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now + self.silence_ms)
        self.feed.update((polled, False))
        if alarm:
            yield pd.DataFrame({"feed": [key[0]], "event": ["back"], "at_ms": [now], "last_poll_us": pd.array([polled], "Int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        polled, _ = self.feed.get()
        self.feed.update((polled, True))
        yield pd.DataFrame({"feed": [key[0]], "event": ["silent"], "at_ms": [expiredTimerInfo.getExpiryTimeInMs()],
                            "last_poll_us": pd.array([polled], "Int64")})

    def close(self) -> None:
        pass
