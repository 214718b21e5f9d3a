"""Per-key ordered operators (lag, lead, running sums, range frames) that never put a whole key
into one task.

A plain `Window.partitionBy(key)` sends every row of a key to one task; with a hot key (one city
holding a third of the data) that task becomes the job.  Here each key is cut into time blocks
(an hour by default) and the row-level window runs per (key, block).  What a block needs from the
blocks before or after it -- the previous block's last row, the next block's first row, or the
running total of all earlier blocks -- is computed on a per-block summary (one row per key and
block, partially aggregated before the shuffle) and injected into the block as a single "carry"
row, so the row-level pass stays one window over (key, block).  The only per-key window runs over
the block summaries, whose size is bounded by the time span, not by the data volume.

Range frames (`rangeBetween`) use halo rows instead: a row is copied into the next block only if
it lies within the frame width of that block's start.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxodds.functions.core import int_floor_div

DAY_SECONDS = 86400
BLOCK_SECONDS = 3600          # a dense key's day is then spread over 24 tasks
_BLK, _CARRY, _V = "_blk", "_carry", "_carry_v"


def time_block(ts, block_seconds: int = BLOCK_SECONDS) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return int_floor_div(F.unix_micros(ts), block_seconds * 1_000_000)


def _order(ts: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(ts)] + [F.col(c) for c in tiebreak]


def lag_by_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str],
               values: Sequence[str], prefix: str = "prev_",
               block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Add prefix+v = value of v on the previous row of the same key in (ts, *tiebreak) order.

    Keys must be non-null (fill a sentinel first); ts must be non-null.
    """
    keys, values = list(keys), list(values)
    d = df.withColumn(_BLK, time_block(ts, block_seconds)).withColumn(_CARRY, F.lit(False))
    last = d.groupBy(*keys, _BLK).agg(
        F.max_by(F.struct(*values), F.struct(*_order(ts, tiebreak))).alias(_V))
    carry = (last.withColumn("_next", F.lead(_BLK).over(Window.partitionBy(*keys).orderBy(_BLK)))
             .where(F.col("_next").isNotNull())
             .select(*keys, F.col("_next").alias(_BLK), F.lit(True).alias(_CARRY), f"{_V}.*"))
    u = d.unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*keys, _BLK).orderBy(F.col(_CARRY).desc(), *_order(ts, tiebreak))
    for v in values:
        u = u.withColumn(prefix + v, F.lag(v).over(w))
    return u.where(~F.col(_CARRY)).drop(_BLK, _CARRY)


def lead_by_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str],
                values: Sequence[str], prefix: str = "next_",
                block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Add prefix+v = value of v on the next row of the same key in (ts, *tiebreak) order."""
    keys, values = list(keys), list(values)
    d = df.withColumn(_BLK, time_block(ts, block_seconds)).withColumn(_CARRY, F.lit(False))
    first = d.groupBy(*keys, _BLK).agg(
        F.min_by(F.struct(*values), F.struct(*_order(ts, tiebreak))).alias(_V))
    carry = (first.withColumn("_prev", F.lag(_BLK).over(Window.partitionBy(*keys).orderBy(_BLK)))
             .where(F.col("_prev").isNotNull())
             .select(*keys, F.col("_prev").alias(_BLK), F.lit(True).alias(_CARRY), f"{_V}.*"))
    u = d.unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*keys, _BLK).orderBy(F.col(_CARRY).asc(), *_order(ts, tiebreak))
    for v in values:
        u = u.withColumn(prefix + v, F.lead(v).over(w))
    return u.where(~F.col(_CARRY)).drop(_BLK, _CARRY)


def running_sums_by_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str],
                        sums: dict[str, Column], block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Add running totals (rows unbounded preceding .. current row) of each expression in `sums`."""
    keys = list(keys)
    names = list(sums)
    d = (df.withColumn(_BLK, time_block(ts, block_seconds)).withColumn(_CARRY, F.lit(False))
         .select("*", *[e.alias(f"_x_{n}") for n, e in sums.items()]))
    tot = d.groupBy(*keys, _BLK).agg(*[F.sum(f"_x_{n}").alias(f"_x_{n}") for n in names])
    before = Window.partitionBy(*keys).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = (tot.select(*keys, _BLK, *[F.sum(f"_x_{n}").over(before).alias(f"_x_{n}") for n in names])
             .where(F.col(f"_x_{names[0]}").isNotNull())
             .withColumn(_CARRY, F.lit(True)))
    u = d.unionByName(carry, allowMissingColumns=True)
    w = (Window.partitionBy(*keys, _BLK).orderBy(F.col(_CARRY).desc(), *_order(ts, tiebreak))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for n in names:
        u = u.withColumn(n, F.sum(f"_x_{n}").over(w))
    return u.where(~F.col(_CARRY)).drop(_BLK, _CARRY, *[f"_x_{n}" for n in names])


def range_frame_by_key(df: DataFrame, keys: Sequence[str], ts: str, seconds: int,
                       aggs: dict[str, Column], block_seconds: int | None = None) -> DataFrame:
    """Add aggregates over RANGE BETWEEN `seconds` PRECEDING AND CURRENT ROW (by ts) per key.

    Each row also goes, as a halo copy, to the next block when it lies within `seconds` of that
    block's start, so every frame is complete inside its (key, block) partition.
    """
    keys = list(keys)
    block_seconds = block_seconds or max(DAY_SECONDS, 2 * seconds)
    assert block_seconds >= seconds
    micros = F.unix_micros(F.col(ts))
    blk = time_block(ts, block_seconds)
    next_start = (blk + 1) * (block_seconds * 1_000_000)
    real = df.withColumn("_part", blk).withColumn("_halo", F.lit(False))
    halo = (df.where(micros >= next_start - seconds * 1_000_000)
            .withColumn("_part", blk + 1).withColumn("_halo", F.lit(True)))
    u = real.unionByName(halo)
    w = (Window.partitionBy(*keys, "_part").orderBy(F.unix_micros(F.col(ts)))
         .rangeBetween(-seconds * 1_000_000, 0))
    for n, e in aggs.items():
        u = u.withColumn(n, e.over(w))
    return u.where(~F.col("_halo")).drop("_part", "_halo")


def scan_by_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str],
                sums: dict[str, Column], lags: Sequence[str] = (), prefix: str = "prev_",
                block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Running sums and lags in one pass: one per-block summary, one carry row per block.

    Equals running_sums_by_key followed by lag_by_key, with half the shuffles.
    """
    keys, lags, names = list(keys), list(lags), list(sums)
    xs = [f"_x_{n}" for n in names]
    d = (df.withColumn(_BLK, time_block(ts, block_seconds)).withColumn(_CARRY, F.lit(False))
         .select("*", *[e.alias(f"_x_{n}") for n, e in sums.items()]))
    summary = d.groupBy(*keys, _BLK).agg(
        *[F.sum(x).alias(x) for x in xs],
        *([F.max_by(F.struct(*lags), F.struct(*_order(ts, tiebreak))).alias(_V)] if lags else []))
    wb = Window.partitionBy(*keys).orderBy(_BLK)
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *keys, _BLK, *[F.sum(x).over(before).alias(x) for x in xs],
        *([F.lag(_V).over(wb).alias(_V)] if lags else []))
    carry = carry.where(F.col(xs[0]).isNotNull()).withColumn(_CARRY, F.lit(True))
    if lags:
        carry = carry.select("*", *[F.col(f"{_V}.{v}").alias(v) for v in lags]).drop(_V)
    u = d.unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(*keys, _BLK).orderBy(F.col(_CARRY).desc(), *_order(ts, tiebreak))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = u.select("*", *[F.sum(x).over(run).alias(n) for n, x in zip(names, xs)],
                 *[F.lag(v).over(w).alias(prefix + v) for v in lags])
    return u.where(~F.col(_CARRY)).drop(_BLK, _CARRY, *xs)
