"""Numeric and text helpers with engine-independent results.

Averages are formed from integer sums so that the rounded value is the exact rational
mean rounded once; the same expressions give identical doubles in any IEEE engine.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round4(x) -> Column:
    """Round half toward +infinity to 4 decimals, i.e. floor(v * 1e4 + 0.5) / 1e4."""
    return F.floor(_c(x) * 10000.0 + 0.5) / 10000.0


def python_round4(x) -> Column:
    """Python's round(x, 4): the double's exact value rounded to 4 decimals, ties to even.

    x * 1e4 is split without error into a rounded product and its remainder (the double is halved
    into two parts of 26 bits, whose products with 1e4 are exact), so ties are told from near ties."""
    x = _c(x)
    c = x * 134217729.0                      # 2^27 + 1
    high = c - (c - x)
    p = x * 10000.0
    rest = (high * 10000.0 - p) + (x - high) * 10000.0
    low = F.floor(p)
    over = (p - low - 0.5) + rest            # sign of the distance to the half above `low`
    up = F.when(over > 0, 1).when((over == 0) & (F.pmod(low, F.lit(2)) != 0), 1).otherwise(0)
    return (low + up) / 10000.0


def scaled_int(x, scale: int) -> Column:
    """Nearest integer of v * scale (half toward +infinity); exact for decimals up to log10(scale) places."""
    return F.floor(_c(x) * float(scale) + 0.5)


def int_floor_div(x, d: int) -> Column:
    """Exact floor(x / d) for a long column and positive integer d."""
    x = _c(x)
    return ((x - F.pmod(x, F.lit(d))) / d).cast("long")


def half_up_ratio(num, den, out_scale: int) -> Column:
    """round-half-up(num / den) expressed in units of 1/out_scale, as a double.

    num, den are integer columns; num / den is already in units of 1/out_scale.
    """
    return F.floor(_c(num) / _c(den) + 0.5) / float(out_scale)


def half_away_ratio(num, den, out_scale: int) -> Column:
    """round-half-away-from-zero(num / den) in units of 1/out_scale (SQL ROUND on NUMERIC)."""
    num, den = _c(num), _c(den)
    return F.signum(num) * F.floor(F.abs(num) / den + 0.5) / float(out_scale)


def fixed_text(x, digits: int) -> Column:
    """printf-style '%.Nf' with half-up rounding of the value's shortest decimal form.

    This is how the JVM formats doubles, so it equals String.format on the same value.
    """
    return F.format_string(f"%.{digits}f", _c(x))
