"""Rounding that comes out the same on every engine and at every size."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def _quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _whole(col: Column) -> Column:
    """Exact integers wider than a long: token totals times 10^6 overflow one."""
    return col.cast("decimal(20,0)")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` in percent, rounded half up; NULL for an empty whole."""
    scale = 10 ** digits
    units = _quotient(
        _whole(part) * F.lit(200 * scale) + _whole(whole), _whole(whole) * F.lit(2)
    )
    return F.when(whole != 0, units / F.lit(float(scale)))


def exact_round(value: Column, digits: int) -> Column:
    """Round a double by its exact binary value, ties to even, as Python does.

    ``round`` works on the shortest decimal form instead, which moves every
    score such as 9.955 (binary 9.9550000000000000711) or 2.675 (2.67499...).
    For absolute values between 10^-6 and 16, which are whole in units of
    2^-75. ``value`` should be a plain column: it is used several times.
    """
    coarse = F.abs(value) * F.lit(float(2 ** 30))
    high = coarse.cast("long")
    low = ((coarse - high.cast("double")) * F.lit(float(2 ** 45))).cast("long")
    unit, half = F.lit(Decimal(2 ** 75)), F.lit(Decimal(2 ** 74 - 1))
    scaled = (_whole(high) * F.lit(Decimal(2 ** 45)) + _whole(low)) * F.lit(10 ** digits)
    odd = _quotient(scaled, unit) % 2
    # adding just under half a unit, or half if the quotient is odd, sends ties to even
    return F.signum(value) * (_quotient(scaled + half + odd, unit) / F.lit(float(10 ** digits)))


def ten_point(compound: Column) -> Column:
    """Polarity in -1..1 on the 0..10 scale with two decimals.

    DECIMAL(4,2), since a polarity of 0.999 already rounds to 10.00.
    """
    return exact_round((compound.cast("double") + 1) * 5, 2).cast("decimal(4,2)")
