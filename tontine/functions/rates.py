"""Decrement-rate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def monthly_from_annual(annual: Column, exponent: float = 1.0 / 12.0) -> Column:
    """Constant-force monthly rate 1 - (1 - q)^(1/12)."""
    return F.lit(1.0) - F.pow(F.lit(1.0) - annual, F.lit(float(exponent)))


def clamp_unit(x: Column) -> Column:
    """Clamp to [0, 1]. Like the reference, greatest() skips NULL, so NULL -> 0.0 (trap T4)."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def stressed_monthly(annual: Column, multiplier: Column, exponent: float = 1.0 / 12.0) -> Column:
    return clamp_unit(monthly_from_annual(annual, exponent) * multiplier)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise on 0)."""
    return F.when(den == 0, F.lit(None).cast("double")).otherwise(num / den)


def round_half_up(x: Column, digits: int) -> Column:
    """The value of ``F.round(x, digits)`` on doubles. Spark goes through a BigDecimal's text, which
    costs far more than the rows' own work; here whole numbers of 10^-digits are taken wherever the
    product cannot lie within its rounding error of a tie, and ``F.round`` decides the rest (near
    ties, large numbers, NaN, infinities, null). The quotient of two exact doubles is the
    double nearest to the decimal, as BigDecimal gives it."""
    scale, slack = float(10 ** digits), 2.0 ** -49
    y = F.abs(x) * F.lit(scale)
    low, high = (F.floor(y * F.lit(k) + F.lit(0.5)) for k in (1.0 - slack, 1.0 + slack))
    near = low.cast("double") / F.lit(scale)
    return F.when((y < F.lit(2.0 ** 50)) & (low == high), F.when(x < 0, -near).otherwise(near)).otherwise(F.round(x, digits))
