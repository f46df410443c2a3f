"""Curve bracket, linear zero-rate interpolation and discount factor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def discount_month(projection_month: Column, timing: Column) -> Column:
    """month_start cash flows are discounted from m-1, month_end from m."""
    return (F.when(timing == "month_start", projection_month - 1)
            .when(timing == "month_end", projection_month))


def lower_tenor(dm: Column) -> Column:
    """Last annual grid point strictly below dm (0 for the first year)."""
    return F.when(dm <= 0, F.lit(0)).otherwise((F.floor((dm - 1) / F.lit(12)) * 12).cast("int"))


def upper_tenor(dm: Column) -> Column:
    """First annual grid point at or above dm."""
    return F.when(dm <= 0, F.lit(12)).otherwise((F.ceil(dm / F.lit(12)) * 12).cast("int"))


def interpolated_rate(dm: Column, lo_t: Column, hi_t: Column, lo_r: Column, hi_r: Column,
                      shift_bps: Column) -> Column:
    """Linear interpolation of the zero rate, plus the scenario shift (bps)."""
    inner = (F.when(dm <= 0, F.lit(0.0))
             .when(lo_t == hi_t, hi_r)
             .otherwise(lo_r + (hi_r - lo_r) * (dm.cast("double") - lo_t) / (hi_t - lo_t)))
    return inner + shift_bps / F.lit(10000.0)


def discount_factor(dm: Column, rate: Column) -> Column:
    """1 / (1 + r)^(dm / 12); exactly 1.0 at dm <= 0 whatever the shift."""
    return F.when(dm <= 0, F.lit(1.0)).otherwise(
        F.lit(1.0) / F.pow(F.lit(1.0) + rate, dm.cast("double") / F.lit(12.0)))
