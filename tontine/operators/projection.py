"""Projection axis, decrement rates and in-force roll-forward."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tontine.functions.rates import monthly_from_annual, stressed_monthly
from tontine.operators.joins import bounded_broadcast, fan_out
from tontine.params import ValuationParams

FRAME_KEYS = ["cohort_id", "sex", "scenario_id"]
CHAIN_KEYS = ["cohort_id", "sex", "scenario_id", "mort_version_id"]

FRAME_COLUMNS = [
    "cohort_id", "sex", "scenario_id", "issue_age", "sum_assured", "policy_count", "mortality_multiplier",
    "lapse_multiplier", "discount_shift_bps", "remaining_months", "projection_month", "policy_month",
    "duration_year", "attained_age", "valuation_date", "calendar_month_start", "calendar_month_end"]


SCENARIO_DIM = ["scenario_id", "mortality_multiplier", "lapse_multiplier", "discount_shift_bps", "scenario_group"]


def cohort_x_scenario(policy: DataFrame, scenario: DataFrame, params: ValuationParams,
                      dim_columns: Sequence[str] = SCENARIO_DIM) -> DataFrame:
    """Every model point under every scenario (scenario table size-checked, broadcast)."""
    return fan_out(policy, scenario.select(*dim_columns), params.dimension_max_rows)


def projection_frame(policy: DataFrame, scenario: DataFrame, params: ValuationParams,
                     dim_columns: Sequence[str] = SCENARIO_DIM) -> DataFrame:
    """One row per model point x scenario x remaining month.

    Matured contracts (remaining <= 0) are dropped before ``sequence`` (trap T3: Spark's
    sequence(1, 0) is [1, 0]). The month axis is generated in place (no shuffle); all months
    of one model point stay in the partition of their parent row.
    """
    live = policy.filter(F.col("remaining_term_years") > 0)
    base = cohort_x_scenario(live, scenario, params, dim_columns)
    vd = F.lit(params.valuation_date if isinstance(params.valuation_date, _dt.date)
               else _dt.date.fromisoformat(str(params.valuation_date)))
    elapsed = F.col("elapsed_duration_years")
    rem = F.col("remaining_term_years") * 12
    months = base.drop("attained_age").select("*", rem.alias("remaining_months"),
                         F.explode(F.sequence(F.lit(1), rem.cast("int"))).alias("projection_month"))
    m = F.col("projection_month")
    return months.select(
        "*", (elapsed * 12 + m).alias("policy_month"),
        F.ceil((elapsed * 12 + m) / F.lit(12.0)).cast("int").alias("duration_year"),
        (F.col("issue_age") + elapsed + F.floor((m - 1) / F.lit(12)).cast("int")).alias("attained_age"),
        vd.alias("valuation_date"), F.add_months(vd, m - 1).alias("calendar_month_start"),
        F.add_months(vd, m).alias("calendar_month_end"))


def _mortality_side(mortality: DataFrame, params: ValuationParams) -> DataFrame:
    m = mortality.select(F.col("age").alias("attained_age"), "sex", "mort_version_id",
                         F.col("qx_annual").alias("base_qx_annual"))
    return bounded_broadcast(m, params.broadcast_max_rows)


def _lapse_side(lapse: DataFrame, params: ValuationParams) -> DataFrame:
    lp = lapse.select("duration_year", F.col("lapse_rate_annual").alias("base_lapse_annual"))
    return bounded_broadcast(lp, params.broadcast_max_rows)


def with_premium(frame_or_policy: DataFrame, premium: DataFrame) -> DataFrame:
    """F1 at model-point grain: LEFT attach of the monthly gross premium on (cohort_id, sex)
    before the month fan-out (a model point x model point join; the projected rows never
    join it). Rows without a premium keep NULL and emit no cash flows (inner-join semantics
    of the reference's premium attach)."""
    p = premium.select("cohort_id", "sex", (F.col("annual_gross_premium") / F.lit(12.0)).alias("monthly_premium"))
    return frame_or_policy.join(p, ["cohort_id", "sex"], "left")


def with_mortality(frame: DataFrame, mortality: DataFrame, params: ValuationParams) -> DataFrame:
    """INNER lookup on (attained_age, sex), fanning out by mortality version."""
    e = params.monthly_exponent
    return frame.join(_mortality_side(mortality, params), ["attained_age", "sex"], "inner").select(
        "*", monthly_from_annual(F.col("base_qx_annual"), e).alias("base_qx_monthly"),
        stressed_monthly(F.col("base_qx_annual"), F.col("mortality_multiplier"), e).alias("scenario_qx_monthly"))


def with_lapse(frame: DataFrame, lapse: DataFrame, params: ValuationParams) -> DataFrame:
    """LEFT lookup on duration_year (a missing duration gives rate 0, trap T4)."""
    e = params.monthly_exponent
    return frame.join(_lapse_side(lapse, params), ["duration_year"], "left").select(
        "*", monthly_from_annual(F.col("base_lapse_annual"), e).alias("base_lapse_monthly"),
        stressed_monthly(F.col("base_lapse_annual"), F.col("lapse_multiplier"), e).alias("scenario_lapse_monthly"))


def mortality_rates(frame: DataFrame, mortality: DataFrame, params: ValuationParams) -> DataFrame:
    return with_mortality(frame, mortality, params).select(
        "cohort_id", "sex", "scenario_id", "projection_month", "mort_version_id", "base_qx_annual",
        "base_qx_monthly", "mortality_multiplier", "scenario_qx_monthly")


def lapse_rates(frame: DataFrame, lapse: DataFrame, params: ValuationParams) -> DataFrame:
    return with_lapse(frame, lapse, params).select(
        "cohort_id", "sex", "scenario_id", "projection_month", "duration_year", "base_lapse_annual",
        "base_lapse_monthly", "lapse_multiplier", "scenario_lapse_monthly")


def rollforward(rated: DataFrame, keys: Sequence[str] = CHAIN_KEYS) -> DataFrame:
    """E2, E3 on a frame that already carries qx and lx.

    in-force at month m = policy_count x product of monthly survival over months < m, as a
    ``product`` window over ROWS UNBOUNDED PRECEDING .. 1 PRECEDING (one shuffle on ``keys``;
    each window partition holds at most one contract's remaining months). A month with
    survival 0 keeps every later month at 0 (trap T2: exp-sum-ln would revive it).
    """
    qx, lx = F.col("scenario_qx_monthly"), F.col("scenario_lapse_monthly")
    w = (Window.partitionBy(*keys).orderBy("projection_month")
         .rowsBetween(Window.unboundedPreceding, -1))
    surv = (F.lit(1.0) - qx) * (F.lit(1.0) - lx)
    opened = rated.select(
        "*", (F.col("policy_count") * F.coalesce(F.product(surv).over(w), F.lit(1.0))).alias("inforce_open"))
    o = F.col("inforce_open")
    return opened.select(
        "*", (o * qx).alias("expected_deaths"), (o * (F.lit(1.0) - qx)).alias("post_death_inforce"),
        (o * (F.lit(1.0) - qx) * lx).alias("expected_lapses"),
        (o * (F.lit(1.0) - qx) * (F.lit(1.0) - lx)).alias("inforce_close"))


def inforce_wide(frame: DataFrame, mortality: DataFrame, lapse: DataFrame, params: ValuationParams) -> DataFrame:
    """Frame x mortality x lapse in one pass (columns carried, no re-join of the frame)."""
    rated = with_lapse(with_mortality(frame, mortality, params), lapse, params)
    return rollforward(rated)


INFORCE_COLUMNS = ["cohort_id", "sex", "scenario_id", "mort_version_id", "projection_month", "policy_count",
                   "inforce_open", "expected_deaths", "post_death_inforce", "expected_lapses", "inforce_close"]


def projection_years(policy: DataFrame, scenario: DataFrame, params: ValuationParams,
                     dim_columns: Sequence[str] = SCENARIO_DIM) -> DataFrame:
    """Year-level projection axis: attained age and policy duration both step at the same
    12-month boundaries of the projection (age = issue + elapsed + floor((m-1)/12),
    duration = elapsed + ceil(m/12)), so every decrement rate is constant within projection
    year y and one row per year carries it."""
    live = policy.filter(F.col("remaining_term_years") > 0)
    base = cohort_x_scenario(live, scenario, params, dim_columns).drop("attained_age")
    y = F.col("projection_year")
    years = base.select("*", F.explode(F.sequence(F.lit(1), F.col("remaining_term_years").cast("int")))
                        .alias("projection_year"))
    return years.select("*", (F.col("issue_age") + F.col("elapsed_duration_years") + y - 1).alias("attained_age"),
                        (F.col("elapsed_duration_years") + y).cast("int").alias("duration_year"))


def rollforward_years(rated_years: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Monthly in-force from a year-level frame: the window runs over years (12x fewer rows
    than months), S_y = product over earlier years of s^12, then month k of year y opens with
    S_y * s^(k-1), s = (1 - q)(1 - l). A zero-survival month still zeroes every later month."""
    qx, lx = F.col("scenario_qx_monthly"), F.col("scenario_lapse_monthly")
    s = (F.lit(1.0) - qx) * (F.lit(1.0) - lx)
    w = (Window.partitionBy(*keys).orderBy("projection_year").rowsBetween(Window.unboundedPreceding, -1))
    opened = rated_years.select("*", s.alias("monthly_survival"),
                                F.coalesce(F.product(F.pow(s, F.lit(12.0))).over(w), F.lit(1.0)).alias("year_open"))
    months = opened.select("*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month_in_year"))
    k = F.col("month_in_year")
    return months.select(
        "*", ((F.col("projection_year") - 1) * 12 + k).alias("projection_month"),
        (F.col("policy_count") * F.col("year_open")
         * F.pow(F.col("monthly_survival"), (k - 1).cast("double"))).alias("inforce_open"))


def inforce_wide_years(policy: DataFrame, scenario: DataFrame, mortality: DataFrame, lapse: DataFrame,
                       params: ValuationParams) -> DataFrame:
    """E1-E3 with the window at year grain: the same monthly in-force rows as ``inforce_wide``
    (up to rounding in the last bits), but the roll-forward shuffle moves one row per
    projection year instead of twelve."""
    years = projection_years(policy, scenario, params)
    rated = with_lapse(with_mortality(years, mortality, params), lapse, params)
    monthly = rollforward_years(rated, CHAIN_KEYS)
    o, qx, lx = F.col("inforce_open"), F.col("scenario_qx_monthly"), F.col("scenario_lapse_monthly")
    return monthly.select(
        "*", (F.col("remaining_term_years") * 12).alias("remaining_months"),
        (o * qx).alias("expected_deaths"), (o * (F.lit(1.0) - qx)).alias("post_death_inforce"),
        (o * (F.lit(1.0) - qx) * lx).alias("expected_lapses"),
        (o * (F.lit(1.0) - qx) * (F.lit(1.0) - lx)).alias("inforce_close"))
