"""Cash-flow lines (F1-F6). Sign convention: insurer inflow < 0, outflow > 0."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.params import ValuationParams

CASHFLOW_COLUMNS = ["cohort_id", "sex", "scenario_id", "mort_version_id", "projection_month",
                    "cashflow_type", "cashflow_amount", "cashflow_timing"]


def expense_rate(expense: DataFrame, params: ValuationParams):
    """the maintenance rate as a scalar subquery (one row expected; checked by
    ``checks.single_expense_row``)."""
    return expense.filter(F.col("expense_type") == params.expense_type).select("expense_rate").scalar()


def cashflow_lines(inforce: DataFrame, expense: DataFrame, params: ValuationParams,
                   carry: tuple[str, ...] = ("discount_shift_bps",)) -> DataFrame:
    """F1-F6 on in-force rows that carry ``monthly_premium`` (attached at model-point grain by
    ``projection.with_premium``): three lines per row in one pass (``inline`` of a 3-element
    array, so the upstream window runs once instead of once per UNION ALL branch)."""
    mp = inforce.filter(F.col("monthly_premium").isNotNull())
    o, prem = F.col("inforce_open"), F.col("monthly_premium")
    rate = expense_rate(expense, params)

    def line(kind: str, amount, timing: str):
        return F.struct(F.lit(kind).alias("cashflow_type"), amount.cast("double").alias("cashflow_amount"),
                        F.lit(timing).alias("cashflow_timing"))

    lines = F.array(
        line("premium", -(o * prem), "month_start"),
        line("death_benefit", F.col("expected_deaths") * F.col("sum_assured"), "month_end"),
        line("expense", o * prem * rate, "month_end"))
    keys = ["cohort_id", "sex", "scenario_id", "mort_version_id", "projection_month", *carry]
    return mp.select(*keys, F.inline(lines))
