"""Valuation (H1-H8): BEL components, core mart, sensitivity, portfolio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tontine.functions.rates import safe_ratio
from tontine.params import ValuationParams

BEL_KEYS = ["cohort_id", "sex", "scenario_id", "version_id", "mort_version_id"]
BEL_CARRY = ("policy_count", "issue_age", "remaining_months", "scenario_group")
BEL_COLUMNS = ["cohort_id", "sex", "scenario_id", "version_id", "mort_version_id", "premium_pv", "benefit_pv",
               "expense_pv", "bel_amount", "policy_count", "bel_per_policy"]
CORE_COLUMNS = ["cohort_id", "sex", "issue_age", "remaining_term_years", "scenario_id", "scenario_group",
                "version_id", "mort_version_id", "premium_pv", "benefit_pv", "expense_pv", "bel_amount",
                "policy_count", "bel_per_policy"]
SENS_COLUMNS = ["cohort_id", "sex", "scenario_id", "scenario_group", "version_id", "mort_version_id",
                "bel_base", "bel_stressed", "delta_bel", "delta_bel_pct"]
PORTFOLIO_COLUMNS = ["scenario_id", "scenario_group", "version_id", "mort_version_id", "total_bel",
                     "total_delta_bel", "weighted_avg_delta_pct"]


def _pv(kind: str) -> F.Column:
    return F.sum(F.when(F.col("cashflow_type") == kind, F.col("discounted_cashflow")).otherwise(F.lit(0.0)))


def bel_wide(discounted: DataFrame, carry: Sequence[str] = BEL_CARRY) -> DataFrame:
    """H1-H3: conditional PV sums per (model point, scenario, curve, mortality basis).

    Partial aggregation runs map-side before the single shuffle. Attributes that are
    functionally dependent on the model point (policy_count, issue_age, ...) are carried as
    grouping columns, replacing the reference's joins back to the frame.
    """
    g = (discounted.groupBy(*BEL_KEYS, *carry)
         .agg(_pv("premium").alias("premium_pv"), _pv("death_benefit").alias("benefit_pv"),
              _pv("expense").alias("expense_pv")))
    bel = F.col("benefit_pv") + F.col("expense_pv") + F.col("premium_pv")
    return g.select("*", bel.alias("bel_amount"), safe_ratio(bel, F.col("policy_count")).alias("bel_per_policy"))


def bel_from_inforce(inforce: DataFrame, curve: DataFrame, scenario: DataFrame, expense_rate,
                     params: ValuationParams, carry: Sequence[str] = BEL_CARRY) -> DataFrame:
    """H1-H3 straight from in-force rows (carrying monthly_premium, sum_assured and the
    scenario shift): the same BEL as summing discounted cash-flow lines, by linearity, without
    expanding each row into 3 lines x curve versions. As in the line sums, a PV whose discount
    factors are all NULL is 0 (other lines contribute zeros there)."""
    from tontine.operators.discounting import pv_sums
    keys = ["cohort_id", "sex", "scenario_id", "mort_version_id", "monthly_premium", "sum_assured", *carry]
    rows = inforce.filter(F.col("monthly_premium").isNotNull())
    s = pv_sums(rows, curve, scenario, params, keys)
    mp, sa = F.col("monthly_premium"), F.col("sum_assured")
    z = F.lit(0.0)
    g = s.select(*BEL_KEYS, *carry,
                 F.coalesce(-(mp * F.col("a_start")), z).alias("premium_pv"),
                 F.coalesce(sa * F.col("b"), z).alias("benefit_pv"),
                 F.coalesce(mp * expense_rate * F.col("a_end"), z).alias("expense_pv"))
    bel = F.col("benefit_pv") + F.col("expense_pv") + F.col("premium_pv")
    return g.select("*", bel.alias("bel_amount"), safe_ratio(bel, F.col("policy_count")).alias("bel_per_policy"))


def bel_components(wide: DataFrame) -> DataFrame:
    return wide.select(*BEL_COLUMNS)


def mart_core(wide: DataFrame) -> DataFrame:
    """H4: core mart (issue age, remaining term in years, scenario group)."""
    return wide.withColumn("remaining_term_years", (F.col("remaining_months") / F.lit(12)).cast("int")) \
        .select(*CORE_COLUMNS)


def mart_sensitivity(core: DataFrame, params: ValuationParams) -> DataFrame:
    """H5: stressed vs BASE on (cohort, sex, curve, mortality basis) in one window pass
    (no self-join); stressed rows without a BASE row are dropped, like an inner join."""
    w = Window.partitionBy("cohort_id", "sex", "version_id", "mort_version_id")
    is_base = F.col("scenario_id") == params.base_scenario
    d = (core.select("*", F.max(F.when(is_base, F.col("bel_amount"))).over(w).alias("bel_base"),
                     F.max(F.when(is_base, F.lit(1))).over(w).alias("has_base"))
         .filter(~is_base & (F.col("has_base") == 1)))
    delta = F.col("bel_amount") - F.col("bel_base")
    return d.select("cohort_id", "sex", "scenario_id", "scenario_group", "version_id", "mort_version_id", "bel_base",
                    F.col("bel_amount").alias("bel_stressed"), delta.alias("delta_bel"),
                    safe_ratio(delta, F.abs(F.col("bel_base"))).alias("delta_bel_pct"))


def mart_portfolio(core: DataFrame, sensitivity: DataFrame, params: ValuationParams) -> DataFrame:
    """H6-H8: BASE totals per (curve, mortality basis) plus stressed totals = base + delta."""
    base = (core.filter(F.col("scenario_id") == params.base_scenario)
            .groupBy("version_id", "mort_version_id").agg(F.sum("bel_amount").alias("total_bel")))
    sens = (sensitivity.groupBy("scenario_id", "scenario_group", "version_id", "mort_version_id")
            .agg(F.sum("delta_bel").alias("total_delta_bel"),
                 safe_ratio(F.sum("delta_bel"), F.sum(F.abs("bel_base"))).alias("weighted_avg_delta_pct")))
    base_rows = base.select(F.lit(params.base_scenario).alias("scenario_id"),
                            F.lit(None).cast("string").alias("scenario_group"), "version_id", "mort_version_id",
                            "total_bel", F.lit(0.0).alias("total_delta_bel"),
                            F.lit(0.0).alias("weighted_avg_delta_pct"))
    stressed = (sens.join(base, ["version_id", "mort_version_id"], "inner")
                .select("scenario_id", "scenario_group", "version_id", "mort_version_id",
                        (F.col("total_bel") + F.col("total_delta_bel")).alias("total_bel"),
                        "total_delta_bel", "weighted_avg_delta_pct"))
    return base_rows.unionByName(stressed)
