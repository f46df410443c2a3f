"""Report queries over the marts (I1-I10). Each returns a DataFrame; the caller picks the sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.params import ValuationParams

# Column order of the sensitivity heat-map and the decay checkpoints (months)
MATRIX_SCENARIOS = ["MORT_DOWN", "LAPSE_UP", "RATE_UP", "LAPSE_DOWN", "RATE_DOWN", "PERSIST_IMPROVE", "MORT_UP",
                    "COMBINED_ADVERSE"]
DECAY_MONTHS = [(1, "month_1"), (60, "year_5"), (120, "year_10"), (180, "year_15")]
SENSITIVITY_REPORT_SCENARIOS = ["MORT_UP", "RATE_UP", "LAPSE_UP"]
DISCOUNT_CHART_SCENARIOS = ["BASE", "RATE_UP", "RATE_DOWN"]


def report_base(core: DataFrame, params: ValuationParams) -> DataFrame:
    """BASE components rounded to units, by BEL per policy descending."""
    r = lambda c: F.round(c, 0).alias(c)
    return (core.filter(F.col("scenario_id") == params.base_scenario)
            .select("cohort_id", "sex", "issue_age", "remaining_term_years", "version_id", "mort_version_id",
                    r("premium_pv"), r("benefit_pv"), r("expense_pv"), r("bel_amount"), "policy_count",
                    r("bel_per_policy"))
            .orderBy(F.col("bel_per_policy").desc()))


def report_portfolio(portfolio: DataFrame) -> DataFrame:
    """Portfolio overview in millions, BASE labelled 'Base'."""
    return (portfolio.select(
        "scenario_id", F.coalesce("scenario_group", F.lit("Base")).alias("scenario_group"), "version_id",
        "mort_version_id", F.round(F.col("total_bel") / 1000000, 2).alias("total_bel_m"),
        F.round(F.col("total_delta_bel") / 1000000, 2).alias("delta_bel_m"),
        F.round(F.col("weighted_avg_delta_pct") * 100, 1).alias("delta_pct"), "total_delta_bel")
        .orderBy(F.col("total_delta_bel").desc()).drop("total_delta_bel"))


def report_validation(mart_validation: DataFrame) -> DataFrame:
    """Verdict counts."""
    return mart_validation.groupBy("overall_validation_status").agg(F.count(F.lit(1)).alias("count"))


def report_sensitivity(sensitivity: DataFrame, scenarios: Sequence[str] = tuple(SENSITIVITY_REPORT_SCENARIOS)) -> DataFrame:
    """I4: deltas (millions, percent) for a few scenarios."""
    return (sensitivity.filter(F.col("scenario_id").isin(list(scenarios)))
            .select("cohort_id", "sex", "scenario_id", "version_id", "mort_version_id",
                    F.round(F.col("delta_bel") / 1000000, 2).alias("delta_m"),
                    F.round(F.col("delta_bel_pct") * 100, 1).alias("delta_pct"))
            .orderBy("scenario_id", "cohort_id", "sex", "version_id", "mort_version_id"))


def report_decay(inforce: DataFrame, params: ValuationParams,
                 months: Sequence[tuple[int, str]] = tuple(DECAY_MONTHS)) -> DataFrame:
    """BASE in-force at a few months (conditional aggregation = pivot on fixed months).
    Grouped per mortality basis too (the reference's export would take the max across bases)."""
    base = inforce.filter(F.col("scenario_id") == params.base_scenario)
    aggs = [F.max(F.when(F.col("projection_month") == m, F.round("inforce_open", 0))).alias(name) for m, name in months]
    return base.groupBy("cohort_id", "sex", "mort_version_id").agg(*aggs).orderBy("cohort_id", "sex", "mort_version_id")


def survival_curve(inforce: DataFrame, params: ValuationParams) -> DataFrame:
    """BASE in-force as a percentage of the initial count, by month."""
    return (inforce.filter(F.col("scenario_id") == params.base_scenario)
            .select("cohort_id", "sex", "mort_version_id", "projection_month",
                    (F.col("inforce_open") / F.col("policy_count") * 100).alias("survival_pct")))


def df_by_scenario(discounted: DataFrame, scenarios: Sequence[str] = tuple(DISCOUNT_CHART_SCENARIOS)) -> DataFrame:
    """Distinct death-benefit discount factors by scenario and month (all model points)."""
    return (discounted.filter((F.col("cashflow_type") == "death_benefit") & F.col("scenario_id").isin(list(scenarios)))
            .select("cohort_id", "sex", "scenario_id", "version_id", "projection_month", "discount_factor")
            .distinct())


def df_by_scenario_from_table(frame: DataFrame, factors: DataFrame, mortality: DataFrame, curve: DataFrame, max_rows: int,
                              scenarios: Sequence[str] = tuple(DISCOUNT_CHART_SCENARIOS)) -> DataFrame:
    """I7 straight from the discount-factor table: the months of the frame that have a death benefit
    (a premium and a mortality row), joined with the factor of their month. The frame's key
    is unique, so nothing is expanded and nothing is made distinct."""
    from tontine.operators.discounting import curve_horizon
    from tontine.operators.joins import bounded_broadcast
    months = (frame.filter(F.col("scenario_id").isin(list(scenarios)) & F.col("monthly_premium").isNotNull())
              .join(mortality.select(F.col("age").alias("attained_age"), "sex").distinct(), ["attained_age", "sex"], "left_semi")
              .withColumn("dm_key", F.least(F.col("projection_month"), (curve_horizon(curve) + 1).cast("int"))))
    f = bounded_broadcast(factors.select("version_id", "discount_shift_bps", F.col("discount_month").alias("dm_key"), "discount_factor"), max_rows)
    return (months.join(f, ["discount_shift_bps", "dm_key"])
            .select("cohort_id", "sex", "scenario_id", "version_id", "projection_month", "discount_factor"))


def bel_waterfall(bel: DataFrame, params: ValuationParams, by: str = "bel_amount") -> DataFrame:
    """I8: BASE components per model point, sorted by ``by`` (``bel_amount`` or ``bel_per_policy``)
    within each curve and basis."""
    return (bel.filter(F.col("scenario_id") == params.base_scenario)
            .select(F.concat_ws("-", "cohort_id", "sex").alias("model_point"), "version_id", "mort_version_id",
                    "premium_pv", "benefit_pv", "expense_pv", "bel_amount", "bel_per_policy")
            .orderBy("version_id", "mort_version_id", by, "model_point"))


def delta_ranking(portfolio: DataFrame, params: ValuationParams) -> DataFrame:
    """Stressed scenarios ordered by portfolio delta."""
    return (portfolio.filter(F.col("scenario_id") != params.base_scenario)
            .select("scenario_id", "scenario_group", "version_id", "mort_version_id", "total_delta_bel",
                    "weighted_avg_delta_pct")
            .orderBy("total_delta_bel"))


def sensitivity_matrix(sensitivity: DataFrame, scenarios: Sequence[str] = tuple(MATRIX_SCENARIOS)) -> DataFrame:
    """Model point x scenario -> mean delta_bel_pct, scenario columns in a fixed order
    (pivot values given, so no extra pass to discover them)."""
    mp = F.concat_ws("-", "cohort_id", "sex").alias("model_point")
    return (sensitivity.groupBy(mp, "version_id", "mort_version_id")
            .pivot("scenario_id", list(scenarios)).agg(F.avg("delta_bel_pct")))
