"""Seriatim valuation through unit factors (the scaling path).

Every cash flow is linear in policy_count x sum_assured (premiums are priced per unit of sum
assured), and the decrements depend only on the risk cell (sex, issue_age, term_years,
elapsed_duration_years). So:

1. the distinct cells of the portfolio are projected once with policy_count = 1 and
   sum_assured = 1 (the cell set is bounded by the attribute domain, not the policy count);
2. the roll-forward runs once per distinct (mortality x, lapse x) chain, not per scenario
   (RATE_UP/RATE_DOWN share BASE's chain);
3. per (cell, scenario, curve, mortality basis) three sums are taken,
   a_start = sum open*DF(m-1), a_end = sum open*DF(m), b = sum open*q*DF(m), giving the unit
   premium, benefit and expense PVs;
4. policies are valued by one broadcast join to that factor table (``policy_bel``), or first
   pre-aggregated per (segment, sex, cell) so that only a few hundred rows are joined
   (``segment_bel``): one scan of the policy table, map-side partial aggregation, immune to a hot
   segment or cell.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.functions.rates import safe_ratio
from tontine.operators import discounting as DS
from tontine.operators import projection as PJ
from tontine.operators.cashflow import expense_rate
from tontine.operators.joins import bounded_broadcast
from tontine.params import ValuationParams
from tontine.plans.pipeline import Valuation
from tontine.session import drop_unused_shuffles
from tontine.sources.fixtures import RawInputs
from tontine.sources.schemas import RAW_SCHEMAS, conform

CELL = ["sex", "issue_age", "term_years", "elapsed_duration_years"]
OUT_KEYS = ["cohort_id", "sex", "scenario_id", "version_id", "mort_version_id"]
FACTOR_COLUMNS = ["cell_id", "sex", "scenario_id", "version_id", "mort_version_id", "unit_premium",
                  "premium_pv_unit", "benefit_pv_unit", "expense_pv_unit"]


def cell_id() -> F.Column:
    return F.concat_ws("|", "issue_age", "term_years", "elapsed_duration_years")


def unit_cells(policies: DataFrame) -> DataFrame:
    """Distinct risk cells as unit model points (policy_count = sum_assured = 1)."""
    cells = policies.select(cell_id().alias("cohort_id"), *CELL).distinct()
    return conform(cells.select(
        "cohort_id", "sex", "issue_age", "term_years",
        (F.col("issue_age") + F.col("term_years")).alias("maturity_age"), F.lit(1).alias("sum_assured"),
        F.lit(1).alias("policy_count"), "elapsed_duration_years", F.lit("UNIT_CELL").alias("version_id")),
        RAW_SCHEMAS["policy_cohort_input"])


class FactorValuation:
    """``policies``: one row per policy (cohort_id, sex, cell attributes, sum_assured,
    policy_count). ``exposure`` (optional): the same book already summed per (cohort_id, sex,
    cell) as (exposure = sum of policy_count x sum_assured, policy_count); when given, the unit
    cells and ``segment_bel`` read it instead of the policies. ``dealt``: the policies are already
    spread over all tasks, so that ``policy_bel`` need not shuffle them for it."""

    def __init__(self, policies: DataFrame, raw: RawInputs, params: ValuationParams | None = None,
                 exposure: DataFrame | None = None, dealt: bool = False):
        self.policies = policies
        self.dealt = dealt
        self.params = params or ValuationParams()
        self._raw = raw
        self._exposure_in = exposure

    @cached_property
    def exposure(self) -> DataFrame | None:
        """The pre-aggregated exposure (small: segments x sexes x cells), persisted: the unit-cell
        projection and ``segment_bel`` run as separate jobs and both read it, so the policy table
        is scanned once (a lost block is recomputed from its lineage, one scan)."""
        if self._exposure_in is None:
            return None
        return self._exposure_in.persist()

    @cached_property
    def unit(self) -> Valuation:
        cells_from = self.exposure if self.exposure is not None else self.policies
        unit_raw = RawInputs(**{**self._raw.__dict__, "policy_cohort_input": unit_cells(cells_from),
                                "premium_input": None})
        return Valuation(unit_raw, self.params)

    @cached_property
    def chains(self) -> DataFrame:
        return (self.unit.staged.scenario.select("mortality_multiplier", "lapse_multiplier").distinct()
                .withColumn("chain_id", F.concat_ws("|", "mortality_multiplier", "lapse_multiplier")))

    @cached_property
    def unit_inforce(self) -> DataFrame:
        """Unit roll-forward per (cell, chain, mortality basis, month); the window runs at
        year grain (rates are constant within a projection year) and months are expanded
        after it, so the only shuffle moves 1/12 of the monthly rows."""
        st, p = self.unit.staged, self.params
        years = PJ.projection_years(st.policy, self.chains, p,
                                    dim_columns=["chain_id", "mortality_multiplier", "lapse_multiplier"])
        rated = PJ.with_lapse(PJ.with_mortality(years, st.mortality, p), st.lapse, p)
        return PJ.rollforward_years(rated, keys=["cohort_id", "sex", "chain_id", "mort_version_id"])

    @cached_property
    def factors(self) -> DataFrame:
        """Unit PVs per (cell, scenario, curve version, mortality basis) per 1 of sum assured,
        materialized (checkpoint) because every policy-level result joins it."""
        return self.unit._boundary(self._factors())

    def _factors(self) -> DataFrame:
        st, p = self.unit.staged, self.params
        scen = bounded_broadcast(st.scenario.select("scenario_id", "mortality_multiplier", "lapse_multiplier",
                                                    "discount_shift_bps"), p.dimension_max_rows)
        inf = (self.unit_inforce
               .select("cohort_id", "sex", "mortality_multiplier", "lapse_multiplier", "mort_version_id",
                       "projection_month", "inforce_open", "scenario_qx_monthly")
               .join(scen, ["mortality_multiplier", "lapse_multiplier"], "inner"))
        sums = DS.pv_sums(inf, st.curve, st.scenario, p, ["cohort_id", "sex", "scenario_id", "mort_version_id"])
        prem = self.unit.staged.premium.select("cohort_id", "sex",
                                               F.col("annual_gross_premium").alias("unit_premium"))
        mp = F.col("unit_premium") / F.lit(12.0)
        rate = expense_rate(st.expense, p)
        return (sums.join(prem, ["cohort_id", "sex"], "inner")
                .select(F.col("cohort_id").alias("cell_id"), "sex", "scenario_id", "version_id", "mort_version_id",
                        "unit_premium", F.coalesce(-(mp * F.col("a_start")), F.lit(0.0)).alias("premium_pv_unit"),
                        F.coalesce(F.col("b"), F.lit(0.0)).alias("benefit_pv_unit"),
                        F.coalesce(mp * rate * F.col("a_end"), F.lit(0.0)).alias("expense_pv_unit")))

    # ---------------------------------------------------------------- policy level
    def materialized_factors(self) -> DataFrame:
        """Factor table written to the checkpoint folder (cuts the projection lineage, so a
        lost executor does not replay it) and broadcast when its row count is small."""
        return bounded_broadcast(self.factors, self.params.broadcast_max_rows)

    def policy_bel(self) -> DataFrame:
        """PV per policy x scenario x curve x mortality basis (broadcast hash join: the policy
        table is streamed once, dealt evenly before its rows become 72 each, since a scan of few
        row groups or a small shuffle would leave them to few tasks; policies that come ``dealt``
        are not shuffled again). The shuffles that led to the factors are dropped first."""
        spark, factors = self.policies.sparkSession, self.materialized_factors()
        drop_unused_shuffles(spark)
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        pol = (self.policies if self.dealt else self.policies.repartition(parts)).withColumn("cell_id", cell_id())
        scale = F.col("policy_count") * F.col("sum_assured")
        j = pol.join(factors, ["cell_id", "sex"], "inner")
        out = j.select(
            "policy_id", "cohort_id", "sex", "scenario_id", "version_id", "mort_version_id",
            (F.col("sum_assured") * F.col("unit_premium")).alias("annual_gross_premium"),
            (scale * F.col("premium_pv_unit")).alias("premium_pv"),
            (scale * F.col("benefit_pv_unit")).alias("benefit_pv"),
            (scale * F.col("expense_pv_unit")).alias("expense_pv"))
        return out.withColumn("bel_amount", F.col("benefit_pv") + F.col("expense_pv") + F.col("premium_pv"))

    def segment_bel(self) -> DataFrame:
        """BEL per (segment, sex, scenario, curve, mortality basis) over all policies."""
        if self.exposure is not None:
            exposure = self.exposure.select("cohort_id", "sex", cell_id().alias("cell_id"), "exposure",
                                            "policy_count")
        else:
            exposure = (self.policies.groupBy("cohort_id", "sex", cell_id().alias("cell_id"))
                        .agg(F.sum(F.col("policy_count") * F.col("sum_assured")).alias("exposure"),
                             F.sum("policy_count").alias("policy_count")))
        e = F.col("exposure")
        g = (exposure.join(self.materialized_factors(), ["cell_id", "sex"], "inner")
             .groupBy(*OUT_KEYS)
             .agg(F.sum(e * F.col("premium_pv_unit")).alias("premium_pv"),
                  F.sum(e * F.col("benefit_pv_unit")).alias("benefit_pv"),
                  F.sum(e * F.col("expense_pv_unit")).alias("expense_pv"),
                  F.sum("policy_count").alias("policy_count")))
        return (g.withColumn("bel_amount", F.col("benefit_pv") + F.col("expense_pv") + F.col("premium_pv"))
                .withColumn("bel_per_policy", safe_ratio(F.col("bel_amount"), F.col("policy_count"))))
