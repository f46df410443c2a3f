"""Query registry: for each key, the Spark builder, the DuckDB oracle SQL and one output spec.

The output spec fixes every column's type and decimal rounding, applied identically on both
sides so that last-bit differences of pow/summation order cannot break the value hash.
Kinds: 's' string, 'i' bigint, 'b' boolean, 'date', 'dN' double rounded to N decimals.
Every query reads the driver's orders, customer or lineitem tables: model points, seriatim policies
and the assumption tables of the staging and curve keys are derived from them and grow with them.
The model-point and seriatim valuations themselves read the fixed invented assumption tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.functions.rates import round_half_up
from tontine.operators import curves as CV
from tontine.operators import discounting as DG
from tontine.operators import experience as EX
from tontine.operators import joins as JN
from tontine.operators import pricing as PR
from tontine.operators import projection as PJ
from tontine.operators import quality as DQ
from tontine.operators import reports as RP
from tontine.operators import staging as ST
from tontine.params import ValuationParams
from tontine.plans import oracle as O
from tontine.plans.factor import FactorValuation
from tontine.plans.pipeline import Valuation
from tontine.sources import assumptions as AS
from tontine.sources import fixtures as FX
from tontine.sources import rejects as RJ


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str, params: ValuationParams | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.params = params or ValuationParams()

    @cached_property
    def raw(self) -> FX.RawInputs:
        return FX.load_inputs(self.spark, self.sf_dir)

    @cached_property
    def v(self) -> Valuation:
        return Valuation(self.raw, self.params)

    @cached_property
    def rules(self) -> dict[str, list[DQ.Rule]]:
        return DQ.pipeline_rules(self.params.checks_by_mort_version)

    @cached_property
    def key_assertions(self) -> list[tuple]:
        return self.v.key_assertions(self.rules)

    @cached_property
    def policies(self) -> DataFrame:
        return FX.policies(FX.read_table(self.spark, self.sf_dir, "orders"),
                           FX.read_table(self.spark, self.sf_dir, "customer"))

    @cached_property
    def parts(self) -> int:
        """The tasks that policies are dealt to before they fan out."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.spark.sparkContext.defaultParallelism)

    @cached_property
    def customer_pieces(self) -> dict[int, int]:
        return JN.hot_buckets(FX.read_table(self.spark, self.sf_dir, "orders"), "o_custkey", self.parts)

    @cached_property
    def dealt_policies(self) -> DataFrame:
        return FX.policies(FX.read_table(self.spark, self.sf_dir, "orders"),
                           FX.read_table(self.spark, self.sf_dir, "customer"), self.customer_pieces, self.parts)

    @cached_property
    def exposure(self) -> DataFrame:
        """A boundary: nothing holds its plan, so that the files of its shuffle of the orders can go
        before the policies are shuffled."""
        return self.v._boundary(FX.policy_exposure(FX.read_table(self.spark, self.sf_dir, "orders"),
                                                   FX.read_table(self.spark, self.sf_dir, "customer"), self.customer_pieces))

    @cached_property
    def agency(self) -> FX.AgencyAssumptions:
        return FX.agency_assumptions(FX.read_table(self.spark, self.sf_dir, "orders"))

    @cached_property
    def histories(self) -> DataFrame:
        return FX.policy_histories(FX.read_table(self.spark, self.sf_dir, "orders"))

    @cached_property
    def study(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return EX.study(self.histories, self.raw.mortality_assumption, STUDY_BASE, STUDY_VERSION, *STUDY_WINDOW, boundary=self.v._boundary)

    @cached_property
    def study_valuation(self) -> Valuation:
        mortality = EX.with_experience(self.raw.mortality_assumption, self.v._boundary(self.study[2]))
        return Valuation(replace(self.raw, mortality_assumption=mortality), replace(self.params, mort_versions=(STUDY_BASE, STUDY_VERSION)))

    @cached_property
    def agency_bases(self) -> DataFrame:
        """Every agency is a portfolio whose versions are its base versions."""
        return self.agency.assumption_version.withColumn("is_base_version", F.lit(True))

    @cached_property
    def loaded(self) -> tuple[RJ.Loaded, RJ.Loaded]:
        """The sheets of the agencies' rates and the suppliers' curves, loaded with their rejects."""
        return (RJ.mortality_by_sex(FX.mortality_sheet(FX.read_table(self.spark, self.sf_dir, "orders")), "AGENCY"),
                RJ.curve_points(FX.curve_sheet(self.lineitem)))

    @cached_property
    def lineitem(self) -> DataFrame:
        return FX.read_table(self.spark, self.sf_dir, "lineitem")

    @cached_property
    def supplier_curves(self) -> DataFrame:
        return FX.supplier_curves(self.lineitem)

    @cached_property
    def supplier_pairs(self) -> DataFrame:
        return FX.supplier_pairs(self.lineitem)

    @cached_property
    def fv(self) -> FactorValuation:
        return FactorValuation(self.dealt_policies, self.raw, self.params, exposure=self.exposure, dealt=True)


@dataclass
class Spec:
    build: Callable[[Ctx], DataFrame]
    cols: str
    sql: str | None
    study: bool = False  # its SQL reads the mortality table that the experience study adds to

    @property
    def columns(self) -> list[tuple[str, str]]:
        out = []
        for item in self.cols.split():
            name, kind = item.split(":")
            out.append((name, kind))
        return out


def finalize(df: DataFrame, columns: list[tuple[str, str]], rounding: bool = True) -> DataFrame:
    """Project to the spec's columns and types; ``rounding`` applies the decimal rounding used
    for the oracle comparison (the bench times the operator output without it)."""
    exprs = []
    for name, kind in columns:
        c = F.col(f"`{name}`")
        if kind == "s":
            e = c.cast("string")
        elif kind == "i":
            e = c.cast("long")
        elif kind == "b":
            e = c.cast("boolean")
        elif kind == "date":
            e = c.cast("date")
        else:
            e = (round_half_up(c.cast("double"), int(kind[1:])) + F.lit(0.0)) if rounding else c.cast("double")
        exprs.append(e.alias(name))
    return df.select(*exprs)


def finalize_sql(sql: str, columns: list[tuple[str, str]]) -> str:
    exprs = []
    for name, kind in columns:
        q = f'"{name}"'
        if kind == "s":
            e = f"CAST({q} AS VARCHAR)"
        elif kind == "i":
            e = f"CAST({q} AS BIGINT)"
        elif kind == "b":
            e = f"CAST({q} AS BOOLEAN)"
        elif kind == "date":
            e = f"CAST({q} AS DATE)"
        else:
            e = f"round(CAST({q} AS DOUBLE), {int(kind[1:])}) + 0e0"
        exprs.append(f"{e} AS {q}")
    return f"SELECT {', '.join(exprs)} FROM (\n{sql}\n) q"


# ---------------------------------------------------------------- column specs
C_MP = "cohort_id:s sex:s"
C_K3 = "cohort_id:s sex:s scenario_id:s"
C_K5 = "cohort_id:s sex:s scenario_id:s version_id:s mort_version_id:s"
C_FRAME = (C_K3 + " issue_age:i sum_assured:i policy_count:i mortality_multiplier:d10 lapse_multiplier:d10 "
           "discount_shift_bps:i remaining_months:i projection_month:i policy_month:i duration_year:i attained_age:i "
           "valuation_date:date calendar_month_start:date calendar_month_end:date")
C_INF = (C_K3 + " mort_version_id:s projection_month:i policy_count:i inforce_open:d5 expected_deaths:d5 "
         "post_death_inforce:d5 expected_lapses:d5 inforce_close:d5")
C_BEL = C_K5 + " premium_pv:d2 benefit_pv:d2 expense_pv:d2 bel_amount:d2 policy_count:i bel_per_policy:d4"
C_CORE = ("cohort_id:s sex:s issue_age:i remaining_term_years:i scenario_id:s scenario_group:s version_id:s "
          "mort_version_id:s premium_pv:d2 benefit_pv:d2 expense_pv:d2 bel_amount:d2 policy_count:i "
          "bel_per_policy:d4")
C_SENS = ("cohort_id:s sex:s scenario_id:s scenario_group:s version_id:s mort_version_id:s bel_base:d2 "
          "bel_stressed:d2 delta_bel:d2 delta_bel_pct:d10")
C_PORT = ("scenario_id:s scenario_group:s version_id:s mort_version_id:s total_bel:d1 total_delta_bel:d1 "
          "weighted_avg_delta_pct:d10")


def _grain_cols(p: ValuationParams) -> str:
    return C_K3 + (" mort_version_id:s" if p.checks_by_mort_version else "")


def _in(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def _dq_sql(kinds: tuple[str, ...], p: ValuationParams) -> str:
    """Oracle for the DQ runner: the same rules, written as one SQL count per rule."""
    tables = {
        "stg_policy_cohort_input": "mp_raw", "stg_mortality_assumption": "mort", "stg_lapse_assumption": "lapse",
        "stg_discount_curve": "curve", "stg_expense_assumption": "expense", "stg_premium_input": "prem",
        "stg_stress_scenario_definition": "scen", "int_projection_frame": "frame",
        "int_projection_mortality_rates": "(SELECT *, qx AS scenario_qx_monthly FROM rated)",
        "int_projection_lapse_rates": "lrates", "int_inforce_rollforward": "inf", "int_cashflow_lines": "cf",
        "int_cashflows_discounted": "disc", "int_bel_components": "bel", "val_projection_continuity": "v_proj",
        "val_inforce_reconciliation": "v_inf", "val_cashflow_sign_and_timing": "v_cf",
        "val_discounting_sanity": "v_disc", "val_bel_reconciliation": "v_bel", "val_sensitivity_direction": "v_dir",
        "val_validation_summary": "v_sum", "mart_bel_components_core": "core", "mart_bel_sensitivity": "sens",
        "mart_validation_summary": "v_sum", "mart_portfolio_overview": "port"}
    parts = []
    basis = ",mort_version_id" if p.checks_by_mort_version else ""
    for table, rules in O.DQ_RULES.items():
        src = tables[table]
        for rule in rules:
            word, cols, *rest = rule.format(basis=basis).split(" ", 2)
            kind = {"values": "accepted_values", "range": "accepted_range",
                    "unique": "unique_combination_of_columns" if "," in cols else "unique"}.get(word, word)
            if kind not in kinds:
                continue
            head = f"SELECT '{table}' AS table_name, '{kind}' AS rule, '{cols}' AS columns"
            if word == "unique":
                where = "" if "," in cols else f"WHERE {cols} IS NOT NULL "
                parts.append(f"{head}, (SELECT count(*) FROM (SELECT {cols} FROM {src} t {where}"
                             f"GROUP BY {cols} HAVING count(*) > 1)) AS failing_rows")
                continue
            if word == "not_null":
                bad = f"{cols} IS NULL"
            elif word == "values":
                bad = f"{cols} NOT IN ({rest[0]})"
            else:
                low, high = rest[0].split(" ")[:2], rest[0].split(" ")[2:]
                bad = f"NOT ({cols} {' '.join(low)})" + (f" OR NOT ({cols} {' '.join(high)})" if high else "")
            parts.append(f"{head}, count(*) FILTER (WHERE {bad}) AS failing_rows FROM {src} t")
    return "\nUNION ALL\n".join(parts)


def _dq_build(kinds: tuple[str, ...]):
    def build(c: Ctx) -> DataFrame:
        found = c.v.row_assertions(c.rules, kinds) if set(kinds) <= set(DQ.ROW_RULES) else c.key_assertions
        return c.spark.createDataFrame([x for x in found if x[1] in kinds], DQ.RESULT_SCHEMA)
    return build


C_DQ = "table_name:s rule:s columns:s failing_rows:i"


def _parts(c: Ctx) -> int:
    """Tasks for rows that expand after the last shuffle."""
    return max(int(c.spark.conf.get("spark.sql.shuffle.partitions")), c.spark.sparkContext.defaultParallelism)


def _curve_bracket(c: Ctx) -> DataFrame:
    return DG.curve_bracket(c.supplier_curves, _parts(c))


def _supplier_discounts(c: Ctx) -> DataFrame:
    return DG.discount_factor_table(c.supplier_curves, c.raw.stress_scenario_definition, c.params, _parts(c))


def _long_terms(c):
    """Every policy priced to four times its term: years beyond 40, ages beyond the table."""
    book = c.policies.withColumn("term_years", F.col("term_years") * 4)
    m, d = c.raw.mortality_assumption, c.raw.discount_curve
    return PR.pricing_coverage(book, m, d, c.params).join(PR.premium_rates(book, m, d, c.params), PR.PRICE_KEYS)


LONG_TERMS_SQL = """
SELECT sex, issue_age, term_years, policies, count(*) AS years, count(*) FILTER (qx_annual IS NULL) AS missing_mortality,
       count(*) FILTER (df IS NULL) AS missing_discount, bool_and(qx_annual IS NOT NULL AND df IS NOT NULL) AS priced,
       CASE WHEN bool_and(qx_annual IS NOT NULL AND df IS NOT NULL) THEN sum(df * p * qx_annual) END AS benefit_sum,
       CASE WHEN bool_and(qx_annual IS NOT NULL AND df IS NOT NULL) THEN sum(df * p) END AS annuity_sum
FROM (SELECT y.*, qx_annual, 1e0 / pow(1e0 + zero_rate_annual, y.t + 1e0) AS df,
             coalesce(product(1e0 - qx_annual) OVER (PARTITION BY y.sex, y.issue_age, y.term_years ORDER BY y.t
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1e0) AS p
      FROM (SELECT sex, issue_age, term_years, policies, unnest(generate_series(0, term_years - 1)) AS t
            FROM (SELECT sex, issue_age, 4 * term_years AS term_years, count(*) AS policies FROM pol GROUP BY ALL)) y
      LEFT JOIN mort_raw m ON m.version_id = 'M1' AND m.sex = y.sex AND m.age = y.issue_age + y.t
      LEFT JOIN curve c ON c.version_id = 'A' AND c.tenor_month = 12 * (y.t + 1))
GROUP BY ALL"""


def _rates_read(c: Ctx, stressed: bool) -> DataFrame:
    """Distinct mortality and lapse rates the book's projection reads (D1, or D1 + D4)."""
    m = PJ.with_mortality(c.v.frame_wide, c.v.staged.mortality, c.params)
    l = c.v.lapse_rates
    mcols = [F.lit("mortality").alias("rate_type"), "mort_version_id", "sex", F.col("attained_age").alias("rate_key"),
             F.col("base_qx_annual").alias("annual_rate"), F.col("base_qx_monthly").alias("monthly_rate")]
    lcols = [F.lit("lapse").alias("rate_type"), F.lit(None).cast("string").alias("mort_version_id"),
             F.lit(None).cast("string").alias("sex"), F.col("duration_year").cast("long").alias("rate_key"),
             F.col("base_lapse_annual").alias("annual_rate"), F.col("base_lapse_monthly").alias("monthly_rate")]
    if stressed:
        mcols += [F.col("mortality_multiplier").alias("multiplier"), F.col("scenario_qx_monthly").alias("stressed_rate")]
        lcols += [F.col("lapse_multiplier").alias("multiplier"), F.col("scenario_lapse_monthly").alias("stressed_rate")]
    return m.select(*mcols).unionByName(l.select(*lcols)).distinct()


RATES_SQL = """
SELECT DISTINCT 'mortality' AS rate_type, mort_version_id, sex, CAST(attained_age AS BIGINT) AS rate_key,
       base_qx_annual AS annual_rate, base_qx_monthly AS monthly_rate{m_extra} FROM rated
UNION
SELECT DISTINCT 'lapse', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(duration_year AS BIGINT),
       base_lapse_annual, base_lapse_monthly{l_extra} FROM lrates
"""


#: the experience study: base version, version that it adds, observation window (end excluded)
STUDY_BASE, STUDY_VERSION = "M1", "MX"
STUDY_WINDOW = (dt.date(1996, 1, 1), dt.date(2003, 1, 1))

CELL_KEYS = ["cohort_id", "sex", "issue_age", "term_years", "elapsed_duration_years"]

ASSUMPTION_CHECKS_SQL = """
SELECT 'lapse_duration_missing' AS "check", count(*) AS failing FROM frame f
  WHERE NOT EXISTS (SELECT 1 FROM lapse l WHERE l.duration_year = f.duration_year)
UNION ALL
SELECT 'mortality_rows_dropped', abs((SELECT count(*) FROM frame) * (SELECT count(DISTINCT mort_version_id) FROM mort)
                                     - (SELECT count(*) FROM rated))
UNION ALL
SELECT 'curve_grid_hole', count(*) FILTER (WHERE mx / 12 <> nd)
  FROM (SELECT version_id, max(tenor_month) AS mx, count(DISTINCT tenor_month) AS nd FROM curve GROUP BY 1)
UNION ALL
SELECT 'maintenance_rows_not_one', abs(count(*) - 1) FROM expense WHERE expense_type = 'maintenance'
UNION ALL
SELECT 'curve_key_duplicate', count(*) FROM (SELECT tenor_month, version_id FROM curve GROUP BY ALL HAVING count(*) > 1)
"""


def specs(p: ValuationParams | None = None) -> dict[str, Spec]:
    p = p or ValuationParams()
    base = f"'{p.base_scenario}'"
    g_cols = _grain_cols(p)
    va_case = "CASE WHEN version_id = 'B' THEN 'A' WHEN version_id = 'D' THEN 'C' END"
    decay = ", ".join(f"max(CASE WHEN projection_month = {m} THEN round(inforce_open, 0) END) AS {n}"
                      for m, n in O.DECAY_MONTHS)
    matrix = ", ".join(f"avg(CASE WHEN scenario_id = '{s}' THEN delta_bel_pct END) AS \"{s}\""
                       for s in O.MATRIX_SCENARIOS)
    return {
        # ---------------------------------------------------------- staging (B)
        "stg_policy": Spec(
            lambda c: c.v.staged.policy,
            C_MP + " issue_age:i term_years:i maturity_age:i sum_assured:i policy_count:i elapsed_duration_years:i "
            "attained_age:i remaining_term_years:i cohort_version_id:s",
            "SELECT cohort_id, sex, issue_age, term_years, issue_age + term_years AS maturity_age, sum_assured, "
            "policy_count, elapsed_duration_years, issue_age + elapsed_duration_years AS attained_age, "
            "term_years - elapsed_duration_years AS remaining_term_years, 'COHORT_FIXTURE' AS cohort_version_id "
            "FROM mp_raw"),
        "stg_mortality": Spec(
            lambda c: ST.stg_mortality(c.agency.mortality_assumption, ST.base_versions(c.agency_bases, "mortality")),
            "age:i sex:s qx_annual:d10 source:s year:i mort_version_id:s",
            "SELECT age, sex, qx_annual, source, year, version_id AS mort_version_id FROM a_mort"),
        "stg_lapse": Spec(
            lambda c: ST.stg_lapse_versions(c.agency.lapse_assumption, ST.base_versions(c.agency_bases, "lapse")),
            "duration_year:i lapse_rate_annual:d10 version_id:s",
            "SELECT duration_year, lapse_rate_annual, version_id FROM a_lapse"),
        "stg_expense": Spec(
            lambda c: ST.stg_expense_versions(c.agency.expense_assumption, ST.base_versions(c.agency_bases, "expense")),
            "expense_type:s expense_basis:s expense_rate:d10 version_id:s comment:s",
            "SELECT * FROM a_expense"),
        "stg_version": Spec(
            lambda c: ST.stg_version(c.agency.assumption_version),
            "assumption_type:s version_id:s version_name:s is_base_version:b", "SELECT * FROM a_version"),
        "base_version_counts": Spec(
            lambda c: ST.base_version_counts(c.agency.assumption_version),
            "assumption_type:s n_base:i ok:b",
            "SELECT assumption_type, count(*) FILTER (is_base_version) AS n_base, count(*) FILTER (is_base_version) = 1 AS ok "
            "FROM a_version GROUP BY 1"),
        "stg_curve": Spec(
            lambda c: ST.stg_curve(c.supplier_curves),
            "tenor_month:i zero_rate_annual:d10 version_id:s", "SELECT tenor_month, zero_rate_annual, version_id FROM s_curve"),
        "stg_scenario": Spec(
            lambda c: ST.stg_scenario(c.agency.stress_scenario_definition),
            "scenario_id:s scenario_type:s mortality_multiplier:d10 lapse_multiplier:d10 discount_shift_bps:i "
            "scenario_group:s is_base_scenario:b scenario_description:s",
            "SELECT * FROM a_scen"),
        "stg_premium": Spec(
            lambda c: c.v.staged.premium,
            C_MP + " annual_gross_premium:d4 pricing_assumption_version:s premium_frequency:s premium_currency:s",
            f"SELECT cohort_id, sex, annual_gross_premium, '{p.pricing_version_id}' AS pricing_assumption_version, "
            "'ANNUAL' AS premium_frequency, 'EUR' AS premium_currency FROM prem"),
        # ---------------------------------------------------------- projection axis (C)
        "cohort_x_scenario": Spec(
            lambda c: PJ.cohort_x_scenario(c.v.staged.policy, c.v.staged.scenario, c.params),
            C_MP + " issue_age:i term_years:i elapsed_duration_years:i remaining_term_years:i sum_assured:i "
            "policy_count:i scenario_id:s mortality_multiplier:d10 lapse_multiplier:d10 discount_shift_bps:i "
            "scenario_group:s",
            "SELECT m.*, m.term_years - m.elapsed_duration_years AS remaining_term_years, s.scenario_id, "
            "s.mortality_multiplier, s.lapse_multiplier, s.discount_shift_bps, s.scenario_group "
            "FROM mp_raw m CROSS JOIN scen s"),
        "projection_frame": Spec(lambda c: c.v.projection_frame, C_FRAME, "SELECT * FROM frame"),
        "calendar_axis": Spec(
            lambda c: c.v.projection_frame.select("projection_month", "valuation_date", "calendar_month_start",
                                                  "calendar_month_end").distinct(),
            "projection_month:i valuation_date:date calendar_month_start:date calendar_month_end:date",
            "SELECT DISTINCT projection_month, valuation_date, calendar_month_start, calendar_month_end FROM frame"),
        # ---------------------------------------------------------- rates (D)
        "mortality_rates": Spec(
            lambda c: c.v.mortality_rates,
            C_K3 + " projection_month:i mort_version_id:s base_qx_annual:d10 base_qx_monthly:d10 "
            "mortality_multiplier:d10 scenario_qx_monthly:d10",
            "SELECT cohort_id, sex, scenario_id, projection_month, mort_version_id, base_qx_annual, base_qx_monthly, "
            "mortality_multiplier, qx AS scenario_qx_monthly FROM rated"),
        "lapse_rates": Spec(
            lambda c: c.v.lapse_rates,
            C_K3 + " projection_month:i duration_year:i base_lapse_annual:d10 base_lapse_monthly:d10 "
            "lapse_multiplier:d10 scenario_lapse_monthly:d10",
            "SELECT * FROM lrates"),
        # ---------------------------------------------------------- roll-forward (E)
        "inforce_rollforward": Spec(lambda c: c.v.inforce_rollforward, C_INF, "SELECT * FROM inf"),
        # ---------------------------------------------------------- cash flows (F), discounting (G)
        "cashflow_lines": Spec(
            lambda c: c.v.cashflow_lines,
            C_K3 + " mort_version_id:s projection_month:i cashflow_type:s cashflow_amount:d2 cashflow_timing:s",
            "SELECT * FROM cf"),
        "discounted_cashflows": Spec(
            lambda c: c.v.discounted_cashflows,
            C_K3 + " mort_version_id:s projection_month:i cashflow_type:s cashflow_amount:d2 cashflow_timing:s "
            "version_id:s discount_factor:d10 discounted_cashflow:d2",
            "SELECT * FROM disc"),
        # ---------------------------------------------------------- valuation (H)
        "bel_components": Spec(lambda c: c.v.bel_components, C_BEL, "SELECT * FROM bel"),
        "mart_core": Spec(lambda c: c.v.mart_core, C_CORE, "SELECT * FROM core"),
        "mart_sensitivity": Spec(lambda c: c.v.mart_sensitivity, C_SENS, "SELECT * FROM sens"),
        "mart_portfolio": Spec(lambda c: c.v.mart_portfolio, C_PORT, "SELECT * FROM port"),
        # ---------------------------------------------------------- validation gate (L)
        "val_projection": Spec(
            lambda c: c.v.val_projection,
            C_K3 + " min_month:i max_month:i row_count:i remaining_months:i projection_ok:s", "SELECT * FROM v_proj"),
        "val_inforce": Spec(
            lambda c: c.v.val_inforce,
            g_cols + " max_identity_error:d6 negative_count:i first_month_open:d5 policy_count:i inforce_ok:s",
            "SELECT * FROM v_inf"),
        "val_cashflow": Spec(
            lambda c: c.v.val_cashflow,
            g_cols + " premium_sign_fail:i benefit_sign_fail:i expense_sign_fail:i premium_timing_fail:i "
            "benefit_expense_timing_fail:i cashflow_ok:s", "SELECT * FROM v_cf"),
        "val_discount": Spec(lambda c: c.v.val_discount, C_K5 + " df_non_positive:i df_null:i discount_ok:s",
                             "SELECT * FROM v_disc"),
        "val_bel": Spec(
            lambda c: c.v.val_bel,
            C_K5 + " premium_pv:d2 benefit_pv:d2 expense_pv:d2 bel_amount:d2 bel_error:d2 bel_reconciled:s",
            "SELECT * FROM v_bel"),
        "val_direction": Spec(
            lambda c: c.v.val_direction,
            "cohort_id:s sex:s version_id:s mort_version_id:s scenario_id:s bel_base:d2 bel_stressed:d2 delta_bel:d2 "
            "sensitivity_ok:s", "SELECT * FROM v_dir"),
        "validation_summary": Spec(
            lambda c: c.v.validation_summary,
            C_K5 + " projection_ok:s inforce_ok:s cashflow_ok:s discount_ok:s bel_reconciled:s sensitivity_ok:s "
            "overall_validation_status:s", "SELECT * FROM v_sum"),
        "mart_validation": Spec(
            lambda c: c.v.mart_validation,
            "cohort_id:s sex:s scenario_id:s projection_ok:s version_id:s mort_version_id:s inforce_ok:s "
            "cashflow_ok:s discount_ok:s bel_reconciled:s sensitivity_ok:s overall_validation_status:s",
            "SELECT * FROM v_sum"),
        # ---------------------------------------------------------- data-quality runner (M)
        "dq_not_null": Spec(_dq_build(("not_null",)), C_DQ, _dq_sql(("not_null",), p)),
        "dq_unique": Spec(_dq_build(("unique",)), C_DQ, _dq_sql(("unique",), p)),
        "dq_unique_combo": Spec(_dq_build(("unique_combination_of_columns",)), C_DQ,
                                _dq_sql(("unique_combination_of_columns",), p)),
        "dq_accepted_values": Spec(_dq_build(("accepted_values",)), C_DQ, _dq_sql(("accepted_values",), p)),
        "dq_accepted_range": Spec(_dq_build(("accepted_range",)), C_DQ, _dq_sql(("accepted_range",), p)),
        # ---------------------------------------------------------- reports (I)
        "report_base": Spec(
            lambda c: RP.report_base(c.v.mart_core, c.params),
            "cohort_id:s sex:s issue_age:i remaining_term_years:i version_id:s mort_version_id:s premium_pv:d0 "
            "benefit_pv:d0 expense_pv:d0 bel_amount:d0 policy_count:i bel_per_policy:d0",
            "SELECT cohort_id, sex, issue_age, remaining_term_years, version_id, mort_version_id, "
            "round(premium_pv, 0) AS premium_pv, round(benefit_pv, 0) AS benefit_pv, round(expense_pv, 0) AS expense_pv, "
            "round(bel_amount, 0) AS bel_amount, policy_count, round(bel_per_policy, 0) AS bel_per_policy "
            f"FROM core WHERE scenario_id = {base}"),
        "report_portfolio": Spec(
            lambda c: RP.report_portfolio(c.v.mart_portfolio),
            "scenario_id:s scenario_group:s version_id:s mort_version_id:s total_bel_m:d2 delta_bel_m:d2 delta_pct:d1",
            "SELECT scenario_id, coalesce(scenario_group, 'Base') AS scenario_group, version_id, mort_version_id, "
            "round(total_bel / 1000000, 2) AS total_bel_m, round(total_delta_bel / 1000000, 2) AS delta_bel_m, "
            "round(weighted_avg_delta_pct * 100, 1) AS delta_pct FROM port"),
        "report_validation": Spec(
            lambda c: RP.report_validation(c.v.mart_validation), "overall_validation_status:s count:i",
            "SELECT overall_validation_status, count(*) AS count FROM v_sum GROUP BY 1"),
        "report_sensitivity": Spec(
            lambda c: RP.report_sensitivity(c.v.mart_sensitivity),
            "cohort_id:s sex:s scenario_id:s version_id:s mort_version_id:s delta_m:d2 delta_pct:d1",
            "SELECT cohort_id, sex, scenario_id, version_id, mort_version_id, round(delta_bel / 1000000, 2) AS delta_m, "
            "round(delta_bel_pct * 100, 1) AS delta_pct FROM sens "
            f"WHERE scenario_id IN ({_in(O.SENSITIVITY_REPORT_SCENARIOS)})"),
        "report_decay": Spec(
            lambda c: RP.report_decay(c.v.inforce_rollforward, c.params),
            "cohort_id:s sex:s mort_version_id:s " + " ".join(f"{n}:d0" for _, n in RP.DECAY_MONTHS),
            f"SELECT cohort_id, sex, mort_version_id, {decay} FROM inf WHERE scenario_id = {base} GROUP BY ALL"),
        "survival_curve": Spec(
            lambda c: RP.survival_curve(c.v.inforce_rollforward, c.params),
            "cohort_id:s sex:s mort_version_id:s projection_month:i survival_pct:d7",
            "SELECT cohort_id, sex, mort_version_id, projection_month, inforce_open / policy_count * 100 AS survival_pct "
            f"FROM inf WHERE scenario_id = {base}"),
        "df_by_scenario": Spec(
            lambda c: RP.df_by_scenario_from_table(c.v.frame_wide, c.v.discount_factor_table, c.v.staged.mortality, c.v.staged.curve, c.params.broadcast_max_rows),
            "cohort_id:s sex:s scenario_id:s version_id:s projection_month:i discount_factor:d10",
            "SELECT DISTINCT cohort_id, sex, scenario_id, version_id, projection_month, discount_factor FROM disc "
            f"WHERE cashflow_type = 'death_benefit' AND scenario_id IN ({_in(O.DISCOUNT_CHART_SCENARIOS)})"),
        "bel_waterfall": Spec(
            lambda c: RP.bel_waterfall(c.v.bel_components, c.params),
            "model_point:s version_id:s mort_version_id:s premium_pv:d2 benefit_pv:d2 expense_pv:d2 bel_amount:d2 "
            "bel_per_policy:d4",
            "SELECT cohort_id || '-' || sex AS model_point, version_id, mort_version_id, premium_pv, benefit_pv, "
            f"expense_pv, bel_amount, bel_per_policy FROM bel WHERE scenario_id = {base}"),
        "delta_ranking": Spec(
            lambda c: RP.delta_ranking(c.v.mart_portfolio, c.params),
            "scenario_id:s scenario_group:s version_id:s mort_version_id:s total_delta_bel:d1 "
            "weighted_avg_delta_pct:d10",
            "SELECT scenario_id, scenario_group, version_id, mort_version_id, total_delta_bel, weighted_avg_delta_pct "
            f"FROM port WHERE scenario_id <> {base}"),
        "sensitivity_matrix": Spec(
            lambda c: RP.sensitivity_matrix(c.v.mart_sensitivity),
            "model_point:s version_id:s mort_version_id:s " + " ".join(f"{s}:d10" for s in RP.MATRIX_SCENARIOS),
            f"SELECT cohort_id || '-' || sex AS model_point, version_id, mort_version_id, {matrix} FROM sens GROUP BY ALL"),
        "curve_bel_impact": Spec(
            lambda c: CV.curve_bel_impact(c.v.mart_portfolio, c.params),
            "version_id:s mort_version_id:s total_bel:d1 ref_bel:d1 delta_vs_ref:d1 pct_vs_ref:d10 spread:d1 "
            "spread_pct:d10",
            "SELECT *, total_bel - ref_bel AS delta_vs_ref, "
            "CASE WHEN abs(ref_bel) = 0 THEN NULL ELSE (total_bel - ref_bel) / abs(ref_bel) END AS pct_vs_ref, "
            "mx - mn AS spread, CASE WHEN mx = 0 THEN NULL ELSE (mx - mn) / mx END AS spread_pct FROM ("
            "SELECT version_id, mort_version_id, total_bel, "
            f"max(CASE WHEN version_id = '{p.reference_curve_version}' THEN total_bel END) "
            "OVER (PARTITION BY mort_version_id) AS ref_bel, "
            "max(total_bel) OVER (PARTITION BY mort_version_id) AS mx, "
            f"min(total_bel) OVER (PARTITION BY mort_version_id) AS mn FROM port WHERE scenario_id = {base})"),
        "mortality_bel_impact": Spec(
            lambda c: CV.mortality_bel_impact(c.v.mart_portfolio, c.params),
            "version_id:s mort_version_id:s total_bel:d1 ref_mort_bel:d1 delta_vs_ref_mort:d1 pct_vs_ref_mort:d10 "
            "twin_version_id:s va_effect:d1",
            "SELECT a.*, a.total_bel - a.ref_mort_bel AS delta_vs_ref_mort, "
            "CASE WHEN abs(a.ref_mort_bel) = 0 THEN NULL ELSE (a.total_bel - a.ref_mort_bel) / abs(a.ref_mort_bel) END "
            "AS pct_vs_ref_mort, a.total_bel - t.total_bel AS va_effect FROM ("
            f"SELECT version_id, mort_version_id, total_bel, {va_case} AS twin_version_id, "
            f"max(CASE WHEN mort_version_id = '{p.reference_mort_version}' THEN total_bel END) "
            f"OVER (PARTITION BY version_id) AS ref_mort_bel FROM port WHERE scenario_id = {base}) a "
            f"LEFT JOIN port t ON t.scenario_id = {base} AND t.version_id = a.twin_version_id "
            "AND t.mort_version_id = a.mort_version_id"),
        # ---------------------------------------------------------- pricing (J)
        "pricing_survival": Spec(
            lambda c: PR.pricing_survival(c.policies, c.raw.mortality_assumption, c.raw.discount_curve, c.params),
            "sex:s issue_age:i term_years:i t:i age:i qx_annual:d10 annual_df:d10 survival:d10",
            "SELECT sex, issue_age, term_years, t, age, qx_annual, annual_df, survival FROM u_psurv"),
        "net_premium": Spec(
            lambda c: PR.price(c.v.staged.policy, c.raw.mortality_assumption, c.raw.discount_curve, c.params),
            C_MP + " annual_net_premium:d4", "SELECT cohort_id, sex, annual_net_premium FROM prem"),
        "gross_premium": Spec(
            lambda c: PR.price(c.v.staged.policy, c.raw.mortality_assumption, c.raw.discount_curve, c.params),
            C_MP + " annual_net_premium:d4 annual_gross_premium:d4",
            "SELECT cohort_id, sex, annual_net_premium, annual_gross_premium FROM prem"),
        "premium_table": Spec(
            lambda c: PR.premium_table(c.policies, c.raw.mortality_assumption, c.raw.discount_curve, c.params,
                                       id_cols=("policy_id", "cohort_id", "sex"), keys=FX.pricing_keys(FX.read_table(c.spark, c.sf_dir, "orders"))),
            "policy_id:i cohort_id:s sex:s annual_net_premium:d4 annual_gross_premium:d4 "
            "pricing_assumption_version:s premium_frequency:s premium_currency:s",
            "SELECT p.policy_id, p.cohort_id, p.sex, p.sum_assured * r.benefit_sum / r.annuity_sum AS annual_net_premium, "
            f"p.sum_assured * r.benefit_sum / r.annuity_sum / {O.GROSS_DIVISOR!r} AS annual_gross_premium, "
            f"'{p.pricing_version_id}' AS pricing_assumption_version, 'ANNUAL' AS premium_frequency, "
            "'EUR' AS premium_currency FROM pol p JOIN u_prates r USING (sex, issue_age, term_years)"),
        "pricing_long_terms": Spec(
            lambda c: _long_terms(c),
            "sex:s issue_age:i term_years:i policies:i years:i missing_mortality:i missing_discount:i priced:b "
            "benefit_sum:d8 annuity_sum:d8",
            LONG_TERMS_SQL),
        # ---------------------------------------------------------- data-derived views of F1, G3, G8, J1, A5
        "monthly_premium": Spec(
            lambda c: c.v.inforce_wide.filter(F.col("monthly_premium").isNotNull()).select(
                "cohort_id", "sex", "scenario_id", "mort_version_id", "projection_month", "inforce_open",
                "expected_deaths", "monthly_premium", "policy_count"),
            C_K3 + " mort_version_id:s projection_month:i inforce_open:d5 expected_deaths:d5 monthly_premium:d6 "
            "policy_count:i",
            "SELECT cohort_id, sex, scenario_id, mort_version_id, projection_month, inforce_open, expected_deaths, "
            "monthly_premium, policy_count FROM cfl"),
        "curve_bracket": Spec(
            _curve_bracket, "version_id:s discount_month:i lower_tenor:i upper_tenor:i lower_rate:d10 upper_rate:d10",
            "SELECT version_id, discount_month, lower_tenor, upper_tenor, lower_rate, upper_rate FROM s_dft "
            "WHERE discount_shift_bps = 0"),
        "monthly_rates": Spec(
            lambda c: _rates_read(c, False),
            "rate_type:s mort_version_id:s sex:s rate_key:i annual_rate:d10 monthly_rate:d10",
            RATES_SQL.format(m_extra="", l_extra="")),
        "stressed_rates": Spec(
            lambda c: _rates_read(c, True),
            "rate_type:s mort_version_id:s sex:s rate_key:i annual_rate:d10 monthly_rate:d10 multiplier:d10 "
            "stressed_rate:d10",
            RATES_SQL.format(m_extra=", mortality_multiplier AS multiplier, qx AS stressed_rate",
                             l_extra=", lapse_multiplier, scenario_lapse_monthly")),
        # ---------------------------------------------------------- curve analytics (K), G5, G8, J1 on the suppliers' curves
        "forward_rates": Spec(
            lambda c: CV.forward_rates(c.supplier_curves),
            "version_id:s tenor_month:i tenor_year:d10 forward_rate:d10",
            "SELECT * FROM (SELECT version_id, tenor_month, tenor_month / 12e0 AS tenor_year, "
            "pow(1e0 + zero_rate_annual, tenor_month / 12e0) / pow(1e0 + lag(zero_rate_annual) OVER w, "
            "lag(tenor_month / 12e0) OVER w) - 1e0 AS forward_rate FROM s_curve "
            "WINDOW w AS (PARTITION BY version_id ORDER BY tenor_month)) WHERE forward_rate IS NOT NULL"),
        "annual_discount_factors": Spec(
            lambda c: CV.annual_discount_factors(c.supplier_curves),
            "version_id:s tenor_month:i tenor_year:d10 zero_rate_annual:d10 discount_factor:d10",
            "SELECT version_id, tenor_month, tenor_month / 12e0 AS tenor_year, zero_rate_annual, "
            "1e0 / pow(1e0 + zero_rate_annual, tenor_month / 12e0) AS discount_factor FROM s_curve"),
        "ufr_check": Spec(
            lambda c: CV.ufr_check(c.supplier_curves), "version_id:s forward_rate:d10 ufr:d10 gap:d10",
            "SELECT a.version_id, pow(1e0 + b.zero_rate_annual, 60) / pow(1e0 + a.zero_rate_annual, 59) - 1e0 AS forward_rate, "
            "0.033e0 AS ufr, pow(1e0 + b.zero_rate_annual, 60) / pow(1e0 + a.zero_rate_annual, 59) - 1.033e0 AS gap "
            "FROM s_curve a JOIN s_curve b USING (version_id) WHERE a.tenor_month = 708 AND b.tenor_month = 720"),
        "va_effect": Spec(
            lambda c: CV.va_effects(c.supplier_curves, c.supplier_pairs),
            "first_version_id:s second_version_id:s tenor_month:i df_no_va:d10 df_with_va:d10 df_change_pct:d8",
            "SELECT *, (df_with_va / df_no_va - 1) * 100 AS df_change_pct FROM (SELECT first_version_id, second_version_id, "
            "a.tenor_month, pow(1e0 + a.zero_rate_annual, -20) AS df_no_va, pow(1e0 + b.zero_rate_annual, -20) AS df_with_va "
            "FROM s_pair JOIN s_curve a ON a.version_id = first_version_id AND a.tenor_month = 240 "
            "JOIN s_curve b ON b.version_id = second_version_id AND b.tenor_month = 240)"),
        "curve_divergence": Spec(
            lambda c: CV.curve_divergences(c.supplier_curves, c.supplier_pairs),
            "first_version_id:s second_version_id:s tenor_month:i spot_first:d10 spot_second:d10 spot_diff:d10",
            "SELECT *, spot_second - spot_first AS spot_diff FROM (SELECT 'S' || l_suppkey AS first_version_id, 'S' || l_suppkey || '-VA' AS second_version_id, "
            "CAST(12 * t AS BIGINT) AS tenor_month, 0.033e0 - (0.033e0 - start_rate) / (1e0 + t / 8e0) AS spot_first, "
            "0.033e0 - (0.033e0 - (start_rate + va)) / (1e0 + t / 8e0) AS spot_second "
            "FROM (SELECT *, unnest(generate_series(1, 20)) AS t FROM s_start))"),
        "curve_interpolation": Spec(
            lambda c: _supplier_discounts(c).select("version_id", "discount_shift_bps", "discount_month",
                                                    "lower_rate", "upper_rate", "interpolated_rate"),
            "version_id:s discount_shift_bps:i discount_month:i lower_rate:d10 upper_rate:d10 interpolated_rate:d10",
            "SELECT version_id, discount_shift_bps, discount_month, lower_rate, upper_rate, interpolated_rate FROM s_dft"),
        "discount_factor_table": Spec(
            _supplier_discounts,
            "version_id:s discount_shift_bps:i discount_month:i lower_tenor:i upper_tenor:i lower_rate:d10 "
            "upper_rate:d10 interpolated_rate:d10 discount_factor:d10",
            "SELECT version_id, discount_shift_bps, discount_month, lower_tenor, upper_tenor, lower_rate, upper_rate, "
            "interpolated_rate, discount_factor FROM s_dft"),
        "pricing_discount": Spec(
            lambda c: PR.annual_discounts(c.supplier_curves),
            "version_id:s tenor_year:i zero_rate_annual:d10 annual_df:d10",
            "SELECT version_id, tenor_month / 12 AS tenor_year, zero_rate_annual, pow(1e0 + zero_rate_annual, -tenor_month / 12) AS annual_df "
            "FROM s_curve"),
        "duplicate_keys": Spec(
            lambda c: AS.duplicate_keys(c.policies, CELL_KEYS),
            "cohort_id:s sex:s issue_age:i term_years:i elapsed_duration_years:i count:i",
            "SELECT cohort_id, sex, issue_age, term_years, elapsed_duration_years, count(*) AS count FROM pol "
            "GROUP BY ALL HAVING count(*) > 1"),
        "assumption_checks": Spec(lambda c: c.v.assumption_checks, "check:s failing:i", ASSUMPTION_CHECKS_SQL),
        # ---------------------------------------------------------- loaders with a reject channel
        "loaded_mortality": Spec(
            lambda c: c.loaded[0].loaded, "year:i age:i sex:s qx_annual:d10 source:s",
            "SELECT year, CAST(regexp_extract(trim(age), '^([0-9]+)', 1) AS BIGINT) AS age, sex, CAST(rate AS DOUBLE) AS qx_annual, 'AGENCY' AS source "
            "FROM r_mort WHERE reason IS NULL"),
        "rejected_mortality": Spec(
            lambda c: c.loaded[0].rejected, "record:s reason:s",
            "SELECT concat_ws('|', year, age, sex, rate) AS record, reason FROM r_mort WHERE reason IS NOT NULL"),
        "loaded_curves": Spec(
            lambda c: c.loaded[1].loaded, "tenor_month:i zero_rate_annual:d10 version_id:s",
            "SELECT 12 * CAST(tenor AS BIGINT) AS tenor_month, CAST(rate AS DOUBLE) AS zero_rate_annual, version_id FROM r_curve WHERE reason IS NULL"),
        "rejected_curves": Spec(
            lambda c: c.loaded[1].rejected, "record:s reason:s",
            "SELECT concat_ws('|', tenor, rate, version_id) AS record, reason FROM r_curve WHERE reason IS NOT NULL"),
        # ---------------------------------------------------------- experience study (X)
        "experience_exposure": Spec(
            lambda c: EX.exposure_table(c.histories, *STUDY_WINDOW), "sex:s attained_age:i duration_year:i days:i deaths:i",
            "SELECT sex, attained_age, duration_year, sum(days) AS days, sum(deaths) AS deaths FROM x_piece GROUP BY ALL", study=True),
        "experience_ae": Spec(
            lambda c: c.study[0], "sex:s attained_age:i days:i deaths:i expected:d6 ae_ratio:d7",
            "SELECT sex, age AS attained_age, days, deaths, expected, ae_ratio FROM x_ae", study=True),
        "experience_graduation": Spec(
            lambda c: c.study[1], "sex:s term:i coefficient:d7 age_from:i age_to:i",
            "SELECT sex, 0 AS term, c0 AS coefficient, age_from, age_to FROM x_fit UNION ALL SELECT sex, 1, c1, age_from, age_to FROM x_fit "
            "UNION ALL SELECT sex, 2, c2, age_from, age_to FROM x_fit", study=True),
        "experience_mortality": Spec(
            lambda c: c.study[2], "age:i sex:s qx_annual:d9 deaths:i credibility:d9 ratio:d7 version_id:s source:s",
            "SELECT age, sex, qx_annual, deaths, credibility, ratio, 'MX' AS version_id, 'EXPERIENCE' AS source FROM x_mort", study=True),
        "experience_portfolio": Spec(
            lambda c: c.study_valuation.mart_portfolio, C_PORT, "SELECT * FROM port", study=True),
        # ---------------------------------------------------------- seriatim unit-factor path
        "seriatim_factors": Spec(
            lambda c: c.fv.factors,
            "cell_id:s sex:s scenario_id:s version_id:s mort_version_id:s unit_premium:d8 premium_pv_unit:d8 "
            "benefit_pv_unit:d8 expense_pv_unit:d8",
            "SELECT * FROM u_fac"),
        "segment_bel": Spec(
            lambda c: c.fv.segment_bel(),
            C_K5 + " premium_pv:d0 benefit_pv:d0 expense_pv:d0 policy_count:i bel_amount:d0 bel_per_policy:d3",
            "SELECT * FROM segment_bel"),
        "policy_bel": Spec(
            lambda c: c.fv.policy_bel(),
            "policy_id:i cohort_id:s sex:s scenario_id:s version_id:s mort_version_id:s annual_gross_premium:d4 "
            "premium_pv:d2 benefit_pv:d2 expense_pv:d2 bel_amount:d2",
            "SELECT *, benefit_pv + expense_pv + premium_pv AS bel_amount FROM policy_bel"),
    }


_SHARED: dict[tuple, Ctx] = {}


def context(spark: SparkSession, sf_dir: str, params: ValuationParams | None = None, shared: bool = True) -> Ctx:
    """One context per (session, input folder, parameters): the staged inputs, size checks and
    materialized stage boundaries are built once and reused by every query of the session."""
    if not shared:
        return Ctx(spark, sf_dir, params)
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, params or ValuationParams())
    if key not in _SHARED:
        _SHARED[key] = Ctx(spark, sf_dir, params)
    return _SHARED[key]


def queries(params: ValuationParams | None = None, shared: bool = True, rounding: bool = True
            ) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for name, spec in specs(params).items():
        def run(spark: SparkSession, sf_dir: str, _spec: Spec = spec) -> DataFrame:
            return finalize(_spec.build(context(spark, sf_dir, params, shared)), _spec.columns, rounding)
        out[name] = run
    return out


def oracle_sql(params: ValuationParams | None = None) -> dict[str, str]:
    ctes = {False: O.all_ctes(params), True: O.all_ctes(params, study=True)}
    return {name: ctes[spec.study] + "\n" + finalize_sql(spec.sql, spec.columns)
            for name, spec in specs(params).items() if spec.sql is not None}
