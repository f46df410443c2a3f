"""One test per semantic trap of the reference."""

import pytest
from pyspark.sql import functions as F

from tontine.functions.rates import monthly_from_annual
from tontine.operators import checks as CK
from tontine.operators import projection as PJ
from tontine.operators import staging as ST
from tontine.operators.discounting import discount_factor_table
from tontine.params import ValuationParams
from tontine.plans.pipeline import Valuation
from tontine.sources import assumptions as A
from tontine.sources.fixtures import RawInputs
from tontine.sources.schemas import RAW_SCHEMAS

P = ValuationParams()


def _mp(spark, rows):
    cols = ["cohort_id", "sex", "issue_age", "term_years", "maturity_age", "sum_assured", "policy_count",
            "elapsed_duration_years", "version_id"]
    return spark.createDataFrame([dict(zip(cols, r)) for r in rows], RAW_SCHEMAS["policy_cohort_input"])


def _raw(raw_small, **over):
    return RawInputs(**{**raw_small.__dict__, **over})


def test_t1_exact_monthly_exponent(spark):
    row = spark.range(1).select(monthly_from_annual(F.lit(0.01)).alias("m"),
                                monthly_from_annual(F.lit(0.01), 0.083333).alias("t")).first()
    assert row.m == pytest.approx(1 - 0.99 ** (1 / 12), rel=1e-15)
    assert abs(row.m - row.t) > 1e-12          # the DECIMAL literal would truncate the exponent


def test_t2_zero_survival_stays_zero(spark):
    rated = spark.createDataFrame(
        [("X", "M", "BASE", "M1", m, 1.0, q, 0.0) for m, q in [(1, 0.5), (2, 1.0), (3, 0.5), (4, 0.5)]],
        "cohort_id string, sex string, scenario_id string, mort_version_id string, projection_month int, "
        "policy_count double, scenario_qx_monthly double, scenario_lapse_monthly double")
    got = {r.projection_month: r.inforce_open for r in PJ.rollforward(rated).collect()}
    assert got == {1: 1.0, 2: 0.5, 3: 0.0, 4: 0.0}


def test_t3_matured_policies_make_no_months(spark, raw_small):
    mp = _mp(spark, [("OLD", "M", 40, 10, 50, 1000, 5, 10, "v"), ("NEG", "F", 40, 10, 50, 1000, 5, 11, "v"),
                     ("OK", "M", 40, 10, 50, 1000, 5, 9, "v")])
    v = Valuation(_raw(raw_small, policy_cohort_input=mp), P, materialize="none")
    cohorts = {r.cohort_id for r in v.projection_frame.select("cohort_id").distinct().collect()}
    assert cohorts == {"OK"}
    assert v.projection_frame.count() == 12 * 9


def test_t4_missing_lapse_duration_reads_zero_and_is_flagged(spark, raw_small):
    lapse = A.lapse_curve(spark, max_duration=5)
    mp = _mp(spark, [("A", "M", 40, 10, 50, 1000, 5, 4, "v")])
    v = Valuation(_raw(raw_small, policy_cohort_input=mp, lapse_assumption=lapse), P, materialize="none")
    late = v.lapse_rates.filter("duration_year > 5 and scenario_id = 'BASE'")
    assert late.count() > 0
    assert late.filter("scenario_lapse_monthly <> 0").count() == 0
    assert late.filter("base_lapse_annual is not null").count() == 0
    chk = {r.check: r.failing for r in v.assumption_checks.collect()}
    assert chk["lapse_duration_missing"] > 0


def test_t5_missing_mortality_age_is_flagged(spark, raw_small):
    mort = raw_small.mortality_assumption.filter("age <> 42")
    mp = _mp(spark, [("A", "M", 40, 10, 50, 1000, 5, 1, "v")])
    v = Valuation(_raw(raw_small, policy_cohort_input=mp, mortality_assumption=mort), P, materialize="none")
    chk = {r.check: r.failing for r in v.assumption_checks.collect()}
    assert chk["mortality_rows_dropped"] == 12 * 9 * 2   # one year of months, 9 scenarios, 2 bases


def test_t6_missing_check_row_fails_when_strict(spark):
    k3 = "cohort_id string, sex string, scenario_id string"
    k5 = k3 + ", version_id string, mort_version_id string"
    proj = spark.createDataFrame([("A", "M", "MORT_UP", "PASS")], k3 + ", projection_ok string")
    disc = spark.createDataFrame([("A", "M", "MORT_UP", "V", "M1", "PASS")], k5 + ", discount_ok string")
    inf = spark.createDataFrame([], k3 + ", mort_version_id string, inforce_ok string")   # missing row
    cf = spark.createDataFrame([("A", "M", "MORT_UP", "M1", "PASS")], k3 + ", mort_version_id string, cashflow_ok string")
    bel = spark.createDataFrame([("A", "M", "MORT_UP", "V", "M1", "PASS")], k5 + ", bel_reconciled string")
    sens = spark.createDataFrame([("A", "M", "MORT_UP", "V", "M1", "PASS")], k5 + ", sensitivity_ok string")
    strict = CK.validation_summary(proj, inf, cf, disc, bel, sens, P).first()
    lenient = CK.validation_summary(proj, inf, cf, disc, bel, sens,
                                    ValuationParams(strict_missing_checks=False)).first()
    assert strict.overall_validation_status == "FAIL"
    assert lenient.overall_validation_status == "PASS"


def test_t7_t8_curve_hole(spark, raw_small):
    curve = raw_small.discount_curve.filter("not (version_id = 'A' and tenor_month = 24)")
    scen = ST.stg_scenario(raw_small.stress_scenario_definition)
    t = discount_factor_table(curve, scen, P).filter("version_id = 'A' and discount_shift_bps = 0")
    df = {r.discount_month: r.discount_factor for r in t.collect()}
    assert all(df[m] is None for m in range(13, 25))      # T8: no upper tenor -> NULL
    assert df[30] is not None                             # T7: lower tenor missing reads as 0 %
    v = Valuation(_raw(raw_small, discount_curve=curve), P, materialize="none")
    assert {r.check: r.failing for r in v.assumption_checks.collect()}["curve_grid_hole"] == 1


def test_t15_zero_policy_count_gives_null_per_policy(spark, raw_small):
    mp = _mp(spark, [("Z", "M", 40, 10, 50, 1000, 0, 5, "v")])
    v = Valuation(_raw(raw_small, policy_cohort_input=mp), P, materialize="none")
    rows = v.bel_components.collect()
    assert rows and all(r.bel_per_policy is None and r.bel_amount == 0.0 for r in rows)


def test_t16_two_maintenance_rows_flagged(spark, raw_small):
    two = A.expense_table(spark, list(A.EXPENSE_ROWS) * 2)
    v = Valuation(_raw(raw_small, expense_assumption=two), P, materialize="none")
    assert {r.check: r.failing for r in v.assumption_checks.collect()}["maintenance_rows_not_one"] == 1


def test_t17_duplicate_curve_key_flagged(spark, raw_small):
    dup = raw_small.discount_curve.unionByName(raw_small.discount_curve.filter("tenor_month = 12"))
    v = Valuation(_raw(raw_small, discount_curve=dup), P, materialize="none")
    assert {r.check: r.failing for r in v.assumption_checks.collect()}["curve_key_duplicate"] == 4


def test_b9_base_version_resolution(spark, raw_small):
    av = raw_small.assumption_version
    none = av.filter("assumption_type <> 'lapse'")
    assert ST.stg_lapse(raw_small.lapse_assumption, none).count() == 0        # 0 base rows -> empty
    two = av.unionByName(av.filter("assumption_type = 'lapse'"))
    counts = {r.assumption_type: r.n_base for r in ST.base_version_counts(two).collect()}
    assert counts["lapse"] == 2
    with pytest.raises(Exception):
        ST.stg_lapse(raw_small.lapse_assumption, two).count()             # >1 base rows -> error


def test_t2_year_grain_rollforward_equals_monthly(spark):
    yearly = [(y, q, l) for y, q, l in [(1, 0.01, 0.05), (2, 1.0, 0.02), (3, 0.02, 0.03)]]
    months = [(12 * (y - 1) + k, q, l, y) for y, q, l in yearly for k in range(1, 13)]
    cols = ("cohort_id string, sex string, scenario_id string, mort_version_id string, projection_month int, "
            "policy_count double, scenario_qx_monthly double, scenario_lapse_monthly double")
    monthly = PJ.rollforward(spark.createDataFrame([("X", "M", "B", "M1", m, 7.0, q, l) for m, q, l, _ in months], cols))
    ycols = cols.replace("projection_month int", "projection_year int")
    by_year = PJ.rollforward_years(spark.createDataFrame([("X", "M", "B", "M1", y, 7.0, q, l) for y, q, l in yearly],
                                                         ycols), ["cohort_id", "sex", "scenario_id", "mort_version_id"])
    a = {r.projection_month: r.inforce_open for r in monthly.collect()}
    b = {r.projection_month: r.inforce_open for r in by_year.collect()}
    assert a.keys() == b.keys() and len(a) == 36
    for m in a:
        assert b[m] == pytest.approx(a[m], rel=1e-12, abs=1e-15)
    assert all(b[m] == 0.0 for m in range(14, 37))        # after the month with q = 1 nothing is in force


def test_b5_b7_defaults_for_missing_values(spark, raw_small):
    from tontine.sources.schemas import literal_table
    prem = literal_table(spark, [("C1", "M", 100.0, 107.5, "PRICING_V1", None, None)], RAW_SCHEMAS["premium_input"])
    r = ST.stg_premium(prem, raw_small.assumption_version).first()
    assert (r.premium_frequency, r.premium_currency) == ("ANNUAL", "EUR")
    scen = literal_table(spark, [("X", "T", None, None, None, "Core", False, "d")],
                         RAW_SCHEMAS["stress_scenario_definition"])
    s = ST.stg_scenario(scen).first()
    assert (s.mortality_multiplier, s.lapse_multiplier, s.discount_shift_bps) == (1.0, 1.0, 0)
