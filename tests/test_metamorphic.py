"""Metamorphic and brute-force properties of the valuation."""

import math

import pytest
from pyspark.sql import functions as F

from tontine.functions.rates import monthly_from_annual
from tontine.params import ValuationParams
from tontine.plans.factor import FactorValuation
from tontine.plans.pipeline import Valuation
from tontine.sources import assumptions as A
from tontine.sources.fixtures import RawInputs, policies, read_table
from tontine.sources.schemas import RAW_SCHEMAS, conform
from tests.conftest import SF_SMALL

P = ValuationParams()
KEYS = ["cohort_id", "sex", "scenario_id", "version_id", "mort_version_id"]


def _bel(v):
    return {tuple(r[k] for k in KEYS): r for r in v.bel_components.collect()}


def test_bel_linear_in_policy_count(raw_small):
    doubled = raw_small.policy_cohort_input.withColumn("policy_count", F.col("policy_count") * 2)
    a = _bel(Valuation(raw_small, P, materialize="none"))
    b = _bel(Valuation(RawInputs(**{**raw_small.__dict__, "policy_cohort_input": doubled}), P, materialize="none"))
    assert a.keys() == b.keys()
    for k in a:
        assert b[k].bel_amount == pytest.approx(2 * a[k].bel_amount, rel=1e-9)
        assert b[k].bel_per_policy == pytest.approx(a[k].bel_per_policy, rel=1e-9)


def test_neutral_scenario_reproduces_base(spark, raw_small):
    rows = list(A.SCENARIO_ROWS) + [("NEUTRAL", "Test", 1.0, 1.0, 0, "Core", False, "no stress")]
    v = Valuation(RawInputs(**{**raw_small.__dict__, "stress_scenario_definition": A.scenario_table(spark, rows)}),
                  P, materialize="none")
    bel = v.bel_components.filter("scenario_id in ('BASE', 'NEUTRAL')").collect()
    by = {}
    for r in bel:
        by.setdefault((r.cohort_id, r.sex, r.version_id, r.mort_version_id), {})[r.scenario_id] = r.bel_amount
    assert by and all(x["BASE"] == pytest.approx(x["NEUTRAL"], rel=1e-12) for x in by.values())


def test_discount_factor_is_one_at_month_zero(val_small):
    t = val_small.discount_factor_table.filter("discount_month = 0").collect()
    assert t and all(r.discount_factor == 1.0 for r in t)


def test_window_equals_recursive_loop(val_small):
    rows = (val_small.inforce_wide.filter("cohort_id = 'C1' and sex = 'M' and scenario_id = 'MORT_UP' "
                                          "and mort_version_id = 'M2'").orderBy("projection_month").collect())
    n = rows[0].policy_count
    open_ = float(n)
    for r in rows:
        assert r.inforce_open == pytest.approx(open_, rel=1e-12)
        assert r.inforce_close == pytest.approx(open_ * (1 - r.scenario_qx_monthly) * (1 - r.scenario_lapse_monthly),
                                                rel=1e-12)
        open_ = r.inforce_close


def test_lapse_only_upper_bound(val_small):
    """In-force never exceeds the count decayed by lapses alone (mortality only removes more)."""
    rows = val_small.inforce_wide.filter("scenario_id = 'BASE'").select(
        "cohort_id", "sex", "mort_version_id", "projection_month", "inforce_open", "policy_count",
        "scenario_lapse_monthly").collect()
    series = {}
    for r in rows:
        series.setdefault((r.cohort_id, r.sex, r.mort_version_id), []).append(r)
    for rs in series.values():
        rs.sort(key=lambda r: r.projection_month)
        bound = float(rs[0].policy_count)
        for r in rs:
            assert r.inforce_open <= bound * (1 + 1e-12)
            bound *= 1 - r.scenario_lapse_monthly


def test_factor_path_equals_row_path(spark, raw_small):
    """Brute force on a small fixture: every policy as its own model point through the
    reference-shaped row path, against the unit-factor path."""
    pol = policies(read_table(spark, SF_SMALL, "orders"), read_table(spark, SF_SMALL, "customer"))
    sample = pol.orderBy("policy_id").limit(25).cache()
    fv = FactorValuation(sample, raw_small, P)
    fac = {(r.policy_id, r.scenario_id, r.version_id, r.mort_version_id): r for r in fv.policy_bel().collect()}
    mp = conform(sample.select(F.col("policy_id").cast("string").alias("cohort_id"), "sex", "issue_age", "term_years",
                               (F.col("issue_age") + F.col("term_years")).alias("maturity_age"), "sum_assured",
                               "policy_count", "elapsed_duration_years", F.lit("S").alias("version_id")),
                 RAW_SCHEMAS["policy_cohort_input"])
    row = Valuation(RawInputs(**{**raw_small.__dict__, "policy_cohort_input": mp}), P, materialize="none")
    rows = row.bel_components.collect()
    assert len(rows) == len(fac) == 25 * 9 * 4 * 2
    for r in rows:
        f = fac[(int(r.cohort_id), r.scenario_id, r.version_id, r.mort_version_id)]
        for c in ("premium_pv", "benefit_pv", "expense_pv", "bel_amount"):
            assert f[c] == pytest.approx(r[c], rel=1e-9, abs=1e-6)


def test_segment_bel_sums_policy_bel(spark, raw_small):
    pol = policies(read_table(spark, SF_SMALL, "orders"), read_table(spark, SF_SMALL, "customer"))
    fv = FactorValuation(pol, raw_small, P)
    seg = fv.segment_bel().filter("scenario_id = 'BASE' and version_id = 'A' and mort_version_id = 'M1'")
    tot = (fv.policy_bel().filter("scenario_id = 'BASE' and version_id = 'A' and mort_version_id = 'M1'")
           .groupBy("cohort_id", "sex").agg(F.sum("bel_amount").alias("s"), F.count(F.lit(1)).alias("n")))
    a = {(r.cohort_id, r.sex): (r.bel_amount, r.policy_count) for r in seg.collect()}
    b = {(r.cohort_id, r.sex): (r.s, r.n) for r in tot.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == pytest.approx(b[k][0], rel=1e-9)
        assert a[k][1] == b[k][1]


def test_monthly_rate_compounds_back_to_annual(spark):
    q = spark.range(1).select(monthly_from_annual(F.lit(0.2)).alias("m")).first().m
    assert 1 - (1 - q) ** 12 == pytest.approx(0.2, rel=1e-12)
    assert math.isclose(q, 1 - 0.8 ** (1 / 12))


def test_preaggregated_exposure_equals_policy_route(spark, raw_small):
    from tontine.sources.fixtures import policy_exposure
    o, c = read_table(spark, SF_SMALL, "orders"), read_table(spark, SF_SMALL, "customer")
    pol = policies(o, c)
    a = {tuple(r[k] for k in KEYS): r for r in FactorValuation(pol, raw_small, P).segment_bel().collect()}
    b = {tuple(r[k] for k in KEYS): r for r in
         FactorValuation(pol, raw_small, P, exposure=policy_exposure(o, c)).segment_bel().collect()}
    assert a.keys() == b.keys() and len(a) > 0
    for k in a:
        assert b[k].bel_amount == pytest.approx(a[k].bel_amount, rel=1e-9)
        assert b[k].policy_count == a[k].policy_count


def test_bel_from_inforce_equals_line_sums(val_small):
    from tontine.operators import valuation as VL
    lines = {tuple(r[k] for k in KEYS): r for r in VL.bel_wide(val_small.discounted_wide).collect()}
    direct = _bel(val_small)
    assert lines.keys() == direct.keys() and len(lines) == 10 * 9 * 4 * 2
    for k in lines:
        for c in ("premium_pv", "benefit_pv", "expense_pv", "bel_amount"):
            assert direct[k][c] == pytest.approx(lines[k][c], rel=1e-10)


@pytest.mark.parametrize("mode", ["none", "cache", "table"])
def test_materialization_modes_agree(raw_small, val_small, mode):
    ref = {(r.scenario_id, r.version_id, r.mort_version_id): r.total_bel for r in val_small.mart_portfolio.collect()}
    got = {(r.scenario_id, r.version_id, r.mort_version_id): r.total_bel
           for r in Valuation(raw_small, P, materialize=mode).mart_portfolio.collect()}
    assert got.keys() == ref.keys()
    for k in ref:
        assert got[k] == pytest.approx(ref[k], rel=1e-12)
