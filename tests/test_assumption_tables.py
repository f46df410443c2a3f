"""Assumption tables derived from the driver's tables, and the row order of the reports."""

import pytest
from pyspark.sql import functions as F

from tontine.operators import curves as CV
from tontine.operators import reports as RP
from tontine.params import ValuationParams
from tontine.plans import oracle as O
from tontine.operators import quality as DQ
from tontine.sources import fixtures as FX
from tests.conftest import SF_SMALL

P = ValuationParams()


def _orders(spark, rows):
    return spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")


def test_model_points_grow_by_agency(spark):
    orders = _orders(spark, [(i, c, "F", 1.0) for i, c in enumerate([2, 1002, 1004, 7002])])
    customer = spark.createDataFrame([(c, "BUILDING") for c in (2, 1002, 1004, 7002)], "c_custkey long, c_mktsegment string")
    got = {(r.cohort_id, r.sex, r.policy_count) for r in FX.model_points(orders, customer).collect()}
    assert got == {("C2", "F", 1), ("C2-1", "F", 2), ("C2-7", "F", 1)}


def test_agency_tables_against_counts(spark):
    rows = [(1, 5, "F", 1.0), (9, 6, "O", 1.0), (2, 7, "P", 1.0), (3, 1500, "O", 1.0), (4, None, "F", 1.0), (5, 1501, None, 1.0)]
    a = FX.agency_assumptions(_orders(spark, rows))
    lapse = {(r.version_id, r.duration_year): r.lapse_rate_annual for r in a.lapse_assumption.collect()}
    assert lapse == {("L0", 2): 0.125, ("L0", 3): 0.0, ("L1", 4): 0.25, ("L1", 6): 0.0}
    assert {r.version_id: round(r.expense_rate, 12) for r in a.expense_assumption.collect()} == {"E0": round(0.03 + 1 / 300, 12), "E1": 0.03}
    assert a.mortality_assumption.count() == 2 * 2 * 111
    assert a.stress_scenario_definition.count() == 18
    assert a.assumption_version.filter("is_base_version").count() == 3
    empty = FX.agency_assumptions(_orders(spark, []))
    assert empty.mortality_assumption.isEmpty() and empty.stress_scenario_definition.isEmpty()


def test_supplier_curves_and_pairs(spark):
    lines = spark.createDataFrame([(1, 0.04, 0.02), (1, 0.06, 0.04), (2, None, None), (None, 0.1, 0.1)],
                                  "l_suppkey long, l_discount double, l_tax double")
    curves, pairs = FX.supplier_curves(lines), FX.supplier_pairs(lines)
    assert curves.groupBy("version_id").count().filter("count = 60").count() == 4
    term = lambda mean: (mean + 1 / 3) ** 0.5 / 500
    start = 0.01 + term(5)
    rate = lambda s, t: 0.033 - (0.033 - s) / (1 + t / 8)
    got = {(r.version_id, r.tenor_month): r.zero_rate_annual for r in curves.filter("version_id like 'S1%'").collect()}
    for t in (1, 20, 60):
        assert got["S1", 12 * t] == pytest.approx(rate(start, t), abs=1e-14)
        assert got["S1-VA", 12 * t] == pytest.approx(rate(start + term(3), t), abs=1e-14)
    one = pairs.filter("first_version_id = 'S1'")
    single = CV.va_effect(curves, "S1", "S1-VA").collect()
    assert [r.df_change_pct for r in CV.va_effects(curves, one).collect()] == [r.df_change_pct for r in single]
    a = {(r.tenor_month, r.spot_diff) for r in CV.curve_divergences(curves, one).collect()}
    assert a == {(r.tenor_month, r.spot_diff) for r in CV.curve_divergence(curves, "S1", "S1-VA").collect()} and len(a) == 20


def test_rules_of_the_library_and_of_the_oracle_are_the_same_many():
    assert sum(map(len, O.DQ_RULES.values())) == sum(map(len, DQ.pipeline_rules().values())) == 87


def _is_sorted(rows, key):
    keys = [key(r) for r in rows]
    return len(keys) > 1 and keys == sorted(keys)


def test_row_order_of_the_reports(spark, val_small):
    v = val_small
    core, sens, port, bel = (df.checkpoint() for df in (v.mart_core, v.mart_sensitivity, v.mart_portfolio, v.bel_components))
    assert _is_sorted(RP.report_base(core, P).collect(), lambda r: -r.bel_per_policy)
    full = {(r.scenario_id, r.version_id, r.mort_version_id): r.total_delta_bel for r in port.collect()}
    assert _is_sorted(RP.report_portfolio(port).collect(), lambda r: -full[r.scenario_id, r.version_id, r.mort_version_id])
    assert _is_sorted(RP.report_sensitivity(sens).collect(),
                      lambda r: (r.scenario_id, r.cohort_id, r.sex, r.version_id, r.mort_version_id))
    assert _is_sorted(RP.delta_ranking(port, P).collect(), lambda r: r.total_delta_bel)
    for by in ("bel_amount", "bel_per_policy"):
        rows = RP.bel_waterfall(bel, P, by).collect()
        assert _is_sorted(rows, lambda r: (r.version_id, r.mort_version_id, r[by]))
