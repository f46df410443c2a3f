"""Curve analytics (K1-K5) and pricing (J1-J5) against plain-Python brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tontine.operators import curves as CV
from tontine.operators import pricing as PR
from tontine.params import ValuationParams

P = ValuationParams()


def _curve(raw, v):
    rows = raw.discount_curve.filter(F.col("version_id") == v).orderBy("tenor_month").collect()
    return np.array([r.tenor_month / 12 for r in rows]), np.array([r.zero_rate_annual for r in rows])


def test_forward_rates_and_dfs(raw_small):
    t, s = _curve(raw_small, "A")
    fwd = {r.tenor_month: r.forward_rate for r in CV.forward_rates(raw_small.discount_curve)
           .filter("version_id = 'A'").collect()}
    for i in range(len(t) - 1):
        exp = (1 + s[i + 1]) ** t[i + 1] / (1 + s[i]) ** t[i] - 1
        assert fwd[int(t[i + 1] * 12)] == pytest.approx(exp, rel=1e-12)
    dfs = {r.tenor_month: r.discount_factor for r in CV.annual_discount_factors(raw_small.discount_curve)
           .filter("version_id = 'A'").collect()}
    for ti, si in zip(t, s):
        assert dfs[int(ti * 12)] == pytest.approx(1 / (1 + si) ** ti, rel=1e-12)


def test_ufr_va_divergence(raw_small):
    c = raw_small.discount_curve
    t, s = _curve(raw_small, "B")
    u = CV.ufr_check(c).filter("version_id = 'B'").first()
    assert u.forward_rate == pytest.approx((1 + s[59]) ** 60 / (1 + s[58]) ** 59 - 1, rel=1e-12)
    assert u.gap == pytest.approx(u.forward_rate - 0.033)
    ta, sa = _curve(raw_small, "A")
    va = CV.va_effect(c, "A", "B").first()
    d0, d1 = 1 / (1 + sa[19]) ** 20, 1 / (1 + s[19]) ** 20
    assert va.df_change_pct == pytest.approx((d1 - d0) / d0 * 100, rel=1e-12)
    div = CV.curve_divergence(c, "A", "C").collect()
    assert len(div) == 20


def _brute_net_rate(q, v, age, term):
    """The reference's per-model-point loop, for one (sex, issue_age, term)."""
    qs = np.array([q[age + k] for k in range(term)])
    p, surv = 1.0, []
    for x in qs:
        surv.append(p)
        p *= 1 - x
    vs = np.array([v[k] for k in range(1, term + 1)])
    return (vs * np.array(surv) * qs).sum() / (vs * np.array(surv)).sum()


def test_pricing_matches_loop(spark, raw_small):
    m = raw_small.mortality_assumption.filter("version_id = 'M1'").collect()
    q = {"F": {}, "M": {}}
    for r in m:
        q[r.sex][r.age] = r.qx_annual
    v = {r.tenor_year: r.annual_df for r in PR.pricing_discount(raw_small.discount_curve, P).collect()}
    keys = spark.createDataFrame([("C", "F", 35, 30, 100000), ("D", "M", 60, 10, 50000), ("E", "M", 45, 20, 1)],
                                 "cohort_id string, sex string, issue_age int, term_years int, sum_assured long")
    got = {r.cohort_id: r for r in PR.price(keys, raw_small.mortality_assumption, raw_small.discount_curve, P).collect()}
    for cid, sex, age, term, sa in [("C", "F", 35, 30, 100000), ("D", "M", 60, 10, 50000), ("E", "M", 45, 20, 1)]:
        net = sa * _brute_net_rate(q[sex], v, age, term)
        assert got[cid].annual_net_premium == pytest.approx(net, rel=1e-12)
        assert got[cid].annual_gross_premium == pytest.approx(net / (1 - (0.03 + 0.02 + 0.02)), rel=1e-12)


def test_curve_and_mortality_bel_impact(val_small):
    rows = CV.curve_bel_impact(val_small.mart_portfolio, P).collect()
    for mort in ("M1", "M2"):
        sub = [r for r in rows if r.mort_version_id == mort]
        totals = [r.total_bel for r in sub]
        ref = [r.total_bel for r in sub if r.version_id == "A"][0]
        for r in sub:
            assert r.delta_vs_ref == pytest.approx(r.total_bel - ref)
            assert r.spread == pytest.approx(max(totals) - min(totals))
    m = {(r.version_id, r.mort_version_id): r for r in CV.mortality_bel_impact(val_small.mart_portfolio, P).collect()}
    assert m[("B", "M1")].va_effect == pytest.approx(m[("B", "M1")].total_bel - m[("A", "M1")].total_bel)
    assert m[("A", "M2")].delta_vs_ref_mort > 0          # heavier mortality basis, higher BEL


def test_long_terms_are_priced_in_full_and_unpriceable_policies_are_kept(spark, raw_small):
    m, c = raw_small.mortality_assumption, raw_small.discount_curve
    book = spark.createDataFrame([("long", "M", 30, 60, 1e5), ("past", "M", 90, 30, 1e5), ("none", "F", 120, 5, 1e5), ("zero", "F", 40, 0, 1e5)],
                                 "cohort_id string, sex string, issue_age int, term_years int, sum_assured double")
    got = {r.cohort_id: r.annual_net_premium for r in PR.price(book, m, c, P).collect()}
    q = {r.age: r.qx_annual for r in m.filter("version_id = 'M1' and sex = 'M'").collect()}
    v = {r.tenor_year: r.annual_df for r in PR.pricing_discount(c, P).collect()}
    assert got["long"] == pytest.approx(1e5 * _brute_net_rate(q, v, 30, 60), rel=1e-9)
    assert [got[k] for k in ("past", "none", "zero")] == [None] * 3
    cover = {(r.issue_age, r.term_years): r for r in PR.pricing_coverage(book, m, c, P).collect()}
    assert cover[30, 60].priced and sum(r.policies for r in cover.values()) == 4
    assert (cover[90, 30].missing_mortality, cover[120, 5].missing_mortality, cover[40, 0].years) == (9, 5, 0)
    assert not any(cover[k].priced for k in ((90, 30), (120, 5), (40, 0)))
