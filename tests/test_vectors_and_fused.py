"""The vector layout against the row path, the one-pass gate against the single checks, observed
assertions and proven keys against the plain runner."""

import pytest
from pyspark.sql import functions as F

from tontine.operators import checks as CK
from tontine.operators import projection as PJ
from tontine.operators import quality as DQ
from tontine.operators import vectors as VC
from tontine.params import ValuationParams
from tontine.plans.pipeline import Valuation
from tontine.sources.fixtures import RawInputs

P = ValuationParams()
K5 = ["cohort_id", "sex", "scenario_id", "version_id", "mort_version_id"]


def _raw(raw, **kw):
    return RawInputs(**({f: getattr(raw, f) for f in raw.__dataclass_fields__} | kw))


def _bel(df):
    return {tuple(r[k] for k in K5): r for r in df.collect()}


def _same_bel(v):
    rows, vectors = _bel(v.bel_by_rows), _bel(v.bel_wide)
    assert rows.keys() == vectors.keys() and rows
    for k, a in rows.items():
        b = vectors[k]
        assert (b.policy_count, b.issue_age, b.remaining_months, b.scenario_group) == (a.policy_count, a.issue_age, a.remaining_months, a.scenario_group)
        for c in ("premium_pv", "benefit_pv", "expense_pv", "bel_amount", "bel_per_policy"):
            assert (b[c] is None) if a[c] is None else b[c] == pytest.approx(a[c], rel=1e-10, abs=1e-7), (k, c)


def test_vectors_equal_rows(val_small):
    _same_bel(val_small)


def test_vectors_equal_rows_on_holes(spark, raw_small):
    """Missing ages and durations, certain death, a curve shorter than the terms, matured contracts,
    a cohort without a premium, a zero count."""
    mort = raw_small.mortality_assumption.filter("not (age in (52, 66) and version_id = 'M2')").withColumn(
        "qx_annual", F.when((F.col("age") == 58) & (F.col("sex") == "M"), 1.0).otherwise(F.col("qx_annual")))
    mp = raw_small.policy_cohort_input.withColumn("elapsed_duration_years", F.when(F.col("cohort_id") == "C4", F.col("term_years")).otherwise(F.col("elapsed_duration_years")))
    mp = mp.withColumn("policy_count", F.when(F.col("cohort_id") == "C5", 0).otherwise(F.col("policy_count")))
    base = Valuation(raw_small, P, materialize="none").premium_input.filter("not (cohort_id = 'C2' and sex = 'F')").withColumn(
        "pricing_assumption_version", F.lit("PRICING_V1"))
    raw = _raw(raw_small, mortality_assumption=mort, policy_cohort_input=mp, lapse_assumption=raw_small.lapse_assumption.filter("duration_year not in (7, 30)"),
               discount_curve=raw_small.discount_curve.filter("tenor_month <= 120 or version_id = 'A'").filter("tenor_month <= 180"), premium_input=base)
    _same_bel(Valuation(raw, P, materialize="none"))


def test_vectors_hold_the_months_of_the_rows(val_small):
    rows = {}
    for r in val_small.inforce_wide.filter("cohort_id = 'C3' and mort_version_id = 'M1'").select("sex", "scenario_id", "projection_month", "inforce_open", "expected_deaths").collect():
        rows.setdefault((r.sex, r.scenario_id), {})[r.projection_month] = (r.inforce_open, r.expected_deaths)
    for c in VC.month_vectors(val_small.chain_years.filter("cohort_id = 'C3' and mort_version_id = 'M1'")).collect():
        want = rows[c.sex, c.scenario_id]
        assert len(c.open) == len(c.deaths) == len(want) == c.remaining_months
        for m, (o, d) in want.items():
            assert (c.open[m - 1], c.deaths[m - 1]) == pytest.approx((o, d), rel=1e-12)


def test_discount_years_equal_the_factor_table(val_small):
    st = val_small.staged
    table = {(r.version_id, r.discount_shift_bps, r.discount_month): r.discount_factor for r in val_small.discount_factor_table.collect()}
    years = VC.discount_years(st.curve, st.scenario).collect()
    assert len(years) == 4 * 3 * 151
    for r in years:
        for k in range(13):
            want = table.get((r.version_id, r.discount_shift_bps, (r.projection_year - 1) * 12 + k))
            assert r.d[k] == (pytest.approx(want, rel=1e-14) if want is not None else None)


def test_premium_vectors_equal_the_rate_table(spark, raw_small):
    from tontine.operators import pricing as PR
    pol = spark.createDataFrame([(i, s, a, t, 1000 * i) for i, (s, a, t) in enumerate(
        [("F", 35, 30), ("M", 60, 45), ("M", 60, 60), ("F", 40, 0), ("X", 40, 10), ("F", 105, 10), (None, 40, 5), ("M", 0, 1)])], "cohort_id long, sex string, issue_age int, term_years int, sum_assured long")
    short = raw_small.discount_curve.filter("not (version_id = 'A' and tenor_month = 600)")
    for curve in (raw_small.discount_curve, short):
        a = {r.cohort_id: r for r in PR.price(pol, raw_small.mortality_assumption, curve, P).collect()}
        b = {r.cohort_id: r for r in VC.premium_vectors(pol, raw_small.mortality_assumption, curve, P).collect()}
        assert a.keys() == b.keys()
        for i, r in a.items():
            for c in ("annual_net_premium", "annual_gross_premium"):
                assert b[i][c] == (None if r[c] is None else pytest.approx(r[c], rel=1e-12)), (i, c)


def test_vector_chains_are_not_shuffled(raw_small):
    v = Valuation(raw_small, P, materialize="none")
    plan = v.chain_years._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_a_repeated_mortality_key_stops_the_vectors(raw_small):
    extra = raw_small.mortality_assumption.filter("age = 60 and sex = 'F' and version_id = 'M1'")
    v = Valuation(_raw(raw_small, mortality_assumption=raw_small.mortality_assumption.unionByName(extra)), P, materialize="none")
    with pytest.raises(Exception, match="[Dd]uplicate"):
        v.chain_years.collect()


def _verdicts(df, columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


def test_one_pass_gate_equals_the_single_checks(val_small):
    v = val_small
    single = {"val_projection_continuity": v.val_projection, "val_inforce_reconciliation": v.val_inforce, "val_cashflow_sign_and_timing": v.val_cashflow,
              "val_discounting_sanity": v.val_discount, "val_bel_reconciliation": v.val_bel, "val_sensitivity_direction": v.val_direction,
              "val_validation_summary": v.validation_by_checks}
    for name, fused in v.gate.items():
        assert _verdicts(fused, fused.columns) == _verdicts(single[name].select(*fused.columns), fused.columns), name


def _gate(v, rows, bel=None):
    from tontine.operators import cashflow as CF
    from tontine.operators.discounting import pivot_versions
    st = v.staged
    sums = CK.gate_sums(rows, v.discount_years, CF.expense_rate(st.expense, P), pivot_versions(st.curve, P), P)
    return CK.gate_tables(v.frame_wide, sums, v.bel_components if bel is None else bel, P)


@pytest.mark.parametrize("column, change, failing", [
    ("inforce_close", 1.0, "inforce_ok"), ("monthly_premium", -1e6, "cashflow_ok"), ("expected_deaths", -1e4, "cashflow_ok"), ("inforce_open", 5.0, "bel_reconciled")])
def test_one_pass_gate_sees_a_corrupted_row(val_small, column, change, failing):
    v = val_small
    hit = (F.col("cohort_id") == "C1") & (F.col("sex") == "M") & (F.col("scenario_id") == "BASE") & (F.col("mort_version_id") == "M2") & (F.col("projection_month") == 7)
    bad = _gate(v, v.inforce_wide.withColumn(column, F.when(hit, F.col(column) + change).otherwise(F.col(column))))
    found = bad["val_validation_summary"].filter(f"{failing} = 'FAIL'").collect()
    assert {(r.cohort_id, r.sex, r.scenario_id, r.mort_version_id) for r in found} == {("C1", "M", "BASE", "M2")}
    assert {r.overall_validation_status for r in found} == {"FAIL"}
    lost = _gate(v, v.inforce_wide.filter(~hit))["val_validation_summary"].filter("projection_ok = 'FAIL'")
    assert {(r.cohort_id, r.sex, r.scenario_id) for r in lost.collect()} == {("C1", "M", "BASE")}


def test_one_pass_gate_fails_what_is_missing(val_small):
    v = val_small
    gone = _gate(v, v.inforce_wide.filter("not (cohort_id = 'C2' and scenario_id = 'RATE_UP')"))["val_validation_summary"]
    bad = {(r.cohort_id, r.scenario_id) for r in gone.filter("overall_validation_status = 'FAIL'").collect()}
    assert bad == {("C2", "RATE_UP")}
    no_bel = _gate(v, v.inforce_wide, v.bel_components.filter("version_id <> 'B'"))["val_validation_summary"]
    assert {r.version_id for r in no_bel.filter("overall_validation_status = 'FAIL'").collect()} == {"B"}


def test_many_curves_fall_back_to_the_single_checks(raw_small):
    v = Valuation(raw_small, ValuationParams(max_pivot_versions=2), materialize="none")
    assert v.gate is None


RULES = DQ.pipeline_rules()


def _found(rows):
    return {(r.table_name, r.rule, r.columns): r.failing_rows for r in rows.collect()}


def test_observed_assertions_equal_the_plain_runner(spark, val_small):
    assert _found(val_small.assertions(RULES)) == _found(DQ.run_rules(val_small.tables(), RULES))


def test_observed_assertions_count_planted_defects(spark, raw_small):
    mort = raw_small.mortality_assumption.withColumn("qx_annual", F.when(F.col("age") == 60, F.lit(None)).otherwise(F.col("qx_annual")))
    mp = raw_small.policy_cohort_input.withColumn("sex", F.when((F.col("cohort_id") == "C3") & (F.col("sex") == "F"), F.lit(None)).otherwise(F.col("sex")))
    v = Valuation(_raw(raw_small, mortality_assumption=mort, policy_cohort_input=mp), P)
    plain = DQ.run_rules(v.tables(), RULES, DQ.ROW_RULES)
    got = {x[:3]: x[3] for x in v.row_assertions(RULES)}
    assert got == _found(plain) and got["int_projection_mortality_rates", "not_null", "base_qx_annual"] > 0
    assert got["stg_policy_cohort_input", "not_null", "sex"] == 1


def test_observed_assertions_on_an_empty_book(raw_small):
    v = Valuation(_raw(raw_small, policy_cohort_input=raw_small.policy_cohort_input.limit(0)), P, materialize="none")
    assert all(n == 0 for *_, n in v.row_assertions(RULES))


def test_unique_keys_are_proven_or_counted(spark, raw_small, val_small):
    """Clean inputs: the large models are not grouped. A repeated model point or mortality row: counted."""
    big = [t for t in RULES if t in DQ.PROVEN_BY]
    tables = val_small.tables()
    asked = []

    class Spy(dict):
        def __getitem__(self, name):
            asked.append(name)
            return super().__getitem__(name)

    assert all(n == 0 for *_, n in DQ.unique_results(Spy(tables), RULES)) and not set(asked) & set(big)
    two = raw_small.policy_cohort_input.unionByName(raw_small.policy_cohort_input.filter("cohort_id = 'C1' and sex = 'F'"))
    v = Valuation(_raw(raw_small, policy_cohort_input=two), P, materialize="none")
    t = {k: x for k, x in v.tables().items() if k in ("stg_policy_cohort_input", "stg_stress_scenario_definition", "stg_premium_input", "int_projection_frame")}
    rules = {k: RULES[k] for k in t}
    got = {(a, b, c): n for a, b, c, n in DQ.unique_results(t, rules)}
    assert got == _found(DQ.run_rules(t, rules, DQ.UNIQUE_RULES)) and got["int_projection_frame", "unique_combination_of_columns", "cohort_id,sex,scenario_id,projection_month"] > 0
