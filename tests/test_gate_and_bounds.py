"""The gate on the chain of the published BEL, and inputs beyond the sizes of the fixture."""

import pytest
from pyspark.sql import functions as F

from tontine.operators import checks as CK
from tontine.operators import discounting as DS
from tontine.operators.joins import fan_out
from tontine.params import ValuationParams
from tontine.plans.pipeline import Valuation
from tontine.sources.fixtures import RawInputs, model_points, read_table
from tests.conftest import SF_SMALL

P = ValuationParams()
K5 = ["cohort_id", "sex", "scenario_id", "version_id", "mort_version_id"]


def _raw(raw, **kw):
    return RawInputs(**({f: getattr(raw, f) for f in raw.__dataclass_fields__} | kw))


def test_a_repeated_curve_key_stops_the_bel(spark, raw_small):
    extra = raw_small.discount_curve.filter("tenor_month = 24 and version_id = 'A'")
    v = Valuation(_raw(raw_small, discount_curve=raw_small.discount_curve.unionByName(extra)), P, materialize="none")
    with pytest.raises(Exception, match="discount curve A has several rows for tenor 24"):
        v.bel_components.collect()


def test_a_corrupted_inforce_row_fails_the_gate(spark, val_small):
    v = val_small
    hit = (F.col("cohort_id") == "C1") & (F.col("sex") == "M") & (F.col("scenario_id") == "BASE") & (F.col("mort_version_id") == "M2")
    lost = v.inforce_wide.filter(~(hit & (F.col("projection_month") == 7)))
    bad = {(r.cohort_id, r.sex, r.scenario_id) for r in CK.val_projection(v.frame_wide, lost).collect() if r.projection_ok == "FAIL"}
    assert bad == {("C1", "M", "BASE")}
    none = {(r.cohort_id, r.sex, r.scenario_id) for r in CK.val_projection(v.frame_wide, v.inforce_wide.filter(~hit)).collect()
            if r.projection_ok == "FAIL"}
    assert none == {("C1", "M", "BASE")}
    assert v.val_projection.filter("projection_ok <> 'PASS'").isEmpty()


def test_a_bel_that_its_lines_do_not_sum_to_fails(spark, val_small):
    v = val_small
    hit = (F.col("cohort_id") == "C2") & (F.col("version_id") == "B") & (F.col("scenario_id") == "BASE")
    lines = v.discounted_wide.withColumn("discounted_cashflow", F.when(
        hit & (F.col("projection_month") == 3), F.col("discounted_cashflow") * 2).otherwise(F.col("discounted_cashflow")))
    got = CK.val_bel(v.bel_components, P, lines).filter("bel_reconciled = 'FAIL'").select("cohort_id", "version_id", "scenario_id").distinct().collect()
    assert [tuple(r) for r in got] == [("C2", "B", "BASE")]
    gone = CK.val_bel(v.bel_components, P, v.discounted_wide.filter(~hit)).filter("bel_reconciled = 'FAIL'")
    assert gone.select("cohort_id", "version_id", "scenario_id").distinct().count() == 1
    assert v.val_bel.filter("bel_reconciled <> 'PASS'").isEmpty()


def test_more_scenarios_than_the_bound_fan_out_over_a_join(spark):
    rows = spark.range(7).withColumn("x", F.when(F.col("id") > 3, F.lit("a")))
    dim = spark.range(10_001).select(F.col("id").alias("scenario_id"))
    got = fan_out(rows, dim, P.dimension_max_rows)
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()
    assert got.columns == ["id", "x", "scenario_id"]
    assert got.count() == 70_007 and got.distinct().count() == 70_007


def test_five_hundred_curve_versions(spark, raw_small, val_small):
    """Far more curves than are pivoted: copies of the four curves give the BEL of the four."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(124)))
    curve = (raw_small.discount_curve.withColumn("i", copies)
             .withColumn("version_id", F.concat("version_id", F.when(F.col("i") > 0, F.col("i").cast("string")).otherwise(F.lit("")))).drop("i"))
    st = val_small.staged
    inf = val_small.inforce_wide.filter("cohort_id = 'C4' and scenario_id in ('BASE', 'RATE_UP')")
    keys = ["sex", "scenario_id", "mort_version_id"]
    few = {(r.sex, r.scenario_id, r.mort_version_id, r.version_id): r for r in DS.pv_sums(inf, st.curve, st.scenario, P, keys).collect()}
    many = DS.pv_sums(inf, curve, st.scenario, P, keys).collect()
    assert len(many) == 125 * len(few)
    for r in many:
        f = few[r.sex, r.scenario_id, r.mort_version_id, r.version_id[0]]
        assert (r.a_start, r.a_end, r.b) == pytest.approx((f.a_start, f.a_end, f.b), rel=1e-12)


def test_orders_of_any_segment_become_model_points(spark):
    o, c = read_table(spark, SF_SMALL, "orders"), read_table(spark, SF_SMALL, "customer")
    c = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, F.lit("AVIATION"))
                     .when(F.col("c_custkey") % 7 == 1, F.lit(None)).otherwise(F.col("c_mktsegment")))
    mp = model_points(o, c)
    assert mp.agg(F.sum("policy_count")).first()[0] == o.join(c, F.col("o_custkey") == F.col("c_custkey")).count()
    assert {"AVIATION", "NONE", "C1"} <= {r.cohort_id for r in mp.collect()}
