"""The scale paths: hot keys and the fallback beyond the broadcast bound."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tontine.params import ValuationParams
from tontine.plans.factor import FactorValuation
from tontine.plans.pipeline import Valuation
from tontine.sources.fixtures import policies, policy_exposure, read_table
from tests.conftest import SF_SMALL

KEYS = ["cohort_id", "sex", "scenario_id", "version_id", "mort_version_id"]


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_customer_is_aggregated_before_the_join(spark, raw_small):
    o, c = read_table(spark, SF_SMALL, "orders"), read_table(spark, SF_SMALL, "customer")
    hot = c.agg(F.min("c_custkey")).first()[0]
    skewed = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(hot)).otherwise(F.col("o_custkey")))
    n_hot = skewed.filter(F.col("o_custkey") == hot).count()
    assert n_hot * 3 >= skewed.count() - 3                      # one key holds a third of all rows
    exp = policy_exposure(skewed, c)
    nodes = re.findall(r"^\(\d+\) (\w+)", _plan(exp), re.M)
    assert nodes.index("HashAggregate") < nodes.index("Exchange")   # partial aggregate before any shuffle
    pol = policies(skewed, c)
    a = FactorValuation(pol, raw_small).segment_bel()
    b = FactorValuation(pol, raw_small, exposure=exp).segment_bel()
    ra = {tuple(r[k] for k in KEYS): r for r in a.collect()}
    rb = {tuple(r[k] for k in KEYS): r for r in b.collect()}
    assert ra.keys() == rb.keys()
    for k in ra:
        assert rb[k].bel_amount == pytest.approx(ra[k].bel_amount, rel=1e-9)
        assert rb[k].policy_count == ra[k].policy_count


def test_joins_fall_back_beyond_the_broadcast_bound(spark, raw_small, val_small):
    """Within the bound the small side carries an explicit broadcast hint; beyond it no hint
    is given and Spark plans the join itself (here forced to a shuffle join by turning off its
    own size-based broadcast for the duration of the test)."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tight = _plan(Valuation(raw_small, ValuationParams(broadcast_max_rows=10), materialize="none").inforce_wide)
        loose = _plan(Valuation(raw_small, ValuationParams(), materialize="none").inforce_wide)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # mortality and lapse lookups: broadcast within the bound, shuffle joins beyond it (the
    # model-point-grain joins carry no hint in either case)
    def n(plan, node):
        return len(re.findall(rf"^\(\d+\) {node}", plan, re.M))

    assert n(tight, "SortMergeJoin") == n(loose, "SortMergeJoin") + 2
    assert n(loose, "BroadcastHashJoin") == n(tight, "BroadcastHashJoin") + 2
    v = Valuation(raw_small, ValuationParams(broadcast_max_rows=10), materialize="none")
    ref = {tuple(r[k] for k in KEYS): r.bel_amount for r in val_small.bel_components.collect()}
    got = {tuple(r[k] for k in KEYS): r.bel_amount for r in v.bel_components.collect()}
    assert got.keys() == ref.keys()
    for k in ref:
        assert got[k] == pytest.approx(ref[k], rel=1e-12)
