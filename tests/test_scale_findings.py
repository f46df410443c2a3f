"""Rules, curves and rounding at scale: what a task reports, where rows expand, which values come out."""

import pytest
from pyspark.sql import functions as F

from tontine.functions.rates import round_half_up
from tontine.operators import discounting as DG
from tontine.operators import quality as DQ
from tontine.operators.joins import dealt_join, hot_buckets
from tontine.params import ValuationParams
from tontine.plans.factor import FactorValuation
from tontine.plans.pipeline import Valuation
from tontine.plans.registry import Ctx
from tontine.sources.fixtures import policies, policy_exposure, read_table
from tests.conftest import SF_SMALL

P = ValuationParams()
RULES = DQ.pipeline_rules()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_rules_build_only_the_models_that_have_them(raw_small):
    """The range rules need no gate and no BEL; every rule of the kind is counted."""
    v = Valuation(raw_small, P)
    got = v.row_assertions(RULES, ("accepted_range",))
    assert not {"gate", "bel_wide", "mart_core"} & set(v.__dict__)
    assert {x[:3] for x in got} == {(t, r.kind, r.label) for t, rs in RULES.items() for r in rs if r.kind == "accepted_range"}
    assert v.row_assertions({}, ("not_null",)) == []


def test_row_rules_are_summed_before_they_meet(spark, raw_small):
    """Every model's sums are exchanged by themselves: no task carries the metrics of all models."""
    v = Valuation(raw_small, P, materialize="none")
    t = {n: v.checked_table(n) for n in ("int_cashflow_lines", "int_inforce_rollforward")}
    plan = _plan(DQ.run_rules(t, {n: RULES[n] for n in t}, DQ.ROW_RULES))
    assert "CollectMetrics" not in plan and plan.count("partial_sum") >= 2


def test_curve_months_are_made_after_the_last_shuffle(spark, raw_small):
    """Months and shifts come from one row a version, which is dealt to the tasks asked for."""
    t = DG.discount_factor_table(raw_small.discount_curve, raw_small.stress_scenario_definition, P, 7)
    plan = _plan(t.select("version_id", "discount_month", "discount_factor"))
    assert "Join" not in plan and "REPARTITION_BY_NUM" in plan and "hashpartitioning(version_id" in plan
    assert plan.index("Generate") < plan.index("REPARTITION_BY_NUM")
    assert t.rdd.getNumPartitions() == 7


def test_curve_bracket_of_odd_curves(spark):
    """Holes, a tenor off the grid, an unnamed version, a missing tenor: as LEFT joins on exact tenors give."""
    rows = [(12, 0.01, "A"), (36, 0.03, "A"), (40, 0.9, "A"), (24, 0.02, "B"), (None, 0.5, "B"), (12, 0.7, None), (None, 0.6, "C"), (None, 0.4, "C")]
    curve = spark.createDataFrame(rows, "tenor_month long, zero_rate_annual double, version_id string")
    got = DG.curve_bracket(curve).collect()
    at = {(v, t): r for t, r, v in rows if v is not None and t is not None}
    want = set()
    for v in {v for *_, v in rows}:
        for m in range(43):
            lo = 0 if m <= 0 else (m - 1) // 12 * 12
            hi = 12 if m <= 0 else -(-m // 12) * 12
            want.add((v, m, lo, hi, at.get((v, lo), 0.0), at.get((v, hi))))
    assert len(got) == len(want) and {(r.version_id, r.discount_month, r.lower_tenor, r.upper_tenor, r.lower_rate, r.upper_rate) for r in got} == want
    assert DG.curve_bracket(curve.where("tenor_month is null")).count() == 0
    assert DG.curve_bracket(curve.limit(0)).count() == 0
    with pytest.raises(Exception, match="discount curve A has several rows for tenor 12"):
        DG.curve_bracket(curve.unionByName(curve.where("version_id = 'A'").limit(1))).collect()


def test_single_readers_need_no_boundary_of_the_rollforward(raw_small):
    v = Valuation(raw_small, P)
    n = v.discounted_cashflows.count()
    assert "inforce_wide" not in v.__dict__
    assert n == v.inforce_wide.filter("monthly_premium is not null").count() * 3 * 4


def test_policies_are_dealt_before_they_fan_out(spark, raw_small):
    """A book in one file part is valued by as many tasks as the session has shuffle partitions."""
    book = policies(read_table(spark, SF_SMALL, "orders"), read_table(spark, SF_SMALL, "customer")).coalesce(1)
    f = FactorValuation(book, raw_small, P)
    out = f.policy_bel()
    assert out.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert out.count() == 72 * book.count()


@pytest.fixture()
def shuffled(spark):
    """Joins as of tables beyond Spark's broadcast threshold."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_orders_are_shuffled_once_for_their_policies(shuffled):
    """policy_bel writes orders and customers to disk once, as narrow rows, and the exposure does too."""
    plan = _plan(policy_exposure(read_table(shuffled, SF_SMALL, "orders"), read_table(shuffled, SF_SMALL, "customer")))
    assert plan.count("Exchange hashpartitioning") == 3      # orders, customers, the sums of the cells
    c = Ctx(shuffled, SF_SMALL)
    plan = _plan(c.fv.policy_bel())
    assert plan.count("Exchange hashpartitioning") == 2 and "RoundRobin" not in plan
    assert c.fv.policy_bel().count() == 72 * c.policies.count()


def test_dealt_join_is_the_inner_join(shuffled):
    """Keys that are null, repeated on both sides, on one side alone or hot; a hot key meets several tasks."""
    left = shuffled.range(4000).select(F.expr("case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 97 end").alias("k"), (F.col("id") % 1500).alias("x"))
    right = shuffled.range(120).select(F.expr("cast(case when id % 40 = 0 then null when id > 110 then 7 else id end as int)").alias("r"), F.col("id").alias("y"))
    want = sorted(map(tuple, left.join(right, F.col("k") == F.col("r")).collect()))
    pieces = hot_buckets(left, "k", 8, least=1)
    assert len(pieces) == 1 and set(pieces.values()) == {3}
    for p in (None, pieces):
        for parts in (None, 16):
            assert sorted(map(tuple, dealt_join(left, right, "k", "r", p, parts).collect())) == want
    hot = dealt_join(left, right, "k", "r", pieces, 16).where("k = 7").select(F.spark_partition_id()).distinct().count()
    assert hot > 1
    assert hot_buckets(left, "k", 8) == hot_buckets(left.limit(0), "k", 8) == {}


def test_a_hot_customer_is_cut_and_keeps_its_values(shuffled):
    o = read_table(shuffled, SF_SMALL, "orders").withColumn("o_custkey", F.expr("case when o_orderkey % 3 = 0 then 4 when o_orderkey % 7 = 1 then null else o_custkey end"))
    c = read_table(shuffled, SF_SMALL, "customer")
    pieces = hot_buckets(o, "o_custkey", 8, least=1)
    assert pieces
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(policies(o, c, pieces, 8)) == rows(policies(o, c))
    assert rows(policy_exposure(o, c, pieces)) == rows(policy_exposure(o, c)) == rows(policies(o, c).groupBy(
        "cohort_id", "sex", "issue_age", "term_years", "elapsed_duration_years").agg(F.sum("sum_assured").alias("exposure"), F.sum("policy_count").alias("policy_count")))


@pytest.mark.parametrize("digits", [0, 2, 5, 10])
def test_round_half_up_is_spark_rounding(spark, digits):
    """Ties, their neighbours, all magnitudes and the values that are no numbers."""
    x = F.explode(F.array(
        F.expr(f"(id + 0.5D) / pow(10, {digits})"), F.expr(f"(id + 0.5D) / pow(10, {digits}) * (1 + (id % 9 - 4) * 1.1102230246251565e-16)"),
        F.expr("(rand(1) - 0.5) * pow(10, id % 24 - 12)"), F.expr("-id / 1000D"), F.expr(f"id * pow(10, 12) / pow(10, {digits + 1})")))
    odd = spark.sql("select x from values (double('NaN')), (double('Infinity')), (double('-Infinity')), (null), (-0.0D), (1e300D), (-1e17D), "
                    "(0.49999999999999994D), (4503599627370497.5D), (2.675D), (-2.5D), (0.285D) t(x)")
    rows = spark.range(20_000).select(x.alias("x")).unionByName(odd)
    wrong = rows.select("x", (round_half_up(F.col("x"), digits) + 0.0).alias("a"), (F.round("x", digits) + 0.0).alias("b")).where("not (a <=> b)")
    assert wrong.take(3) == []
    fast = rows.select(round_half_up(F.col("x"), digits).alias("a"))
    assert "CASE WHEN" in _plan(fast)
