"""The projection-to-BEL chain as vectors (C2-H1 without month rows).

One row per model point, scenario and mortality basis carries its projection years as an array:
the year's decrement rate, its monthly survival and the in-force that it opens with. Rates come
from one array per table, indexed by age or duration, so nothing is joined per month and no window is
needed. Within a year the in-force falls by one factor a month, so the present value of a year is
its opening in-force times a polynomial of that factor, whose coefficients are the year's twelve
discount factors (Horner's rule, in generated code): month rows never exist. The row path
(``projection``, ``cashflow``, ``discounting``) gives the same values month by month and stays the
source of the month-level models and of the gate, which holds the two against each other.

A year without a mortality row contributes nothing and leaves later years as they are, a duration
without a lapse row lapses at zero, a month beyond the curve has no discount factor and contributes
nothing: as in the row path. A repeated (age, sex, version) or duration raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.functions import discounting as D
from tontine.functions.rates import safe_ratio, stressed_monthly
from tontine.operators.discounting import curve_horizon, unique_points
from tontine.operators.joins import bounded_broadcast, row_bytes, row_count
from tontine.operators.pricing import annual_discounts, gross_divisor
from tontine.operators.projection import cohort_x_scenario
from tontine.operators.valuation import BEL_CARRY, BEL_KEYS
from tontine.params import ValuationParams


def rate_vector(table: DataFrame, index: str, rate: str, *keys: str) -> DataFrame:
    """``(*keys, rates)``: the rates at 0, 1, .. as an array, null where the table has no row."""
    at = table.where(F.col(index).isNotNull() & (F.col(index) >= 0)).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(index).cast("int"), F.col(rate)))).alias("at"))
    top = F.array_max(F.map_keys("at"))
    return at.select(*keys, F.transform(F.sequence(F.lit(0), top), lambda i: F.try_element_at("at", i)).alias("rates"))


def chain_years(policy: DataFrame, scenario: DataFrame, mortality: DataFrame, lapse: DataFrame, params: ValuationParams) -> DataFrame:
    """One row per model point (with ``monthly_premium``), scenario and basis; ``years`` holds
    (q, s, open) of every remaining year: monthly mortality, monthly survival, in-force at its start."""
    base = cohort_x_scenario(policy.filter(F.col("remaining_term_years") > 0), scenario, params).drop("attained_age")
    q = rate_vector(mortality, "age", "qx_annual", "sex", "mort_version_id").withColumnRenamed("rates", "q_by_age")
    chains = base.join(F.broadcast(q) if _few(mortality, params) else q, "sex", "inner")
    chains = chains.crossJoin(F.broadcast(rate_vector(lapse, "duration_year", "lapse_rate_annual").select(F.col("rates").alias("l_by_year"))))  # one row
    e, elapsed = params.monthly_exponent, F.col("elapsed_duration_years")

    def year(y: Column) -> Column:
        annual = F.get("q_by_age", (F.col("issue_age") + elapsed + y - 1).cast("int"))
        qx = F.when(annual.isNotNull(), stressed_monthly(annual, F.col("mortality_multiplier"), e))
        lx = stressed_monthly(F.get("l_by_year", (elapsed + y).cast("int")), F.col("lapse_multiplier"), e)
        return F.struct(qx.alias("q"), ((F.lit(1.0) - qx) * (F.lit(1.0) - lx)).alias("s"))

    rates = F.transform(F.sequence(F.lit(1), F.col("remaining_term_years").cast("int")), year)
    none = F.array().cast("array<double>")
    opens = F.aggregate("rates", F.struct(F.col("policy_count").cast("double").alias("now"), none.alias("all")), lambda acc, y: F.struct(
        (acc["now"] * F.coalesce(F.pow(y["s"], F.lit(12.0)), F.lit(1.0))).alias("now"), F.array_append(acc["all"], acc["now"]).alias("all")), lambda acc: acc["all"])
    chains = chains.withColumn("rates", rates).withColumn("opens", opens)
    years = F.zip_with("rates", "opens", lambda y, o: F.struct(y["q"].alias("q"), y["s"].alias("s"), o.alias("open")))
    return chains.withColumn("years", years).select("*", (F.col("remaining_term_years") * 12).alias("remaining_months")).drop("rates", "opens", "q_by_age", "l_by_year")


def _few(mortality: DataFrame, params: ValuationParams) -> bool:
    """Whether the mortality table is within the broadcast bounds; its vectors are smaller."""
    n = row_count(mortality)
    return n <= params.broadcast_max_rows and n * row_bytes(mortality) <= params.broadcast_max_bytes


def month_vectors(chains: DataFrame) -> DataFrame:
    """``chain_years`` plus ``open`` and ``deaths``, in-force and expected deaths of every month."""
    def months(f) -> Column:
        return F.flatten(F.transform("years", lambda y: F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: f(y["open"] * F.pow(y["s"], k.cast("double")), y["q"]))))
    return chains.select("*", months(lambda o, q: o).alias("open"), months(lambda o, q: o * q).alias("deaths"))


def discount_years(curve: DataFrame, scenario: DataFrame) -> DataFrame:
    """G8 by year: ``(discount_shift_bps, projection_year, version_id, d)``, ``d`` the 13 factors of the
    year's month boundaries, null where the curve ends, up to a year without any. One row per version,
    shift and year."""
    points = unique_points(curve).groupBy("version_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("tenor_month").cast("int"), F.col("zero_rate_annual")))).alias("at"))
    years = (curve_horizon(curve) / F.lit(12)).cast("int") + 1
    shifts = scenario.select("discount_shift_bps").distinct()
    grid = points.crossJoin(F.broadcast(shifts)).select("*", F.explode(F.sequence(F.lit(1), years)).alias("projection_year"))  # versions x shifts

    def factor(m: Column) -> Column:
        low, high = D.lower_tenor(m), D.upper_tenor(m)
        rate = D.interpolated_rate(m, low, high, F.coalesce(F.try_element_at("at", low), F.lit(0.0)), F.try_element_at("at", high), F.col("discount_shift_bps"))
        return D.discount_factor(m, rate)
    months = F.sequence((F.col("projection_year") - 1) * 12, F.col("projection_year") * 12)
    return grid.select("discount_shift_bps", "projection_year", "version_id", F.transform(months, factor).alias("d"))


def _horner(first: int) -> Column:
    """d[first] + s (d[first + 1] + s (.. d[first + 11])); a missing factor is 0."""
    d = [F.coalesce(F.get("d", F.lit(k)), F.lit(0.0)) for k in range(first, first + 12)]
    out = d[-1]
    for x in reversed(d[:-1]):
        out = x + F.col("s") * out
    return out


def bel_from_years(chains: DataFrame, discounts: DataFrame, expense_rate: Column, params: ValuationParams) -> DataFrame:
    """H1-H3: the BEL of every chain under every curve version. ``discounts`` is a materialized
    ``discount_years``, broadcast within the bounds. Chains without a premium have no cash flows and drop out."""
    carry = ["cohort_id", "sex", "scenario_id", "mort_version_id", "monthly_premium", "sum_assured", *BEL_CARRY]
    x = chains.filter(F.col("monthly_premium").isNotNull()).select(*carry, "discount_shift_bps", F.posexplode("years").alias("i", "y"))
    x = x.select(*carry, "discount_shift_bps", (F.col("i") + 1).alias("projection_year"), "y.q", "y.s", "y.open").where("q is not null")
    x = x.join(bounded_broadcast(discounts, params.broadcast_max_rows), ["discount_shift_bps", "projection_year"])
    o = F.col("open")
    sums = x.groupBy(*carry, "version_id").agg(F.sum(o * _horner(0)).alias("a_start"), F.sum(o * _horner(1)).alias("a_end"), F.sum(o * F.col("q") * _horner(1)).alias("b"))
    mp, sa = F.col("monthly_premium"), F.col("sum_assured")
    pv = sums.select("cohort_id", "sex", "scenario_id", "version_id", "mort_version_id", *BEL_CARRY, (-(mp * F.col("a_start"))).alias("premium_pv"),
                     (sa * F.col("b")).alias("benefit_pv"), (mp * expense_rate * F.col("a_end")).alias("expense_pv"))
    bel = F.col("benefit_pv") + F.col("expense_pv") + F.col("premium_pv")
    return pv.select(*BEL_KEYS, *BEL_CARRY, "premium_pv", "benefit_pv", "expense_pv", bel.alias("bel_amount"),
                     safe_ratio(bel, F.col("policy_count")).alias("bel_per_policy"))


def premium_vectors(policies: DataFrame, mortality: DataFrame, curve: DataFrame, params: ValuationParams) -> DataFrame:
    """J1-J5 for model points: net and gross premium by a fold over the policy years inside the row,
    without a table of pricing keys. A year without a rate or factor leaves the premium null."""
    q = rate_vector(mortality.where(F.col("version_id") == params.pricing_mort_version), "age", "qx_annual", "sex").withColumnRenamed("rates", "q_by_age")
    v = rate_vector(annual_discounts(unique_points(curve.where(F.col("version_id") == params.pricing_curve_version))), "tenor_year", "annual_df").select(F.col("rates").alias("v_by_year"))
    p = policies.join(F.broadcast(q), "sex", "left").crossJoin(F.broadcast(v))  # a row per sex; one row
    # the fold's state has no nulls: a year that lacks its rate or factor clears ``whole``
    zero = F.struct(F.lit(1.0).alias("alive"), F.lit(0.0).alias("benefit"), F.lit(0.0).alias("annuity"), F.lit(True).alias("whole"))

    def year(acc: Column, t: Column) -> Column:
        qx, df = F.get("q_by_age", (F.col("issue_age") + t).cast("int")), F.get("v_by_year", t + 1)
        known = qx.isNotNull() & df.isNotNull()
        q0, vp = F.coalesce(qx, F.lit(0.0)), F.coalesce(df, F.lit(0.0)) * acc["alive"]
        return F.struct((acc["alive"] * (F.lit(1.0) - q0)).alias("alive"), (acc["benefit"] + vp * q0).alias("benefit"), (acc["annuity"] + vp).alias("annuity"),
                        (acc["whole"] & known).alias("whole"))
    term = F.col("term_years").cast("int")
    sums = F.when(term >= 1, F.aggregate(F.sequence(F.lit(0), F.greatest(term - 1, F.lit(0))), zero, year))
    net = F.when(F.col("sums.whole"), F.col("sum_assured") * F.col("sums.benefit") / F.col("sums.annuity"))
    return (p.withColumn("sums", sums).withColumn("annual_net_premium", net)
            .withColumn("annual_gross_premium", F.col("annual_net_premium") / F.lit(gross_divisor(params))).drop("sums", "q_by_age", "v_by_year"))
