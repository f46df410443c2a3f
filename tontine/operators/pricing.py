"""Premium pricing (J1-J5): equivalence-principle net premium, loaded to gross.

The reference prices model points in a driver-side Python loop; here one price is computed
per distinct (sex, issue_age, term_years) as a join + window + aggregate and attached back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tontine.operators.joins import bounded_broadcast, materialized_broadcast
from tontine.params import ValuationParams

PRICE_KEYS = ["sex", "issue_age", "term_years"]


def pricing_discount(curve: DataFrame, params: ValuationParams) -> DataFrame:
    """Annual DF v^t = 1 / (1 + z_t)^t on the named pricing curve, every whole year of the curve."""
    return annual_discounts(curve.filter(F.col("version_id") == params.pricing_curve_version)).drop("version_id")


def annual_discounts(curve: DataFrame) -> DataFrame:
    """J1 of every curve version: a book whose portfolios price on curves of their own."""
    t = (F.col("tenor_month") / F.lit(12)).cast("int")
    return (curve.filter(F.col("tenor_month") % 12 == 0).select("version_id", t.alias("tenor_year"), "zero_rate_annual")
            .withColumn("annual_df", F.lit(1.0) / F.pow(F.lit(1.0) + F.col("zero_rate_annual"),
                                                        F.col("tenor_year").cast("double"))))


def pricing_survival(keys: DataFrame, mortality: DataFrame, curve: DataFrame, params: ValuationParams) -> DataFrame:
    """Per pricing key and policy year t = 0..term-1: q at age x+t, survival p_t to the start
    of year t (product window over earlier years), end-of-year discount v_{t+1}. Every policy year
    is there; a year beyond the mortality table or the curve has a null rate or factor."""
    m = (mortality.filter(F.col("version_id") == params.pricing_mort_version)
         .select(F.col("age").cast("int").alias("age"), "sex", "qx_annual"))
    v = pricing_discount(curve, params).select("tenor_year", "annual_df")
    rows = (keys.select(*PRICE_KEYS).distinct().filter(F.col("term_years") >= 1)
            .select(*PRICE_KEYS, F.explode(F.sequence(F.lit(0), F.col("term_years").cast("int") - 1)).alias("t"))
            .withColumn("age", (F.col("issue_age") + F.col("t")).cast("int"))
            .withColumn("tenor_year", F.col("t") + 1))
    w = Window.partitionBy(*PRICE_KEYS).orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(bounded_broadcast(m, params.broadcast_max_rows), ["age", "sex"], "left")
            .join(bounded_broadcast(v, params.dimension_max_rows), ["tenor_year"], "left")
            .withColumn("survival", F.coalesce(F.product(F.lit(1.0) - F.col("qx_annual")).over(w), F.lit(1.0))))


def premium_rates(keys: DataFrame, mortality: DataFrame, curve: DataFrame, params: ValuationParams) -> DataFrame:
    """J3 sums per pricing key: benefit_sum = sum v p q, annuity_sum = sum v p; both null where
    any year lacks its mortality rate or discount factor (see ``pricing_coverage``)."""
    s = pricing_survival(keys, mortality, curve, params)
    vp = F.col("annual_df") * F.col("survival")
    whole = F.count(F.when(F.col("qx_annual").isNull() | F.col("annual_df").isNull(), 1)) == 0
    return s.groupBy(*PRICE_KEYS).agg(F.when(whole, F.sum(vp * F.col("qx_annual"))).alias("benefit_sum"),
                                      F.when(whole, F.sum(vp)).alias("annuity_sum"))


def pricing_coverage(keys: DataFrame, mortality: DataFrame, curve: DataFrame, params: ValuationParams) -> DataFrame:
    """Per pricing key: policies, policy years, and the years without mortality rate or discount
    factor. A key with such years (or a term below one year) gets no premium."""
    s = pricing_survival(keys, mortality, curve, params).groupBy(*PRICE_KEYS).agg(
        F.count(F.lit(1)).alias("years"), F.count(F.when(F.col("qx_annual").isNull(), 1)).alias("missing_mortality"),
        F.count(F.when(F.col("annual_df").isNull(), 1)).alias("missing_discount"))
    n = keys.groupBy(*PRICE_KEYS).agg(F.count(F.lit(1)).alias("policies"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("years", "missing_mortality", "missing_discount")]
    return (n.join(s, PRICE_KEYS, "left").select(*PRICE_KEYS, "policies", *zero)
            .withColumn("priced", (F.col("years") > 0) & (F.col("missing_mortality") + F.col("missing_discount") == 0)))


def gross_divisor(params: ValuationParams) -> float:
    total = 0.0
    for x in params.loadings:
        total += x
    return 1.0 - total


def price(policies: DataFrame, mortality: DataFrame, curve: DataFrame, params: ValuationParams, keys: DataFrame | None = None) -> DataFrame:
    """net = SA * sum(v p q) / sum(v p); gross = net / (1 - loadings).
    The rate table has one row per distinct pricing key (bounded by the key domain, not by the
    policy count); it is materialized, counted and broadcast, so the policies are streamed
    through a hash join and never shuffled. A policy that cannot be priced keeps its row with null
    premiums. ``keys`` names the pricing keys, if they are known without deriving the policies a
    second time; keys without a policy do no harm."""
    rates = materialized_broadcast(premium_rates(policies if keys is None else keys, mortality, curve, params), params.broadcast_max_rows)
    net = F.col("sum_assured") * F.col("benefit_sum") / F.col("annuity_sum")
    return (policies.join(rates, PRICE_KEYS, "left")
            .withColumn("annual_net_premium", net)
            .withColumn("annual_gross_premium", F.col("annual_net_premium") / F.lit(gross_divisor(params))))


def premium_table(policies: DataFrame, mortality: DataFrame, curve: DataFrame, params: ValuationParams,
                  id_cols: tuple[str, ...] = ("cohort_id", "sex"), keys: DataFrame | None = None) -> DataFrame:
    """premium_input rows (tagged with the pricing version)."""
    return premium_columns(price(policies, mortality, curve, params, keys), params, id_cols)


def premium_columns(priced: DataFrame, params: ValuationParams, id_cols: tuple[str, ...] = ("cohort_id", "sex")) -> DataFrame:
    return priced.select(*id_cols, "annual_net_premium", "annual_gross_premium",
                    F.lit(params.pricing_version_id).alias("pricing_assumption_version"),
                    F.lit("ANNUAL").alias("premium_frequency"), F.lit("EUR").alias("premium_currency"))
