"""Curve analytics (K1-K5) and curve / mortality-basis BEL comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tontine.functions.rates import safe_ratio
from tontine.params import ValuationParams

# Last liquid point (years), ultimate forward rate, convergence point (years)
LLP_YEARS = 20
UFR = 0.0330
CONVERGENCE_YEARS = 60


def _years(curve: DataFrame) -> DataFrame:
    return curve.withColumn("tenor_year", F.col("tenor_month") / F.lit(12.0))


def forward_rates(curve: DataFrame) -> DataFrame:
    """K1: forward between consecutive tenors t1 < t2: (1+s2)^t2 / (1+s1)^t1 - 1, keyed by t2."""
    w = Window.partitionBy("version_id").orderBy("tenor_month")
    c = _years(curve)
    s1, t1 = F.lag("zero_rate_annual").over(w), F.lag("tenor_year").over(w)
    fwd = F.pow(F.lit(1.0) + F.col("zero_rate_annual"), F.col("tenor_year")) / F.pow(F.lit(1.0) + s1, t1) - F.lit(1.0)
    return (c.withColumn("forward_rate", fwd).filter(F.col("forward_rate").isNotNull())
            .select("version_id", "tenor_month", "tenor_year", "forward_rate"))


def annual_discount_factors(curve: DataFrame) -> DataFrame:
    """K2: DF(t) = 1 / (1 + s_t)^t."""
    c = _years(curve)
    return c.select("version_id", "tenor_month", "tenor_year", "zero_rate_annual",
                    (F.lit(1.0) / F.pow(F.lit(1.0) + F.col("zero_rate_annual"), F.col("tenor_year"))).alias("discount_factor"))


def ufr_check(curve: DataFrame, ufr: float = UFR, convergence_years: int = CONVERGENCE_YEARS) -> DataFrame:
    """K3: forward rate ending at the convergence point against the UFR."""
    return (forward_rates(curve).filter(F.col("tenor_month") == 12 * convergence_years)
            .select("version_id", "forward_rate", F.lit(ufr).alias("ufr"),
                    (F.col("forward_rate") - F.lit(ufr)).alias("gap")))


def va_effect(curve: DataFrame, without_va: str, with_va: str, tenor_years: int = LLP_YEARS) -> DataFrame:
    """K4: relative DF change (%) at one tenor between a curve and its VA variant."""
    d = annual_discount_factors(curve).filter(F.col("tenor_month") == 12 * tenor_years)
    a = d.filter(F.col("version_id") == without_va).select("tenor_month", F.col("discount_factor").alias("df_no_va"))
    b = d.filter(F.col("version_id") == with_va).select("tenor_month", F.col("discount_factor").alias("df_with_va"))
    return (a.join(b, ["tenor_month"], "inner")
            .withColumn("df_change_pct", (F.col("df_with_va") - F.col("df_no_va")) / F.col("df_no_va") * 100))


def _paired(curves: DataFrame, pairs: DataFrame, value: str, names: tuple[str, str]) -> DataFrame:
    """``value`` of both versions of each pair, per tenor: two equi-joins on the version."""
    first, second = (curves.select(F.col("version_id").alias(k), "tenor_month", F.col(value).alias(n))
                     for k, n in zip(("first_version_id", "second_version_id"), names))
    return pairs.join(first, ["first_version_id"], "inner").join(second, ["second_version_id", "tenor_month"], "inner")


def va_effects(curve: DataFrame, pairs: DataFrame, tenor_years: int = LLP_YEARS) -> DataFrame:
    """K4 for a table of (first_version_id without, second_version_id with) pairs of any size."""
    d = annual_discount_factors(curve.filter(F.col("tenor_month") == 12 * tenor_years))
    return (_paired(d, pairs, "discount_factor", ("df_no_va", "df_with_va"))
            .withColumn("df_change_pct", (F.col("df_with_va") - F.col("df_no_va")) / F.col("df_no_va") * 100))


def curve_divergences(curve: DataFrame, pairs: DataFrame, llp_years: int = LLP_YEARS) -> DataFrame:
    """K5 for a table of pairs of any size."""
    return (_paired(curve.filter(F.col("tenor_month") <= 12 * llp_years), pairs, "zero_rate_annual", ("spot_first", "spot_second"))
            .withColumn("spot_diff", F.col("spot_second") - F.col("spot_first")))


def curve_divergence(curve: DataFrame, first: str, second: str, llp_years: int = LLP_YEARS) -> DataFrame:
    """K5: spot-rate difference between two curves up to the last liquid point."""
    c = curve.filter(F.col("tenor_month") <= 12 * llp_years)
    a = c.filter(F.col("version_id") == first).select("tenor_month", F.col("zero_rate_annual").alias("spot_first"))
    b = c.filter(F.col("version_id") == second).select("tenor_month", F.col("zero_rate_annual").alias("spot_second"))
    return (a.join(b, ["tenor_month"], "inner")
            .withColumn("spot_diff", F.col("spot_second") - F.col("spot_first")))


def curve_bel_impact(portfolio: DataFrame, params: ValuationParams) -> DataFrame:
    """BASE BEL per curve version and mortality basis; delta and percent against the
    reference curve; max-min spread across curves and spread / max (per mortality basis)."""
    base = portfolio.filter(F.col("scenario_id") == params.base_scenario).select(
        "version_id", "mort_version_id", "total_bel")
    w = Window.partitionBy("mort_version_id")
    ref = F.max(F.when(F.col("version_id") == params.reference_curve_version, F.col("total_bel"))).over(w)
    mx, mn = F.max("total_bel").over(w), F.min("total_bel").over(w)
    return (base.withColumn("ref_bel", ref)
            .withColumn("delta_vs_ref", F.col("total_bel") - F.col("ref_bel"))
            .withColumn("pct_vs_ref", safe_ratio(F.col("delta_vs_ref"), F.abs(F.col("ref_bel"))))
            .withColumn("spread", mx - mn)
            .withColumn("spread_pct", safe_ratio(mx - mn, mx)))


def mortality_bel_impact(portfolio: DataFrame, params: ValuationParams,
                         va_pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """BASE BEL per mortality basis against the reference basis (per curve), and the VA
    effect (BEL on the VA curve minus BEL on its no-VA twin) under each basis."""
    base = portfolio.filter(F.col("scenario_id") == params.base_scenario).select(
        "version_id", "mort_version_id", "total_bel")
    w = Window.partitionBy("version_id")
    ref = F.max(F.when(F.col("mort_version_id") == params.reference_mort_version, F.col("total_bel"))).over(w)
    out = (base.withColumn("ref_mort_bel", ref)
           .withColumn("delta_vs_ref_mort", F.col("total_bel") - F.col("ref_mort_bel"))
           .withColumn("pct_vs_ref_mort", safe_ratio(F.col("delta_vs_ref_mort"), F.abs(F.col("ref_mort_bel")))))
    pairs = params.va_pairs if va_pairs is None else va_pairs
    twin = F.create_map(*[x for a, b in pairs for x in (F.lit(b), F.lit(a))]) if pairs else F.create_map().cast("map<string,string>")
    partner = base.select(F.col("version_id").alias("twin_version_id"), "mort_version_id",
                          F.col("total_bel").alias("twin_bel"))
    return (out.withColumn("twin_version_id", twin[F.col("version_id")])
            .join(partner, ["twin_version_id", "mort_version_id"], "left")
            .withColumn("va_effect", F.col("total_bel") - F.col("twin_bel"))
            .drop("twin_bel"))
