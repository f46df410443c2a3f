"""Discounting.

Discount factors depend only on (curve version, scenario shift, discount month), so they are
computed once on a small grid (G8) and attached to the cash flows with one broadcast
equi-join on (shift, month) that also fans the rows out to every curve version (G4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tontine.functions import discounting as D
from tontine.operators.joins import bounded_broadcast, plan_key
from tontine.params import ValuationParams

DISCOUNTED_COLUMNS = ["cohort_id", "sex", "scenario_id", "mort_version_id", "projection_month", "cashflow_type",
                      "cashflow_amount", "cashflow_timing", "version_id", "discount_factor", "discounted_cashflow"]


def curve_horizon(curve: DataFrame):
    """Largest tenor of any curve version, as a scalar subquery column."""
    return curve.agg(F.max("tenor_month")).scalar()


def unique_points(curve: DataFrame) -> DataFrame:
    """The curve with one row per (version_id, tenor_month); a repeated key raises, since every
    present value that reads it would be counted twice or read either rate."""
    repeated = F.concat(F.lit("discount curve "), F.coalesce(F.col("version_id").cast("string"), F.lit("NULL")),
                        F.lit(" has several rows for tenor "), F.coalesce(F.col("tenor_month").cast("string"), F.lit("NULL")))
    points = curve.groupBy("version_id", "tenor_month").agg(
        F.count(F.lit(1)).alias("n"), F.first("zero_rate_annual").alias("rate"))
    return points.select("version_id", "tenor_month",
                         F.when(F.col("n") == 1, F.col("rate")).otherwise(F.raise_error(repeated)).alias("zero_rate_annual"))


def version_points(curve: DataFrame, parts: int | None = None) -> DataFrame:
    """``(version_id, at)``: the points of every curve version as a map tenor -> rate, a repeated key
    raises as in ``unique_points``. Points without a tenor or version match nothing. ``parts`` deals
    the versions to that many tasks: a table of versions is small, what is made of its rows is not,
    and Spark would join its partitions into one."""
    known = F.col("version_id").isNotNull() & F.col("tenor_month").isNotNull()
    points = unique_points(curve.where(known)).select("version_id", F.struct(F.col("tenor_month").cast("long"), "zero_rate_annual").alias("point"))
    bare = curve.where(~known).select("version_id").distinct().select("version_id", F.lit(None).cast(points.schema["point"].dataType).alias("point"))
    both = points.unionByName(bare)
    if parts:
        both = both.repartition(parts, "version_id")
    return both.groupBy("version_id").agg(F.map_from_entries(F.collect_list("point")).alias("at"))


def curve_bracket(curve: DataFrame, parts: int | None = None) -> DataFrame:
    """lower/upper annual tenors and their rates for the months 0 .. horizon + 2 of every
    version, where horizon is the largest tenor of any (a missing lower tenor reads as 0 %, a missing
    upper tenor as NULL, traps T7/T8). The rates are looked up once a year inside the version's row,
    and the months are generated after it, so no row of a month is shuffled or joined."""
    last = (curve_horizon(curve) + 2).cast("int")
    k = F.col("k")
    years = F.when(last > 12, F.ceil(last / F.lit(12)).cast("int") - 1).when(last <= 12, F.lit(0))  # no rows without a tenor
    b = version_points(curve, parts).select("version_id", "at", F.explode(F.sequence(F.lit(0), years)).alias("k"))
    b = b.select("version_id", "k", (k * 12).cast("long").alias("lower_tenor"), (k * 12 + 12).cast("long").alias("upper_tenor"), "at")
    b = b.select("version_id", "k", "lower_tenor", "upper_tenor", F.coalesce(F.try_element_at("at", F.col("lower_tenor")), F.lit(0.0)).alias("lower_rate"),
                 F.try_element_at("at", F.col("upper_tenor")).alias("upper_rate"))
    months = F.sequence(F.when(k == 0, F.lit(0)).otherwise(k * 12 + 1), F.least(k * 12 + 12, last))
    return b.select("version_id", "lower_tenor", "upper_tenor", "lower_rate", "upper_rate", F.explode(months).alias("discount_month"))


def discount_factor_table(curve: DataFrame, scenario: DataFrame, params: ValuationParams, parts: int | None = None) -> DataFrame:
    """(version_id, discount_shift_bps, discount_month) -> interpolated rate and DF.

    Grid = every curve version x every scenario shift x months 0 .. horizon+2, where horizon is
    the largest curve tenor; any month after horizon has no upper tenor, so its DF is NULL (T8).
    Size = versions x shifts x (horizon + 2): it grows with the assumption tables, never with
    the portfolio. ``parts`` as in ``version_points``, for tables of many versions.
    """
    shifts = scenario.agg(F.collect_set("discount_shift_bps")).scalar()
    b = curve_bracket(curve, parts).select("*", F.explode(shifts).alias("discount_shift_bps"))
    dm = F.col("discount_month")
    rate = D.interpolated_rate(dm, F.col("lower_tenor"), F.col("upper_tenor"), F.col("lower_rate"),
                               F.col("upper_rate"), F.col("discount_shift_bps"))
    b = b.select("version_id", "discount_shift_bps", "discount_month", "lower_tenor", "upper_tenor",
                 "lower_rate", "upper_rate", rate.alias("interpolated_rate"))
    return b.select("*", D.discount_factor(dm, F.col("interpolated_rate")).alias("discount_factor"))


def discounted_cashflows(cashflows: DataFrame, curve: DataFrame, scenario: DataFrame,
                         params: ValuationParams) -> DataFrame:
    """Cash flows (carrying discount_shift_bps) x curve versions with DF and PV."""
    dft = discount_factor_table(curve, scenario, params).select(
        "version_id", "discount_shift_bps", F.col("discount_month").alias("dm_key"), "discount_factor")
    dm = D.discount_month(F.col("projection_month"), F.col("cashflow_timing"))
    cf = (cashflows.withColumn("discount_month", dm)
          .withColumn("dm_key", F.least(dm, (curve_horizon(curve) + 1).cast("int"))))
    small = bounded_broadcast(dft, params.broadcast_max_rows, key=("dft",) + plan_key(curve, scenario))
    return (cf.join(small, ["discount_shift_bps", "dm_key"], "inner")
            .withColumn("discounted_cashflow", F.col("cashflow_amount") * F.col("discount_factor")))


def discount_pair_table(curve: DataFrame, scenario: DataFrame, params: ValuationParams) -> DataFrame:
    """(version_id, discount_shift_bps, month m >= 1) -> DF(m) and DF(m-1): the discount
    factors of a month-end and of a month-start cash flow of projection month m. Months
    after horizon+2 read the row of horizon+2, whose factors are both NULL."""
    t = discount_factor_table(curve, scenario, params)
    w = Window.partitionBy("version_id", "discount_shift_bps").orderBy("discount_month")
    return (t.select("version_id", "discount_shift_bps", F.col("discount_month").alias("projection_month"),
                     F.col("discount_factor").alias("df_end"),
                     F.lag("discount_factor").over(w).alias("df_start"))
            .filter(F.col("projection_month") >= 1))


def pivot_versions(curve: DataFrame, params: ValuationParams) -> list[str] | None:
    """The curve versions, if few enough to be columns of one aggregation."""
    few = curve.select("version_id").distinct().sort("version_id").limit(params.max_pivot_versions + 1)
    versions = [r.version_id for r in few.collect()]  # max_pivot_versions + 1 names at most
    return None if len(versions) > params.max_pivot_versions or None in versions else versions


def pv_sums(inforce: DataFrame, curve: DataFrame, scenario: DataFrame, params: ValuationParams,
            keys: list[str]) -> DataFrame:
    """Per ``keys`` x curve version: a_start = sum open*DF(m-1), a_end = sum open*DF(m),
    b = sum open*q*DF(m) over the in-force rows (which carry discount_shift_bps).

    BEL follows by linearity: premium_pv = -monthly_premium * a_start, benefit_pv =
    sum_assured * b, expense_pv = monthly_premium * rate * a_end, with no 3-lines x curves
    expansion. A few curve versions (``max_pivot_versions``) are pivoted to columns of the
    discount-pair table, so every in-force row is joined once (one broadcast hash join) and
    aggregated once; more of them stay rows of the same table, with the same result.
    """
    pairs = discount_pair_table(curve, scenario, params).withColumnRenamed("projection_month", "m_key")
    versions = pivot_versions(curve, params)
    if versions is None:
        return _pv_sums_long(inforce, pairs, curve, scenario, params, keys)
    wide = (pairs.groupBy("discount_shift_bps", "m_key").pivot("version_id", versions)
            .agg(F.first("df_start").alias("s"), F.first("df_end").alias("e")))
    small = bounded_broadcast(wide, params.broadcast_max_rows, key=("pairs_wide",) + plan_key(curve, scenario))
    horizon = curve_horizon(curve)
    rows = inforce.select(*keys, "discount_shift_bps", "inforce_open", "scenario_qx_monthly",
                          F.least(F.col("projection_month"), (horizon + 2).cast("int")).alias("m_key"))
    o, q = F.col("inforce_open"), F.col("scenario_qx_monthly")
    aggs = []
    for i, v in enumerate(versions):
        ds, de = F.col(f"`{v}_s`"), F.col(f"`{v}_e`")
        aggs += [F.sum(o * ds).alias(f"s{i}"), F.sum(o * de).alias(f"e{i}"), F.sum(o * q * de).alias(f"b{i}")]
    sums = rows.join(small, ["discount_shift_bps", "m_key"], "inner").groupBy(*keys).agg(*aggs)
    per_version = F.array(*[F.struct(F.lit(v).alias("version_id"), F.col(f"s{i}").alias("a_start"),
                                     F.col(f"e{i}").alias("a_end"), F.col(f"b{i}").alias("b"))
                            for i, v in enumerate(versions)])
    return sums.select(*keys, F.inline(per_version))


def _pv_sums_long(inforce: DataFrame, pairs: DataFrame, curve: DataFrame, scenario: DataFrame, params: ValuationParams,
                  keys: list[str]) -> DataFrame:
    """``pv_sums`` with one row per curve version: partial sums map-side, any number of versions."""
    small = bounded_broadcast(pairs, params.broadcast_max_rows, key=("pairs",) + plan_key(curve, scenario))
    rows = inforce.select(*keys, "discount_shift_bps", "inforce_open", "scenario_qx_monthly",
                          F.least(F.col("projection_month"), (curve_horizon(curve) + 2).cast("int")).alias("m_key"))
    o, q = F.col("inforce_open"), F.col("scenario_qx_monthly")
    return (rows.join(small, ["discount_shift_bps", "m_key"], "inner").groupBy(*keys, "version_id")
            .agg(F.sum(o * F.col("df_start")).alias("a_start"), F.sum(o * F.col("df_end")).alias("a_end"),
                 F.sum(o * q * F.col("df_end")).alias("b")))
