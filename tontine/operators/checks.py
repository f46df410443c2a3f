"""Validation gate (L1-L8) and assumption sanity checks for the traps of the reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.params import ValuationParams



def _status(*fail_conditions: Column) -> Column:
    """First true condition -> FAIL, else PASS (a NULL condition is not true, as in SQL CASE)."""
    out = None
    for c in fail_conditions:
        out = F.when(c, F.lit("FAIL")) if out is None else out.when(c, F.lit("FAIL"))
    return out.otherwise(F.lit("PASS"))


def _grain(params: ValuationParams) -> list[str]:
    keys = ["cohort_id", "sex", "scenario_id"]
    return keys + (["mort_version_id"] if params.checks_by_mort_version else [])


def _month_axis(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min("projection_month").alias("min_month"), F.max("projection_month").alias("max_month"),
        F.count(F.lit(1)).alias("row_count"), F.max("remaining_months").alias("remaining_months"))


def val_projection(frame: DataFrame, inforce: DataFrame | None = None) -> DataFrame:
    """L1: month axis starts at 1, ends at remaining_months and has remaining_months rows.

    With ``inforce`` (the rows the BEL is summed from) its months must be whole as well, under
    every mortality basis it holds; a contract without in-force rows fails."""
    def broken() -> Column:
        return ((F.col("min_month") != 1) | (F.col("max_month") != F.col("remaining_months"))
                | (F.col("row_count") != F.col("remaining_months")))

    k3 = ["cohort_id", "sex", "scenario_id"]
    g = _month_axis(frame, k3)
    if inforce is None:
        return g.withColumn("projection_ok", _status(broken()))
    axis = _month_axis(inforce, k3 + ["mort_version_id"])
    bases = axis.agg(F.countDistinct("mort_version_id")).scalar()
    chain = axis.groupBy(*k3).agg(F.max(broken()).alias("chain_broken"), F.count(F.lit(1)).alias("chain_bases"))
    return (g.join(chain, k3, "left")
            .withColumn("projection_ok", _status(broken(), F.coalesce("chain_broken", F.lit(True)),
                                                 F.col("chain_bases") != bases))
            .drop("chain_broken", "chain_bases"))


def val_inforce(inforce: DataFrame, params: ValuationParams) -> DataFrame:
    """L2: open - deaths - lapses = close within tolerance, no negatives, month-1 open = count."""
    o, d, lp, c = (F.col(x) for x in ("inforce_open", "expected_deaths", "expected_lapses", "inforce_close"))
    err = F.abs(o - d - lp - c)
    neg = F.when((o < 0) | (c < 0) | (d < 0) | (lp < 0), 1).otherwise(0)
    first = F.col("projection_month") == 1
    g = (inforce.groupBy(*_grain(params))
         .agg(F.max(err).alias("max_identity_error"), F.sum(neg).alias("negative_count"),
              F.min(F.when(first, o)).alias("first_month_open"),
              F.min(F.when(first, F.col("policy_count"))).alias("policy_count")))
    return g.withColumn("inforce_ok", _status(
        F.col("max_identity_error") > params.inforce_tolerance, F.col("negative_count") > 0,
        F.col("first_month_open") != F.col("policy_count")))


def val_cashflow(cashflows: DataFrame, params: ValuationParams) -> DataFrame:
    """L3: premium <= 0 at month start; benefit and expense >= 0 at month end."""
    t, a, tm = F.col("cashflow_type"), F.col("cashflow_amount"), F.col("cashflow_timing")

    def cnt(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0))

    g = (cashflows.groupBy(*_grain(params))
         .agg(cnt((t == "premium") & (a > 0)).alias("premium_sign_fail"),
              cnt((t == "death_benefit") & (a < 0)).alias("benefit_sign_fail"),
              cnt((t == "expense") & (a < 0)).alias("expense_sign_fail"),
              cnt((t == "premium") & (tm != "month_start")).alias("premium_timing_fail"),
              cnt(t.isin("death_benefit", "expense") & (tm != "month_end")).alias("benefit_expense_timing_fail")))
    total = sum((F.col(c) for c in ("premium_sign_fail", "benefit_sign_fail", "expense_sign_fail",
                                    "premium_timing_fail", "benefit_expense_timing_fail")), F.lit(0))
    return g.withColumn("cashflow_ok", _status(total > 0))


def val_discount(discounted: DataFrame) -> DataFrame:
    """L4: discount factors positive and not NULL."""
    dfc = F.col("discount_factor")
    g = (discounted.groupBy("cohort_id", "sex", "scenario_id", "version_id", "mort_version_id")
         .agg(F.sum(F.when(dfc <= 0, 1).otherwise(0)).alias("df_non_positive"),
              F.sum(F.when(dfc.isNull(), 1).otherwise(0)).alias("df_null")))
    return g.withColumn("discount_ok", _status(F.col("df_non_positive") > 0, F.col("df_null") > 0))


def val_bel(bel: DataFrame, params: ValuationParams, discounted: DataFrame | None = None) -> DataFrame:
    """Benefit + expense + premium = bel within tolerance.

    With ``discounted`` the published BEL, which is computed by linearity, must also equal the sum
    of the discounted cash-flow lines; the larger deviation is reported, and a BEL row without
    lines fails."""
    keys = ["cohort_id", "sex", "scenario_id", "version_id", "mort_version_id"]
    err = F.abs(F.col("benefit_pv") + F.col("expense_pv") + F.col("premium_pv") - F.col("bel_amount"))
    missing = F.lit(False)
    if discounted is not None:
        lines = discounted.groupBy(*keys).agg(F.coalesce(F.sum("discounted_cashflow"), F.lit(0.0)).alias("line_sum"))
        bel = bel.join(lines, keys, "left")
        err = F.greatest(err, F.abs(F.col("line_sum") - F.col("bel_amount")))
        missing = F.col("line_sum").isNull()
    return bel.select(*keys, "premium_pv", "benefit_pv", "expense_pv", "bel_amount", err.alias("bel_error"),
                      _status(err > params.bel_tolerance, missing).alias("bel_reconciled"))


# Expected sign of the BEL change per scenario (others are not directional)
DIRECTION_RULES = [("MORT_UP", ">= 0"), ("MORT_DOWN", "<= 0"), ("RATE_UP", "<= 0"), ("RATE_DOWN", ">= 0")]


def val_direction(bel: DataFrame, params: ValuationParams) -> DataFrame:
    """Stressed minus BASE must move in the expected direction."""
    from tontine.operators.valuation import mart_sensitivity
    core_like = bel.withColumn("scenario_group", F.lit(None).cast("string"))
    s = mart_sensitivity(core_like, params)
    d, sc = F.col("delta_bel"), F.col("scenario_id")
    fails = [(sc == name) & ((d < 0) if rule == ">= 0" else (d > 0)) for name, rule in DIRECTION_RULES]
    return s.select("cohort_id", "sex", "version_id", "mort_version_id", "scenario_id", "bel_base",
                    "bel_stressed", "delta_bel", _status(*fails).alias("sensitivity_ok"))


def validation_summary(proj: DataFrame, inf: DataFrame, cf: DataFrame, disc: DataFrame, bel: DataFrame,
                       sens: DataFrame, params: ValuationParams) -> DataFrame:
    """One verdict per (model point, scenario, curve, mortality basis).

    LEFT joins from the projection check, as in the reference. With ``strict_missing_checks``
    a missing check row is a FAIL (the reference lets it pass, trap T6); a missing
    sensitivity row is expected for BASE and reads 'N/A'.
    """
    k3 = ["cohort_id", "sex", "scenario_id"]
    k5 = k3 + ["version_id", "mort_version_id"]
    kg = _grain(params)
    j = (proj.select(*k3, "projection_ok")
         .join(disc.select(*k5, "discount_ok"), k3, "left")
         .join(inf.select(*kg, "inforce_ok", "cashflow_ok") if inf is cf else inf.select(*kg, "inforce_ok"), kg, "left"))
    if inf is not cf:
        j = j.join(cf.select(*kg, "cashflow_ok"), kg, "left")
    j = (j
         .join(bel.select(*k5, "bel_reconciled"), k5, "left")
         .join(sens.select(*k5, "sensitivity_ok"), k5, "left"))
    cols = ["projection_ok", "inforce_ok", "cashflow_ok", "discount_ok", "bel_reconciled"]
    conds = []
    for c in cols:
        conds.append(F.col(c) == "FAIL")
        if params.strict_missing_checks:
            conds.append(F.col(c).isNull())
    conds.append(F.coalesce(F.col("sensitivity_ok"), F.lit("PASS")) == "FAIL")
    if params.strict_missing_checks:
        conds.append(F.col("sensitivity_ok").isNull() & (F.col("scenario_id") != params.base_scenario))
    return j.select(*k5, *cols, F.coalesce(F.col("sensitivity_ok"), F.lit("N/A")).alias("sensitivity_ok"),
                    _status(*conds).alias("overall_validation_status"))


def gate_sums(inforce: DataFrame, discounts: DataFrame, expense_rate: Column, versions: list[str], params: ValuationParams) -> DataFrame:
    """L1-L5 as aggregates of one pass over the in-force rows: per (model point, scenario, basis)
    the month axis, the roll-forward identity and the signs, and per curve version (an array) the
    unusable discount factors and the sum of the discounted lines. Every row is joined once with
    a table of the versions' factors and never becomes three lines times the curves."""
    from tontine.operators.joins import bounded_broadcast
    flag = lambda c: F.when(c, 1).otherwise(0)
    # month by month: the premium reads the first factor, benefit and expense the second
    pairs = F.zip_with(F.slice("d", 1, 12), F.slice("d", 2, 12), lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    pairs = (discounts.select("discount_shift_bps", "version_id", "projection_year", F.posexplode(pairs).alias("k", "p"))
             .select("discount_shift_bps", "version_id", ((F.col("projection_year") - 1) * 12 + F.col("k") + 1).alias("m_key"), "p.s", "p.e"))
    s, e = F.col("s"), F.col("e")
    void, bad = flag(s.isNull()) + 2 * flag(e.isNull()), flag(s <= 0) + 2 * flag(e <= 0)
    wide = pairs.groupBy("discount_shift_bps", "m_key").agg(*[F.max(F.when(F.col("version_id") == v, x)).alias(f"{v}_{n}")
                                                              for v in versions for n, x in (("s", s), ("e", e), ("void", void), ("bad", bad))])
    last = discounts.agg(F.max("projection_year") * 12).scalar()
    m = F.col("projection_month")
    # at most months x shifts of one valuation; as many bytes as the discount table itself
    rows = inforce.withColumn("m_key", F.least(m, last.cast("int"))).join(bounded_broadcast(wide, params.broadcast_max_rows), ["discount_shift_bps", "m_key"], "left")
    o, d, lp, c, prem = (F.col(x) for x in ("inforce_open", "expected_deaths", "expected_lapses", "inforce_close", "monthly_premium"))
    paid = prem.isNotNull()
    premium, benefit, expense = -(o * prem), F.when(paid, d * F.col("sum_assured")), o * prem * expense_rate
    first = m == 1
    aggs = [F.min(m).alias("min_month"), F.max(m).alias("max_month"), F.count(F.lit(1)).alias("row_count"), F.max("remaining_months").alias("remaining_months"),
            F.max(F.abs(o - d - lp - c)).alias("max_identity_error"), F.sum(flag((o < 0) | (c < 0) | (d < 0) | (lp < 0))).alias("negative_count"),
            F.min(F.when(first, o)).alias("first_month_open"), F.min(F.when(first, F.col("policy_count"))).alias("policy_count"),
            F.count(prem).alias("paid"), F.sum(flag(premium > 0) + flag(benefit < 0) + flag(expense < 0)).alias("sign_fails")]
    for i, v in enumerate(versions):
        s, e = F.col(f"`{v}_s`"), F.col(f"`{v}_e`")
        aggs += [F.sum(F.when(paid, F.col(f"`{v}_void`"))).alias(f"void{i}"), F.sum(F.when(paid, F.col(f"`{v}_bad`"))).alias(f"bad{i}"),
                 *[F.sum(x).alias(f"{n}{i}") for n, x in (("p", premium * s), ("b", benefit * e), ("x", expense * e))]]
    g = rows.groupBy("cohort_id", "sex", "scenario_id", "mort_version_id").agg(*aggs)
    line = lambda n, i: F.coalesce(F.col(f"{n}{i}"), F.lit(0.0))
    per_version = F.array(*[F.struct(F.lit(v).alias("version_id"), F.col(f"void{i}").alias("df_null"), F.col(f"bad{i}").alias("df_non_positive"),
                                     (line("p", i) + line("b", i) + line("x", i)).alias("line_sum")) for i, v in enumerate(versions)])
    fixed = ["cohort_id", "sex", "scenario_id", "mort_version_id", "min_month", "max_month", "row_count", "remaining_months", "max_identity_error",
             "negative_count", "first_month_open", "policy_count", "paid", "sign_fails"]
    return g.select(*fixed, per_version.alias("by_version"))


def gate_tables(frame: DataFrame, sums: DataFrame, bel: DataFrame, params: ValuationParams) -> dict[str, DataFrame]:
    """The check tables by name, keys and verdicts, from ``gate_sums``, the month axis of the frame
    and the published BEL; the same verdicts as the single checks give, each with a pass of its own."""
    k3 = ["cohort_id", "sex", "scenario_id"]
    k4, k5, kg = k3 + ["mort_version_id"], k3 + ["version_id", "mort_version_id"], _grain(params)
    broken = ((F.col("min_month") != 1) | (F.col("max_month") != F.col("remaining_months")) | (F.col("row_count") != F.col("remaining_months")))
    bases = sums.agg(F.countDistinct("mort_version_id")).scalar()
    chain = sums.groupBy(*k3).agg(F.max(broken).alias("chain_broken"), F.count(F.lit(1)).alias("chain_bases"))
    proj = _month_axis(frame, k3).join(chain, k3, "left").select(
        *k3, _status(broken, F.coalesce("chain_broken", F.lit(True)), F.col("chain_bases") != bases).alias("projection_ok"))
    g = sums.groupBy(*kg).agg(F.max("max_identity_error").alias("err"), F.sum("negative_count").alias("neg"), F.min("first_month_open").alias("open"),
                              F.min("policy_count").alias("n"), F.sum("paid").alias("paid"), F.sum("sign_fails").alias("signs"))
    inf = g.select(*kg, _status(F.col("err") > params.inforce_tolerance, F.col("neg") > 0, F.col("open") != F.col("n")).alias("inforce_ok"),
                   F.when(F.col("paid") > 0, _status(F.col("signs") > 0)).alias("cashflow_ok"))
    disc = sums.where("paid > 0").select(*k4, F.inline("by_version")).select(
        *k5, _status(F.col("df_non_positive") > 0, F.col("df_null") > 0).alias("discount_ok"), "line_sum")
    sens = val_direction(bel, params)
    err = F.greatest(F.abs(F.col("benefit_pv") + F.col("expense_pv") + F.col("premium_pv") - F.col("bel_amount")), F.abs(F.col("line_sum") - F.col("bel_amount")))
    both = bel.select(*k5, "premium_pv", "benefit_pv", "expense_pv", "bel_amount").join(disc, k5, "left")
    bel_ok = both.select(*k5, _status(err > params.bel_tolerance, F.col("line_sum").isNull()).alias("bel_reconciled"))
    return {"val_projection_continuity": proj, "val_inforce_reconciliation": inf.select(*kg, "inforce_ok"),
            "val_cashflow_sign_and_timing": inf.where("cashflow_ok is not null").select(*kg, "cashflow_ok"),
            "val_discounting_sanity": disc.drop("line_sum"), "val_bel_reconciliation": bel_ok, "val_sensitivity_direction": sens,
            "val_validation_summary": validation_summary(proj, inf, inf, disc, bel_ok, sens, params)}


GATE_TABLES = ("val_projection_continuity", "val_inforce_reconciliation", "val_cashflow_sign_and_timing", "val_discounting_sanity",
               "val_bel_reconciliation", "val_sensitivity_direction", "val_validation_summary", "mart_validation_summary")

MART_VALIDATION_COLUMNS = ["cohort_id", "sex", "scenario_id", "projection_ok", "version_id", "mort_version_id",
                           "inforce_ok", "cashflow_ok", "discount_ok", "bel_reconciled", "sensitivity_ok",
                           "overall_validation_status"]


def mart_validation(summary: DataFrame) -> DataFrame:
    """L8."""
    return summary.select(*MART_VALIDATION_COLUMNS)


# ----------------------------------------------------------------- assumption sanity (traps)

def assumption_checks(frame: DataFrame, mortality: DataFrame, lapse: DataFrame, curve: DataFrame,
                      expense: DataFrame, rated_rows: DataFrame, params: ValuationParams) -> DataFrame:
    """Checks the reference lacks: (check, failing) rows, all zero on clean inputs.

    * T4 frame months whose duration has no lapse row
    * T5 frame rows x mortality versions != rated rows (an age without a mortality row)
    * T7 curve versions with a hole in the annual grid
    * T16 number of maintenance expense rows != 1
    * T17 duplicated (tenor, version) curve keys
    """
    durations = lapse.select("duration_year").distinct()
    unmatched = frame.join(durations, ["duration_year"], "left_anti").agg(F.count(F.lit(1)).alias("n"))
    f = frame.agg(F.count(F.lit(1))).scalar()
    v = mortality.select("mort_version_id").distinct().agg(F.count(F.lit(1))).scalar()
    r = rated_rows.agg(F.count(F.lit(1))).scalar()
    t5 = frame.sparkSession.range(1).select(F.abs(f * v - r).alias("n"))
    holes = (curve.groupBy("version_id")
             .agg(F.max("tenor_month").alias("mx"), F.countDistinct("tenor_month").alias("nd"))
             .agg(F.sum(F.when(F.col("mx") / 12 != F.col("nd"), 1).otherwise(0)).alias("n")))
    exp_rows = expense.filter(F.col("expense_type") == params.expense_type).agg(
        F.abs(F.count(F.lit(1)) - 1).alias("n"))
    dup = curve.groupBy("tenor_month", "version_id").count().filter(F.col("count") > 1).agg(
        F.count(F.lit(1)).alias("n"))

    def tag(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("check"), F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("failing"))

    return (tag(unmatched, "lapse_duration_missing").unionByName(tag(t5, "mortality_rows_dropped"))
            .unionByName(tag(holes, "curve_grid_hole")).unionByName(tag(exp_rows, "maintenance_rows_not_one"))
            .unionByName(tag(dup, "curve_key_duplicate")))
