"""Experience study (X1-X3): exposure by exact interval splitting, graduation, credibility.

X1 cuts every policy's time under observation at its birthdays and policy anniversaries, so each
piece has one attained age and one policy year, and sums days and deaths over the pieces. The cut
happens inside the row (arrays of dates, one ``explode``); the only shuffle is of the partial sums
per (sex, age, policy year), so a policy history of any size and a cell that holds most policies
cost the same.

Days are whole. A policy is under observation from its entry date (included) to its exit date
(excluded), but on the day of a death it still is; the window is half-open. A death counts in the
piece that ends with it, when that day lies in the window. A birthday on 29 February is 28 February in other years.

Defined results: without entry or birth date, or with an empty interval, a policy has no exposure; a null exit
date means still in force; an unknown cause is an exit without death.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.sources.schemas import RAW_SCHEMAS, conform

DAYS_PER_YEAR = 365.25
#: Deaths for full credibility: 90 % confidence of an error below 5 % (fixed value).
FULL_CREDIBILITY = 1082
#: Ages are centred and scaled before powers are taken.
AGE_CENTRE, AGE_SCALE = 50.0, 25.0


def whole_years(since: Column, at: Column) -> Column:
    """Anniversaries of ``since`` up to and including ``at``."""
    n = F.year(at) - F.year(since)
    return n - F.when(F.add_months(since, n * 12) > at, 1).otherwise(0)


def _anniversaries(since: Column, start: Column, end: Column) -> Column:
    """Anniversaries of ``since`` strictly between the two dates."""
    first, last = whole_years(since, start) + 1, whole_years(since, F.date_sub(end, 1))
    days = F.transform(F.sequence(first, last), lambda n: F.add_months(since, n * 12))
    return F.when(first <= last, days).otherwise(F.array().cast("array<date>"))


def under_observation(history: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """``history (policy_id, sex, birth_date, entry_date, exit_date, exit_cause)`` plus ``obs_from``,
    ``obs_to`` (excluded) and ``died``; policies without a day under observation drop out."""
    death = F.coalesce(F.col("exit_cause") == "death", F.lit(False))
    left = F.when(death, F.date_add("exit_date", 1)).otherwise(F.col("exit_date"))
    h = history.withColumns({"obs_from": F.greatest("entry_date", F.lit(start)), "obs_to": F.least(left, F.lit(end))})
    return (h.withColumn("died", death & (left == F.col("obs_to")))
            .where("obs_from < obs_to and entry_date is not null and birth_date is not null and birth_date <= entry_date"))


def exposure_pieces(history: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """One row per policy and stretch of one attained age and one policy year:
    ``policy_id, sex, attained_age, duration_year, piece_from, piece_to, days, deaths``."""
    o = under_observation(history, start, end)
    a, z = F.col("obs_from"), F.col("obs_to")
    inner = F.array_union(_anniversaries(F.col("birth_date"), a, z), _anniversaries(F.col("entry_date"), a, z))
    o = o.withColumn("cuts", F.array_sort(F.array_union(F.array(a, z), inner)))
    n = F.size("cuts") - 1
    o = o.withColumn("piece", F.explode(F.arrays_zip(F.slice("cuts", F.lit(1), n).alias("piece_from"), F.slice("cuts", F.lit(2), n).alias("piece_to"))))
    o = o.select("*", "piece.piece_from", "piece.piece_to")
    return o.select("policy_id", "sex", whole_years(F.col("birth_date"), F.col("piece_from")).cast("long").alias("attained_age"),
                    (whole_years(F.col("entry_date"), F.col("piece_from")) + 1).cast("long").alias("duration_year"), "piece_from", "piece_to",
                    F.datediff("piece_to", "piece_from").cast("long").alias("days"),
                    (F.col("died") & (F.col("piece_to") == F.col("obs_to"))).cast("long").alias("deaths"))


def exposure_table(history: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """X1, exposure: ``sex, attained_age, duration_year, days, deaths``; days sum to the time in force."""
    return (exposure_pieces(history, start, end).groupBy("sex", "attained_age", "duration_year")
            .agg(F.sum("days").alias("days"), F.sum("deaths").alias("deaths")))


def actual_expected(exposure: DataFrame, mortality: DataFrame, version: str) -> DataFrame:
    """``sex, attained_age, days, deaths, expected, ae_ratio``, expected deaths by the annual
    rates of one mortality version. An age without a rate has null expected deaths."""
    q = mortality.where(F.col("version_id") == version).select(F.col("age").alias("attained_age"), "sex", "qx_annual")
    e = exposure.groupBy("sex", "attained_age").agg(F.sum("days").alias("days"), F.sum("deaths").alias("deaths"))
    e = e.join(q, ["sex", "attained_age"], "left").withColumn("expected", F.col("days") / F.lit(DAYS_PER_YEAR) * F.col("qx_annual"))
    ratio = F.when(F.col("expected") > 0, F.col("deaths") / F.col("expected"))
    return e.select("sex", "attained_age", "days", "deaths", "expected", ratio.alias("ae_ratio"))


def _scaled(age: Column) -> Column:
    return (age - F.lit(AGE_CENTRE)) / F.lit(AGE_SCALE)


def graduate(ae: DataFrame, degree: int = 2) -> DataFrame:
    """``sex, term, coefficient, age_from, age_to``: the polynomial in the scaled age that fits the
    A/E ratios best, weighted by expected deaths, one per sex, term 0 the constant. Runs on
    one row per age; a sex with fewer ages than terms gets as many as its ages allow."""
    cells = ae.where("ae_ratio is not null").select("sex", F.col("attained_age").alias("age"), "ae_ratio", F.col("expected").alias("weight"), _scaled(F.col("attained_age")).alias("t"))
    spark = ae.sparkSession
    cells = cells.persist()  # ages x sexes, read by every fit
    out = []
    for sex, ages, lo, hi in cells.groupBy("sex").agg(F.count(F.lit(1)), F.min("age"), F.max("age")).collect():  # the sexes
        own = cells.where(F.col("sex").eqNullSafe(F.lit(sex)))
        top = min(degree, ages - 1)
        if top == 0:
            out.append((sex, 0, float(own.agg(F.avg("ae_ratio")).first()[0]), lo, hi))
            continue
        x = VectorAssembler(inputCols=["t"], outputCol="age_vector").transform(own)
        x = PolynomialExpansion(degree=top, inputCol="age_vector", outputCol="features").transform(x)
        fit = LinearRegression(featuresCol="features", labelCol="ae_ratio", weightCol="weight", solver="normal").fit(x)
        out += [(sex, k, float(c), lo, hi) for k, c in enumerate([fit.intercept, *fit.coefficients])]
    cells.unpersist()
    return spark.createDataFrame(out, "sex string, term int, coefficient double, age_from long, age_to long")


def graduated_ratio(age: Column, terms: Column, age_from: Column, age_to: Column) -> Column:
    """The polynomial at ``age``; beyond the ages observed its value at their edge; not below zero."""
    t = _scaled(F.least(F.greatest(age, age_from), age_to))
    return F.greatest(F.lit(0.0), F.aggregate(F.reverse(terms), F.lit(0.0), lambda s, c: s * t + c))


def experience_mortality(base: DataFrame, ae: DataFrame, coefficients: DataFrame, base_version: str, version: str,
                         full_credibility: float = FULL_CREDIBILITY) -> DataFrame:
    """The base version blended with the graduated experience, ``q = q_base (Z ratio + 1 - Z)`` with
    ``Z = min(1, sqrt(deaths of the age / full_credibility))``: ``year, age, sex, qx_annual, source,
    version_id, deaths, credibility, ratio``. Ages without deaths, and sexes without a fit, keep the base rate."""
    c = coefficients.groupBy("sex", "age_from", "age_to").agg(F.array_sort(F.collect_list(F.struct("term", "coefficient"))).alias("terms"))
    c = c.select("sex", "age_from", "age_to", F.col("terms.coefficient").alias("terms"))
    b = base.where(F.col("version_id") == base_version).select("year", "age", "sex", "qx_annual")
    seen = ae.select("sex", F.col("attained_age").alias("age"), "deaths")
    x = b.join(seen, ["sex", "age"], "left").join(c, "sex", "left").withColumn("deaths", F.coalesce("deaths", F.lit(0)))
    ratio = F.coalesce(graduated_ratio(F.col("age"), F.col("terms"), F.col("age_from"), F.col("age_to")), F.lit(1.0))
    x = x.withColumns({"credibility": F.least(F.lit(1.0), F.sqrt(F.col("deaths") / F.lit(float(full_credibility)))), "ratio": ratio})
    q = F.least(F.lit(1.0), F.col("qx_annual") * (F.col("credibility") * F.col("ratio") + (F.lit(1.0) - F.col("credibility"))))
    return x.select("year", "age", "sex", q.alias("qx_annual"), F.lit("EXPERIENCE").alias("source"), F.lit(version).alias("version_id"), "deaths", "credibility", "ratio")


def with_experience(mortality: DataFrame, blended: DataFrame) -> DataFrame:
    """The mortality table with the blended version added, in the raw table's columns."""
    schema = RAW_SCHEMAS["mortality_assumption"]
    return conform(mortality, schema).unionByName(conform(blended, schema))


def study(history: DataFrame, mortality: DataFrame, base_version: str, version: str, start: dt.date, end: dt.date,
          degree: int = 2, full_credibility: float = FULL_CREDIBILITY, boundary=lambda df: df) -> tuple[DataFrame, DataFrame, DataFrame]:
    """X1 to X3 in one go: (A/E by age, coefficients, blended rates). ``boundary`` materializes the
    A/E table, which is read several times."""
    ae = boundary(actual_expected(exposure_table(history, start, end), mortality, base_version))
    terms = graduate(ae, degree)
    return ae, terms, experience_mortality(mortality, ae, terms, base_version, version, full_credibility)

