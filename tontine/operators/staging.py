"""Staging (B1-B9): projections, base-version resolution, defaults."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def base_version(assumption_version: DataFrame, assumption_type: str) -> DataFrame:
    """The base version id of one assumption type (0 rows -> empty downstream result;
    more than one row -> the scalar subquery fails at run time, like the reference)."""
    return (assumption_version
            .filter((F.col("assumption_type") == assumption_type) & (F.col("is_base_version") == F.lit(True)))
            .select("version_id"))


def base_version_value(assumption_version: DataFrame, assumption_type: str) -> Column:
    return base_version(assumption_version, assumption_type).scalar()


def base_version_counts(assumption_version: DataFrame) -> DataFrame:
    """B9 check: number of base rows per assumption type (must be exactly 1)."""
    return (assumption_version.groupBy("assumption_type")
            .agg(F.sum(F.when(F.col("is_base_version"), 1).otherwise(0)).alias("n_base"))
            .withColumn("ok", F.col("n_base") == 1))


def base_versions(assumption_version: DataFrame, assumption_type: str) -> DataFrame:
    """B9 for a book of several portfolios: every base version of a type, however many."""
    return base_version(assumption_version, assumption_type).distinct()


def of_versions(raw: DataFrame, versions: DataFrame) -> DataFrame:
    """The rows of the versions listed in ``versions (version_id)``."""
    return raw.join(versions.select("version_id").distinct(), "version_id", "left_semi")


def stg_lapse_versions(raw: DataFrame, versions: DataFrame) -> DataFrame:
    """B3 with a base version per portfolio."""
    return of_versions(raw, versions).select("duration_year", "lapse_rate_annual", "version_id")


def stg_expense_versions(raw: DataFrame, versions: DataFrame) -> DataFrame:
    """B4 with a base version per portfolio."""
    return of_versions(raw, versions).select("expense_type", "expense_basis", "expense_rate", "version_id", "comment")


def stg_policy(raw: DataFrame) -> DataFrame:
    """B1: attained age and remaining term; version_id -> cohort_version_id."""
    return raw.select(
        "cohort_id", "sex", "issue_age", "term_years", "maturity_age", "sum_assured", "policy_count",
        "elapsed_duration_years",
        (F.col("issue_age") + F.col("elapsed_duration_years")).alias("attained_age"),
        (F.col("term_years") - F.col("elapsed_duration_years")).alias("remaining_term_years"),
        F.col("version_id").alias("cohort_version_id"))


def stg_mortality(raw: DataFrame, versions: Sequence[str] | DataFrame) -> DataFrame:
    """B2: keep the listed mortality versions, renamed mort_version_id. ``versions`` is a list, or a
    table with a column ``version_id`` where they are many."""
    kept = of_versions(raw, versions) if isinstance(versions, DataFrame) else raw.filter(F.col("version_id").isin(list(versions)))
    return (kept
            .select("age", "sex", "qx_annual", "source", "year", F.col("version_id").alias("mort_version_id")))


def stg_lapse(raw: DataFrame, assumption_version: DataFrame) -> DataFrame:
    """Lapse rows of the single base lapse version."""
    return (raw.filter(F.col("version_id") == base_version_value(assumption_version, "lapse"))
            .select("duration_year", "lapse_rate_annual", "version_id"))


def stg_expense(raw: DataFrame, assumption_version: DataFrame) -> DataFrame:
    """Expense rows of the base expense version."""
    return (raw.filter(F.col("version_id") == base_version_value(assumption_version, "expense"))
            .select("expense_type", "expense_basis", "expense_rate", "version_id", "comment"))


def stg_premium(raw: DataFrame, assumption_version: DataFrame) -> DataFrame:
    """Premiums of the base pricing version; default frequency and currency."""
    return (raw.filter(F.col("pricing_assumption_version") == base_version_value(assumption_version, "pricing"))
            .select("cohort_id", "sex", "annual_gross_premium", "pricing_assumption_version",
                    F.coalesce("premium_frequency", F.lit("ANNUAL")).alias("premium_frequency"),
                    F.coalesce("premium_currency", F.lit("EUR")).alias("premium_currency")))


def stg_curve(raw: DataFrame) -> DataFrame:
    """All curve versions, three columns."""
    return raw.select("tenor_month", "zero_rate_annual", "version_id")


def stg_scenario(raw: DataFrame) -> DataFrame:
    """Missing multipliers -> 1.0, missing shift -> 0."""
    return raw.select(
        "scenario_id", "scenario_type",
        F.coalesce("mortality_multiplier", F.lit(1.0)).alias("mortality_multiplier"),
        F.coalesce("lapse_multiplier", F.lit(1.0)).alias("lapse_multiplier"),
        F.coalesce("discount_shift_bps", F.lit(0).cast("long")).alias("discount_shift_bps"),
        "scenario_group", "is_base_scenario", "scenario_description")


def stg_version(raw: DataFrame) -> DataFrame:
    """Governance projection."""
    return raw.select("assumption_type", "version_id", "version_name", "is_base_version")


@dataclass
class Staged:
    policy: DataFrame
    mortality: DataFrame
    lapse: DataFrame
    curve: DataFrame
    expense: DataFrame
    scenario: DataFrame
    premium: DataFrame
    version: DataFrame
