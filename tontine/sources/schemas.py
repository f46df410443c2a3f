"""Explicit schemas of the eight raw input tables (A1) and their business keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "policy_cohort_input": _schema(
        ("cohort_id", S), ("sex", S), ("issue_age", L), ("term_years", L), ("maturity_age", L),
        ("sum_assured", L), ("policy_count", L), ("elapsed_duration_years", L), ("version_id", S)),
    "mortality_assumption": _schema(
        ("year", L), ("age", L), ("sex", S), ("qx_annual", D), ("source", S), ("version_id", S)),
    "lapse_assumption": _schema(("duration_year", L), ("lapse_rate_annual", D), ("version_id", S)),
    "discount_curve": _schema(("tenor_month", L), ("zero_rate_annual", D), ("version_id", S)),
    "expense_assumption": _schema(
        ("expense_type", S), ("expense_basis", S), ("expense_rate", D), ("version_id", S), ("comment", S)),
    "stress_scenario_definition": _schema(
        ("scenario_id", S), ("scenario_type", S), ("mortality_multiplier", D), ("lapse_multiplier", D),
        ("discount_shift_bps", L), ("scenario_group", S), ("is_base_scenario", B),
        ("scenario_description", S)),
    "premium_input": _schema(
        ("cohort_id", S), ("sex", S), ("annual_net_premium", D), ("annual_gross_premium", D),
        ("pricing_assumption_version", S), ("premium_frequency", S), ("premium_currency", S)),
    "assumption_version": _schema(
        ("assumption_type", S), ("version_id", S), ("version_name", S), ("is_base_version", B)),
}

RAW_KEYS: dict[str, tuple[str, ...]] = {
    "policy_cohort_input": ("cohort_id", "sex"),
    "mortality_assumption": ("age", "sex", "version_id"),
    "lapse_assumption": ("duration_year",),
    "discount_curve": ("tenor_month", "version_id"),
    "expense_assumption": ("expense_type",),
    "stress_scenario_definition": ("scenario_id",),
    "premium_input": ("cohort_id", "sex"),
    "assumption_version": ("assumption_type",),
}

# seriatim policy table used by the unit-factor path
POLICY_SCHEMA = _schema(
    ("policy_id", L), ("cohort_id", S), ("sex", S), ("issue_age", T.IntegerType()),
    ("term_years", T.IntegerType()), ("elapsed_duration_years", T.IntegerType()),
    ("sum_assured", L), ("policy_count", L))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's columns, cast to its types (missing columns become NULL)."""
    present = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _sql_literal(v, t: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {t.simpleString()})"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({v!r} AS {t.simpleString()})"


def literal_table(spark, rows, schema: T.StructType) -> DataFrame:
    """A small literal table as ``range(1)`` + ``inline`` of typed structs, built from one SQL
    expression: a deterministic plan (equal tables are semantically equal, so size checks on
    them are memoized) constructed with a single call to the JVM."""
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{f.name}', CAST({_sql_literal(v, f.dataType)} AS {f.dataType.simpleString()})"
                                    for v, f in zip(r, schema.fields)) + ")"
        for r in rows)
    return spark.range(1).select(F.expr(f"inline(array({structs}))"))
