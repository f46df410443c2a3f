"""Assumption builders (A8, A9) and wide-to-long loaders.

Loaders take already-read wide DataFrames (from csv/parquet/a catalog table): file parsing
itself is Spark's reader. Everything is a column expression; no Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.sources.schemas import RAW_SCHEMAS, conform, literal_table

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's):
#   lapse by policy duration year: 1 -> 0.15, 2 -> 0.13, 3 -> 0.11, 4 -> 0.09, 5 -> 0.08,
#   6..10 -> 0.06, 11..20 -> 0.03, 21 and later -> 0.02
#   scenarios (id, type, mortality x, lapse x, shift bps, group, description):
SCENARIO_ROWS = [
    ("BASE", "Base", 1.00, 1.00, 0, "Core", True, "Base scenario"),
    ("MORT_UP", "Mortality", 1.10, 1.00, 0, "Core", False, "Mortality +10%"),
    ("MORT_DOWN", "Mortality", 0.90, 1.00, 0, "Core", False, "Mortality -10%"),
    ("LAPSE_UP", "Lapse", 1.00, 1.10, 0, "Core", False, "Lapse +10%"),
    ("LAPSE_DOWN", "Lapse", 1.00, 0.90, 0, "Core", False, "Lapse -10%"),
    ("RATE_UP", "Discount", 1.00, 1.00, 50, "Core", False, "Discount +50bps"),
    ("RATE_DOWN", "Discount", 1.00, 1.00, -50, "Core", False, "Discount -50bps"),
    ("COMBINED_ADVERSE", "Combined", 1.10, 1.00, -50, "Advanced", False, "Mortality↑, Discount↓"),
    ("PERSIST_IMPROVE", "Lapse", 1.00, 0.70, 0, "Advanced", False, "Persistency improves (lapse -30%)"),
]
#   maintenance expense: 3 % of premium
EXPENSE_ROWS = [("maintenance", "premium", 0.03, "EXPENSE_V1", "3% maintenance expense on premium")]
# ---------------------------------------------------------------------------

LAPSE_VERSION = "LAPSE_V1"
VERSION_ROWS = [
    ("mortality", "M1", "Mortality basis M1", True),
    ("lapse", LAPSE_VERSION, "Lapse assumption v1", True),
    ("discount", "A", "Discount curve A", True),
    ("expense", "EXPENSE_V1", "Expense assumption v1", True),
    ("pricing", "PRICING_V1", "Pricing assumption v1", True),
]


def lapse_rate_rule(duration: F.Column) -> F.Column:
    """Step lapse rate by policy duration year (fixed values above)."""
    return (F.when(duration == 1, 0.15).when(duration == 2, 0.13).when(duration == 3, 0.11)
            .when(duration == 4, 0.09).when(duration == 5, 0.08)
            .when(duration.between(6, 10), 0.06).when(duration.between(11, 20), 0.03)
            .otherwise(0.02))


def lapse_curve(spark: SparkSession, max_duration: int = 30, version_id: str = LAPSE_VERSION) -> DataFrame:
    """Rule-generated lapse table, durations 1..max_duration."""
    d = F.col("id")
    return conform(spark.range(1, max_duration + 1).select(
        d.alias("duration_year"), lapse_rate_rule(d).alias("lapse_rate_annual"),
        F.lit(version_id).alias("version_id")), RAW_SCHEMAS["lapse_assumption"])


def scenario_table(spark: SparkSession, rows: Sequence[tuple] = tuple(SCENARIO_ROWS)) -> DataFrame:
    """Stress scenario definitions with an explicit schema."""
    return literal_table(spark, rows, RAW_SCHEMAS["stress_scenario_definition"])


def expense_table(spark: SparkSession, rows: Sequence[tuple] = tuple(EXPENSE_ROWS)) -> DataFrame:
    return literal_table(spark, rows, RAW_SCHEMAS["expense_assumption"])


def version_table(spark: SparkSession, rows: Sequence[tuple] = tuple(VERSION_ROWS)) -> DataFrame:
    return literal_table(spark, rows, RAW_SCHEMAS["assumption_version"])


# --------------------------------------------------------------------------- loaders

def _age_from_label(label: F.Column) -> F.Column:
    """Leading integer of an age label: '35' -> 35, '110+' -> 110, '2 ans' -> 2."""
    return F.regexp_extract(F.trim(label.cast("string")), r"^(\d+)", 1).cast("long")


def load_mortality_wide_sex(wide: DataFrame, source: str = "HMD",
                            value_cols: Sequence[str] = ("female", "male", "total")) -> DataFrame:
    """A2: (year, age, female, male, total) with q already annual -> long rows.

    sex is the upper-cased first letter of the column name (F, M, T). The age label is parsed
    as an integer with any '+' dropped (the reference's 100+age rule for two-digit labels is a
    known defect and is not reproduced).
    """
    long = wide.unpivot(["year", "age"], list(value_cols), "sex_name", "qx_annual")
    return long.select(
        F.col("year").cast("long").alias("year"),
        _age_from_label(F.col("age")).alias("age"),
        F.upper(F.substring("sex_name", 1, 1)).alias("sex"),
        F.col("qx_annual").cast("double").alias("qx_annual"),
        F.lit(source).alias("source"))


def load_mortality_wide_age(wide: DataFrame, sex: str, source: str = "INSEE",
                            year_col: str | None = None, per: float = 100000.0) -> DataFrame:
    """A3: one column per age label ('0 an', '1 an', '2 ans', ..., '110+') holding deaths per
    ``per`` lives -> long (year, age, sex, qx_annual = deaths / per, source)."""
    year_col = year_col or wide.columns[0]
    age_cols = [c for c in wide.columns if c != year_col]
    long = wide.withColumnRenamed(year_col, "year").unpivot(
        ["year"], age_cols, "age_label", "deaths_per_unit")
    age = F.regexp_replace(F.regexp_replace(F.col("age_label"), r" ans?$", ""), r"\+", "")
    return long.select(
        F.col("year").cast("long").alias("year"), age.cast("long").alias("age"),
        F.lit(sex).alias("sex"), (F.col("deaths_per_unit").cast("double") / F.lit(per)).alias("qx_annual"),
        F.lit(source).alias("source"))


def mortality_versioning(parts: Iterable[DataFrame], default_version: str, override_version: str,
                         override_source: str = "INSEE", override_year: int = 2019) -> DataFrame:
    """A4: union the loaded sources; tag a default version, overridden for one source-year."""
    parts = list(parts)
    allrows = parts[0]
    for p in parts[1:]:
        allrows = allrows.unionByName(p)
    version = F.when((F.col("source") == override_source) & (F.col("year") == override_year),
                     F.lit(override_version)).otherwise(F.lit(default_version))
    return conform(allrows.withColumn("version_id", version), RAW_SCHEMAS["mortality_assumption"])


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("year", "age", "sex", "source")) -> DataFrame:
    """A5: key combinations occurring more than once (partial aggregation absorbs hot keys)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def load_curve_sheet(sheet: DataFrame, version_id: str, tenor_col: str | None = None,
                     rate_col: str | None = None) -> DataFrame:
    """A6 (one sheet): keep rows whose tenor label is all digits; tenor_month = 12 * years."""
    tenor_col = tenor_col or sheet.columns[1]
    rate_col = rate_col or sheet.columns[2]
    tenor = F.trim(F.col(tenor_col).cast("string"))
    return (sheet.filter(tenor.rlike(r"^[0-9]+$"))
            .select((tenor.cast("long") * 12).alias("tenor_month"),
                    F.col(rate_col).cast("double").alias("zero_rate_annual"),
                    F.lit(version_id).alias("version_id")))


def load_curves(sheets: Iterable[tuple[DataFrame, str]], **kw) -> DataFrame:
    """Union of several curve sheets, each tagged with its version id."""
    out = None
    for sheet, version in sheets:
        one = load_curve_sheet(sheet, version, **kw)
        out = one if out is None else out.unionByName(one)
    return out


def curve_profile(curve: DataFrame) -> DataFrame:
    """Row count per curve version and the number of distinct versions loaded."""
    n_versions = curve.select(F.countDistinct("version_id")).scalar()
    return (curve.groupBy("version_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("n_versions", n_versions))
