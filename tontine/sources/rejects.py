"""Loaders with a reject channel (A2, A3, A6): every input row is loaded or rejected with a reason.

Sheets are read as text; a row goes through ordered rules, the first that it breaks is its reason.
Values are converted with ``try_cast``, so one bad cell never stops a load or turns into a silent
null. ``read_csv`` adds what the CSV reader itself cannot parse (PERMISSIVE mode with a corrupt
record column). Nothing is collected: loaded and rejected rows are two views of one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


@dataclass
class Loaded:
    """``loaded`` rows, and ``rejected (record, reason)``, the row's cells joined by ``|`` (a null cell
    is left out)."""
    loaded: DataFrame
    rejected: DataFrame


def split(rows: DataFrame, cells: Sequence[str], rules: Sequence[tuple[str, Column]], columns: Sequence[Column]) -> Loaded:
    """``rules`` are (reason, condition that a good row meets); null conditions count as broken."""
    reason = F.lit(None).cast("string")
    for name, good in reversed(rules):
        reason = F.when(~F.coalesce(good, F.lit(False)), F.lit(name)).otherwise(reason)
    tagged = rows.withColumn("__reason", reason)
    record = F.concat_ws("|", *[F.col(c).cast("string") for c in cells])
    return Loaded(tagged.where("__reason is null").select(*columns),
                  tagged.where("__reason is not null").select(record.alias("record"), F.col("__reason").alias("reason")))


def leading_age(label: Column) -> Column:
    """35 of '35', '35 ans', '110+'; null when the label does not start with a number."""
    return F.regexp_extract(F.trim(label), r"^(\d+)", 1).try_cast("long")


def _rate(cell: Column) -> Column:
    return cell.try_cast("double")


def _is_rate(cell: Column, low: float, high: float) -> Column:
    v = _rate(cell)
    return v.isNotNull() & ~F.isnan(v) & (v >= low) & (v <= high)


def mortality_by_sex(sheet: DataFrame, source: str, value_cols: Sequence[str] = ("female", "male", "total")) -> Loaded:
    """A2 over text cells: ``(year, age, female, male, total)`` -> one row per cell."""
    long = sheet.select(*[F.col(c).cast("string").alias(c) for c in ("year", "age", *value_cols)]).unpivot(["year", "age"], list(value_cols), "name", "rate")
    long = long.withColumn("sex", F.upper(F.substring("name", 1, 1)))
    rules = [("year", F.col("year").try_cast("long").isNotNull()), ("age", leading_age(F.col("age")).between(0, 150)), ("rate", _is_rate(F.col("rate"), 0.0, 1.0))]
    return split(long, ("year", "age", "sex", "rate"), rules, [F.col("year").try_cast("long").alias("year"), leading_age(F.col("age")).alias("age"), "sex",
                                                               _rate(F.col("rate")).alias("qx_annual"), F.lit(source).alias("source")])


def mortality_by_age(sheet: DataFrame, sex: str, source: str, per: float = 100000.0) -> Loaded:
    """A3 over text cells: a year column, then one column per age label, deaths per ``per`` lives."""
    year, *ages = sheet.columns
    long = sheet.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in sheet.columns]).unpivot([F.col(f"`{year}`")], [F.col(f"`{a}`") for a in ages], "age", "deaths")
    long = long.withColumnRenamed(year, "year")
    rules = [("year", F.col("year").try_cast("long").isNotNull()), ("age", leading_age(F.col("age")).between(0, 150)), ("rate", _is_rate(F.col("deaths"), 0.0, per))]
    return split(long, ("year", "age", "deaths"), rules, [F.col("year").try_cast("long").alias("year"), leading_age(F.col("age")).alias("age"), F.lit(sex).alias("sex"),
                                                          (_rate(F.col("deaths")) / F.lit(per)).alias("qx_annual"), F.lit(source).alias("source")])


def curve_points(sheet: DataFrame) -> Loaded:
    """A6 over text cells: ``(tenor in years, rate, version_id)`` -> curve points by month."""
    rows = sheet.select(*[F.col(c).cast("string").alias(c) for c in ("tenor", "rate", "version_id")])
    rules = [("version", F.length(F.trim("version_id")) > 0), ("tenor", F.col("tenor").try_cast("long") >= 1), ("rate", _is_rate(F.col("rate"), -0.99, 1.0))]
    return split(rows, ("tenor", "rate", "version_id"), rules, [(F.col("tenor").try_cast("long") * 12).alias("tenor_month"), _rate(F.col("rate")).alias("zero_rate_annual"), "version_id"])


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], **options) -> tuple[DataFrame, DataFrame]:
    """(rows of text cells, rejected records) of CSV files: a line with more or fewer cells than
    ``columns`` is rejected as it stands."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, CORRUPT)])
    # no column pruning: a line is judged by all its cells, whatever a query reads
    read = spark.read.options(header="true", columnPruning="false", **options).schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    reason = F.when(F.col(columns[-1]).isNull(), F.lit("too few cells")).otherwise(F.lit("too many cells"))
    bad = read.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"), reason.alias("reason"))
    return read.where(F.col(CORRUPT).isNull()).select(*columns), bad
