"""Sinks (A10-A13): managed/path tables, schema setup, CSV report export.

Writes are distributed (executors write their partitions); nothing is collected to the
driver. Delta is not bundled here, so the format is a parameter (parquet by default).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def ensure_schema(spark: SparkSession, schema: str) -> list[str]:
    """Create the schema if missing (never drops anything) and list its tables."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    return [t.name for t in spark.catalog.listTables(schema)]


def write_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet",
                mode: str = "overwrite", partition_by: Sequence[str] = (), overwrite_schema: bool = False) -> None:
    """Overwrite a table, by path or as a managed catalog table, optionally
    partitioned (marts by version_id, mort_version_id: readers pruning on a curve or a
    mortality basis read only its folders)."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if overwrite_schema:
        w = w.option("overwriteSchema", "true")
    if path:
        w.save(path)
    else:
        w.saveAsTable(name)


def export_ordered(df: DataFrame, path: str, max_records: int = 0) -> None:
    """A13 for reports of any size: the rows of an ordered DataFrame as CSV part files whose names sort
    in the order of the rows. An ``orderBy`` range-partitions the rows and a task writes its range as
    files numbered by partition, so reading the files by name gives the ORDER BY rows and no
    task ever holds more than its range. ``max_records`` starts a new file every so many rows."""
    w = df.write.mode("overwrite").option("header", "true")
    if max_records:
        w = w.option("maxRecordsPerFile", str(max_records))
    w.csv(path)


def export_csv(reports: Mapping[str, DataFrame], folder: str, single_file: bool = False) -> None:
    """One CSV folder per report with a header, part files in the report's order. ``single_file``
    coalesces each to one partition on an executor; leave it off for reports that grow with the book."""
    for name, df in reports.items():
        export_ordered(df.coalesce(1) if single_file else df, f"{folder}/{name}")
