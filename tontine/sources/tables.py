"""A1: the eight declared raw tables, read by name with their explicit schemas."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tontine.sources.fixtures import RawInputs
from tontine.sources.schemas import RAW_SCHEMAS, conform

RAW_TABLES = list(RAW_SCHEMAS)
log = logging.getLogger(__name__)


def _read(spark: SparkSession, name: str, location: str | None, database: str | None, fmt: str) -> DataFrame:
    if location:
        return spark.read.format(fmt).schema(RAW_SCHEMAS[name]).load(f"{location.rstrip('/')}/{name}")
    return conform(spark.table(f"{database}.{name}" if database else name), RAW_SCHEMAS[name])


def read_raw_tables(spark: SparkSession, location: str | None = None, database: str | None = None,
                    fmt: str = "parquet", premium: bool = True) -> RawInputs:
    """Read the raw tables from ``location/<name>`` (files) or ``database.<name>`` (catalog).
    ``premium=False`` (or a missing premium table) prices premiums from the other tables."""
    kw = {n: _read(spark, n, location, database, fmt) for n in RAW_TABLES if n != "premium_input"}
    prem = None
    if premium:
        try:
            prem = _read(spark, "premium_input", location, database, fmt)
            prem.schema  # noqa: B018  (resolve now: a missing table falls back to pricing)
        except AnalysisException as e:  # only an absent table; unreadable ones are errors
            if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
            log.warning("no premium_input table: premiums are priced from the other tables")
    return RawInputs(premium_input=prem, **kw)


def write_raw_tables(raw: RawInputs, location: str, fmt: str = "parquet") -> None:
    """Write the raw tables (premium_input only when present) under ``location/<name>``."""
    for name in RAW_TABLES:
        df = getattr(raw, name)
        if df is not None:
            conform(df, RAW_SCHEMAS[name]).write.format(fmt).mode("overwrite").save(f"{location.rstrip('/')}/{name}")
