"""Helpers shared by the operators: tables, written stage boundaries, distributed prefix sums."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def tidy() -> None:
    """Give back what a finished task held: workers are reused, and Arrow's pool and the C heap
    keep freed memory otherwise."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidied(run: Callable) -> Callable:
    """A batch function that tidies up when its partition is done."""
    def tidy_run(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            tidy()
    return tidy_run


def in_parts(run: Callable, rows: int = 512) -> Callable:
    """A batch function over slices of the batches, so that what it makes of one stays small."""
    return lambda batches: run(b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this library to the executors through Spark, once an application, so that tasks can
    import it wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        path = Path(tempfile.mkdtemp(prefix="tontine-ship-")) / "tontine.zip"  # the driver's own copy
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted((root / "tontine").rglob("*.py")):
                z.write(f, f.relative_to(root))
        spark.sparkContext.addPyFile(str(path))
        _SHIPPED.add(app)


def on_workers(query: Callable) -> Callable:
    """``query`` with the library shipped first; its first argument is the session."""
    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        ship_package(spark)
        return query(spark, *args)
    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``. Only a local
    master (one machine, as in tests) may do without the setting."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tontine-llm-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tontine-llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts the lineage,
    survives lost executors, keeps column pruning and size statistics. ``by`` names columns whose
    values get folders of their own."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str):
    """The (pyarrow) file system of a path or URI, and the path in it."""
    import pyarrow.fs as pafs
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def range_prefix(df: DataFrame, order: list[str], value: str, out: str, parts: int, name: str,
                 rank: str | None = None) -> DataFrame:
    """Running sum of ``value`` (inclusive) over the total order ``order`` without a global
    window: range-sort into partitions, write, sum each partition, add the sums before it.

    ``order`` must name every column that tells rows apart (fully tied rows are alike, so their
    order does not matter). ``rank`` adds a 1-based position. The table of partition sums has
    ``parts`` rows at most.
    """
    cols = df.columns
    laid = materialize(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), name)
    sums = laid.groupBy("__part").agg(F.sum(value).alias("__sum"), F.count(F.lit(1)).alias("__cnt"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"),
                       F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__rows"))
    w = Window.partitionBy("__part").orderBy(*order)
    got = laid.join(F.broadcast(base), "__part")  # at most `parts` rows
    got = got.withColumn(out, F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.col("__base"))
    if rank:
        got = got.withColumn(rank, F.row_number().over(w) + F.col("__rows"))
    return got.select(*cols, out, *([rank] if rank else []))
