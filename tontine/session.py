"""Session helpers for tests and the bench (a cluster job gets its session from the launcher)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "tontine",
                  driver_memory: str = "8g") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (SparkSession.builder.master(master).appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             # remove checkpoint files once the checkpointed data is no longer referenced
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .config("spark.driver.memory", driver_memory)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_READY: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; where it is unset, only a local
    master (one machine, as in tests) may fall back to a scratch folder. Idempotent per application."""
    app = spark.sparkContext.applicationId
    if app in _READY:
        return _READY[app]
    d = spark.sparkContext._jsc.sc().getCheckpointDir()
    d = d.get() if d.isDefined() else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not d:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="tontine-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    _READY[app] = d
    return d


def drop_unused_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a plan once the driver has collected it as garbage, which a
    driver with room to spare may put off for long: collect now, before the next large shuffle."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def boundary_path(spark: SparkSession, name: str = "boundary") -> str:
    """A fresh folder under the shared checkpoint directory for a written stage boundary."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tontine-tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
