"""SparkSession helpers: local sessions for tests/bench, and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName("macropanel")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("MACROPANEL_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, taking it from the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder. Only a local
    master (tests, bench) falls back to a fresh folder under the temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="macropanel-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder shared by all executors")


def write_faults(faults: DataFrame, name: str) -> str:
    """Write rows that an error is about as a table of the checkpoint folder; its path."""
    path = f"{ensure_checkpoint_dir(faults.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    faults.write.parquet(path)
    return path


def told(faults: DataFrame, name: str, column: str, most: int = 20) -> str | None:
    """The first values of ``column`` in order, how many rows there are, and where all of them are; None if there is none."""
    if faults.isEmpty():
        return None
    path = write_faults(faults, name)
    written = faults.sparkSession.read.schema(faults.schema).parquet(path)
    n = written.count()
    first = [str(r[0]) for r in written.select(column).orderBy(column).limit(most).collect()]
    return ", ".join(first) + (f" and {n - most} more" if n > most else "") + f" (all in {path})"
