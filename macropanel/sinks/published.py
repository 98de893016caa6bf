"""Runs that are taken whole or not at all.

``publish`` writes a run's artifacts into a folder of its own, ``<out>/runs/<run>``, and a new catalog that says which
run holds each (panel, year, month): the catalog before, less what this run replaces, and this run. Nobody reads either
before the name in ``<out>/CURRENT`` is switched, by one rename, as the last act; a run that fails before leaves the
previous one as it was, and files that nothing refers to. A reader resolves ``CURRENT`` once, so what it reads is of one
catalog. A publisher that finds ``CURRENT`` switched meanwhile merges its catalog again.

The rename replaces its target in one step on file systems that do so (HDFS, local); on a store without such a rename
``CURRENT`` is one small object whose write is atomic by itself.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macropanel.model import PANEL
from macropanel.plans.prepare import Prepared, write_all
from macropanel.sinks.artifacts import run_stamp
from macropanel.sinks.digest import DIGITS, table_digest

POINTER = "CURRENT"
CATALOG = f"{PANEL} string, year string, month string, run string"
JSON = ("imputation", "summary")


class _Folder:
    """The few file-system calls that publishing needs, by Hadoop's own client."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = path.rstrip("/")
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readNBytes(4096)).decode().strip()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write beside, then rename over: readers see the old text or the new one."""
        beside = f".{name}-{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(beside), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(self._path(beside), self._path(name), options)


def current(spark: SparkSession, out: str) -> str | None:
    """The name of the catalog that readers use, None before the first run."""
    return _Folder(spark, out).read(POINTER)


def catalog(spark: SparkSession, out: str, name: str | None = None) -> DataFrame:
    """panel_id, year, month, run of the catalog named, by default the current one."""
    name = name or current(spark, out)
    if name is None:
        return spark.createDataFrame([], CATALOG)
    return spark.read.schema(CATALOG).parquet(f"{out.rstrip('/')}/catalogs/{name}")


def publish(p: Prepared, out: str, now: datetime | None = None) -> str:
    """Write the artifacts as a run, then switch to it; the run's name."""
    spark, out = p.raw.sparkSession, out.rstrip("/")
    year, month, stamp = run_stamp(now)
    run = f"{stamp[:19].replace(':', '')}-{uuid.uuid4().hex[:12]}"
    write_all(p, f"{out}/runs/{run}", now)
    mine = p.report.select(PANEL, F.lit(year).alias("year"), F.lit(month).alias("month"), F.lit(run).alias("run"))
    folder = _Folder(spark, out)
    while True:
        before = current(spark, out)
        name = f"{run}-{uuid.uuid4().hex[:6]}"
        kept = catalog(spark, out, before).join(mine, [PANEL, "year", "month"], "left_anti")
        kept.unionByName(mine).coalesce(1).write.parquet(f"{out}/catalogs/{name}")
        if current(spark, out) == before:
            folder.replace(POINTER, name)
            return run


def read_published(spark: SparkSession, out: str, artifact: str, catalog_name: str | None = None) -> DataFrame:
    """An artifact's rows as the catalog has them, with panel_id, year, month and run."""
    out = out.rstrip("/")
    named = catalog(spark, out, catalog_name).cache()
    folder = _Folder(spark, out)
    runs = [r.run for r in named.select("run").distinct().toLocalIterator()]
    # a run without a balanced series has no balanced artifacts
    runs = [r for r in runs if folder.exists(f"runs/{r}/{artifact}")]
    if not runs:
        raise ValueError(f"no published run has artifact {artifact}")
    reader = spark.read.json if artifact in JSON else spark.read.parquet
    parts = [reader(f"{out}/runs/{r}/{artifact}").withColumn("run", F.lit(r)) for r in sorted(runs)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    kind = {c: F.col(c).cast("string") for c in (PANEL,)}
    kind |= {"year": F.lpad(F.col("year").cast("string"), 4, "0"), "month": F.lpad(F.col("month").cast("string"), 2, "0")}
    return rows.withColumns(kind).join(named, [PANEL, "year", "month", "run"], "left_semi")


def published_digests(spark: SparkSession, out: str, artifacts: list[str], digits: int = DIGITS) -> DataFrame:
    """panel_id, artifact, n_rows, digest_a, digest_b of artifacts read back, over all columns but the run's."""
    name, parts = current(spark, out), None
    for artifact in artifacts:
        rows = read_published(spark, out, artifact, name).drop("year", "month", "run")
        part = table_digest(rows, [PANEL], digits).withColumn("artifact", F.lit(artifact))
        parts = part if parts is None else parts.unionByName(part)
    return parts
