"""Incremental vintage ingest (X1): prepare each newly landed vintage file once.

A file stream over the landing folder (whole text per file) feeds
``foreachBatch``: each micro-batch holds the vintages that landed since the
last one, parses them, prepares every vintage as its own panel and writes
the artifacts under ``panel_id=<vintage>``. The stream checkpoint records
which files were taken, so a restart (or a lost executor mid-batch: the batch
is simply re-run, and the dynamic partition overwrite makes that idempotent)
neither skips nor repeats a vintage. A revised vintage is a new file, so no
watermark or state is needed.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from macropanel.model import PANEL, Params
from macropanel.plans.prepare import prepare, write_all
from macropanel.session import ensure_checkpoint_dir
from macropanel.sources.vintage import VINTAGE_PATTERN, file_faults, listing, parse_lines, refuse, split_lines


def vintage_files_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``(panel_id, path, value)`` per landed file; panel_id is empty where the name names no vintage."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(landing)
    return files.select(F.regexp_extract("path", VINTAGE_PATTERN, 1).alias(PANEL), "path", F.col("content").cast("string").alias("value"))


QUARANTINE = f"{PANEL} string, path string, reason string, epoch long"


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """``(panel_id, path, reason, epoch)`` of all files set aside so far."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], QUARANTINE)
    return spark.read.schema(QUARANTINE).parquet(path)


def start_vintage_stream(
    spark: SparkSession,
    landing: str,
    out_dir: str,
    checkpoint_location: str,
    params: Params = Params(),
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    started: datetime | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Prepare each newly landed vintage once.

    Without ``quarantine`` a file without a vintage in its name, or without content, fails its batch by name. With it, a
    file that cannot be a vintage (``file_faults``, or of no length) becomes a row ``(panel_id, path, reason)`` of that
    table, partitioned by epoch, and the batch's other files go on; such a file is set aside once.

    The partition of an epoch is fixed when it is first tried: its time is written next to the stream's
    checkpoint, so a retry after the end of the month replaces what the first attempt wrote.
    """

    def stamp(epoch_id: int) -> datetime:
        path = f"{checkpoint_location.rstrip('/')}-epochs/{epoch_id}"
        now = (started or datetime.now(tz=timezone.utc)).isoformat()
        spark.range(1).select(F.lit(now).alias("value")).coalesce(1).write.mode("ignore").text(path)
        return datetime.fromisoformat(spark.read.text(path).first()["value"])

    def set_aside(landed: DataFrame, epoch_id: int) -> DataFrame:
        """The batch without its bad files, which are in the quarantine table then."""
        bad = file_faults(landed)
        # the source does not hand on files of no length; those that no earlier epoch has set aside belong to this one
        empty = spark.createDataFrame([(f,) for f, size in listing(spark, landing) if size == 0], "path string")
        empty = empty.select(F.regexp_extract("path", VINTAGE_PATTERN, 1).alias(PANEL), "path", F.lit("empty vintage file").alias("reason"))
        before = read_quarantine(spark, quarantine).where(F.col("epoch") < epoch_id)
        rows = bad.unionByName(empty.join(before, "path", "left_anti")).withColumn("epoch", F.lit(epoch_id).cast("long"))
        rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(quarantine)
        return landed.join(read_quarantine(spark, quarantine).where(F.col("epoch") == epoch_id), "path", "left_anti")

    def process(batch: DataFrame, epoch_id: int) -> None:
        now = stamp(epoch_id)
        if quarantine:
            good = set_aside(batch.checkpoint(eager=True), epoch_id).checkpoint(eager=True)
            if not good.isEmpty():
                write_all(prepare(*parse_lines(split_lines(good.select(PANEL, "value")), params.date_floor), params), out_dir, now)
            return
        # file sources pass over files of no length: those are found in the folder's listing
        refuse([f for f, size in listing(spark, landing) if size == 0], "empty vintage file")
        landed = batch.checkpoint(eager=True)  # the files are read once
        refuse([r["path"] for r in landed.where(F.col(PANEL) == "").select("path").collect()], "file name without a vintage")
        if landed.isEmpty():
            return
        panel, series = parse_lines(split_lines(landed.select(PANEL, "value")), params.date_floor)
        write_all(prepare(panel, series, params), out_dir, now)

    ensure_checkpoint_dir(spark)
    stream = vintage_files_stream(spark, landing, max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
