"""Sinks (W1-W7): partitioned zstd Parquet artifacts, JSON report, manifest, run summary.

Layout: ``<out>/<artifact>/panel_id=.../year=YYYY/month=MM/part-*.parquet``,
year/month from the run time (UTC). Dynamic partition overwrite replaces only
the partitions a run writes, so re-running a month (or a retried job) is
idempotent.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macropanel.model import DATE, PANEL, SERIES
from macropanel.sinks.digest import digest_columns, row_text


def run_stamp(now: datetime | None = None) -> tuple[str, str, str]:
    now = now or datetime.now(tz=timezone.utc)
    return now.strftime("%Y"), now.strftime("%m"), now.isoformat()


#: Series that one task writes of a panel: a large panel is dealt over several files, a small one is one file.
SERIES_SALTS = 8


def _clustered(df: DataFrame) -> DataFrame:
    """Rows of a panel in few tasks, so that a partition gets few files; a large panel is split by series."""
    key = [F.pmod(F.xxhash64(SERIES), F.lit(SERIES_SALTS))] if SERIES in df.columns else []
    return df.repartition(PANEL, *key)


def write_parquet(df: DataFrame, path: str, year: str, month: str) -> None:
    (
        _clustered(df).withColumn("year", F.lit(year))
        .withColumn("month", F.lit(month))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(PANEL, "year", "month")
        .parquet(path)
    )


def write_json(df: DataFrame, path: str, year: str, month: str) -> None:
    (
        df.withColumn("year", F.lit(year))
        .withColumn("month", F.lit(month))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PANEL, "year", "month")
        .json(path)
    )


def manifest_counts(name: str, df: DataFrame, digits: int | None = None) -> DataFrame:
    """Per panel: rows, series, first/last date as ``MM/yyyy``; with ``digits`` the content digest at that precision (the SQL-checkable part)."""
    has_date = DATE in df.columns
    content = [] if digits is None else digest_columns(row_text(df, digits))
    return df.groupBy(PANEL).agg(
        F.lit(name).alias("artifact"),
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.countDistinct(SERIES).cast("long").alias("n_series"),
        (F.date_format(F.min(DATE), "MM/yyyy") if has_date else F.lit(None).cast("string")).alias("date_first"),
        (F.date_format(F.max(DATE), "MM/yyyy") if has_date else F.lit(None).cast("string")).alias("date_last"),
        *content,
    )


def manifest(name: str, df: DataFrame, written_at: str, extraction_ts: str) -> DataFrame:
    """Counts plus an order-free content checksum (``digest``: sums of MD5 halves over the multiset of rows), one aggregate.

    The checksum is the same whatever the partitioning or row order and merges
    like any partial aggregate.
    """
    has_date = DATE in df.columns
    a, b = digest_columns(row_text(df))
    return df.groupBy(PANEL).agg(
        F.lit(name).alias("artifact"),
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.countDistinct(SERIES).cast("long").alias("n_series"),
        (F.date_format(F.min(DATE), "MM/yyyy") if has_date else F.lit(None).cast("string")).alias("date_first"),
        (F.date_format(F.max(DATE), "MM/yyyy") if has_date else F.lit(None).cast("string")).alias("date_last"),
        F.concat_ws("-", a, b).alias("checksum"),
        F.lit(written_at).alias("written_at"),
        F.lit(extraction_ts).alias("extraction_ts"),
    )


def run_summary(
    report: DataFrame, balanced: DataFrame, transformed: DataFrame | None, series: DataFrame, version: str, counts: DataFrame | None = None
) -> DataFrame:
    """One row per panel: rows, series in/kept/dropped, balanced count, fractions, EM outcome.

    ``counts`` (per-series counts with ``n_rows``) may replace the panel.
    """
    per_series = counts if counts is not None else transformed.groupBy(PANEL, SERIES).agg(F.count(F.lit(1)).alias("n_rows"))
    rows = per_series.groupBy(PANEL).agg(F.max("n_rows").cast("long").alias("rows"))
    n_in = series.groupBy(PANEL).agg(F.count(F.lit(1)).cast("long").alias("series_input"))
    n_bal = balanced.groupBy(PANEL).agg(F.count(F.lit(1)).cast("long").alias("balanced_n_series"))
    cols = [
        PANEL,
        "rows",
        "series_input",
        F.col("n_kept").cast("long").alias("series_kept"),
        F.col("n_dropped").cast("long").alias("series_dropped"),
        F.coalesce("balanced_n_series", F.lit(0)).cast("long").alias("balanced_n_series"),
        "frac_imputed",
        "frac_imputed_leading",
        "frac_imputed_internal",
    ]
    if "n_iter" in report.columns:
        cols += [F.col("n_iter").alias("em_iter"), F.col("converged").alias("em_converged"), F.lit(version).alias("pipeline_version")]
    return report.join(rows, PANEL, "left").join(n_in, PANEL, "left").join(n_bal, PANEL, "left").select(*cols)
