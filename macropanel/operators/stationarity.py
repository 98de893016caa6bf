"""Stationarity transforms (T1-T10) and the leading-missing flag.

All seven codes share four lags (of the level and of its log) over one window
per series ordered by date, so one exchange + one sort + one Window operator
serve every code. A difference with a null on either side is null (no
skipping). The first two panel rows are dropped *after* the lags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macropanel.model import DATE, K, VALUE
from macropanel.session import write_faults

TCODES = (1, 2, 3, 4, 5, 6, 7)
#: Unknown codes, and series of each, that an error names.
NAMED = 20


def series_window():
    return Window.partitionBy(*K).orderBy(DATE)


def tcode_value(tcode: Column, v: Column, l1: Column, l2: Column, lv: Column, ll1: Column, ll2: Column) -> Column:
    """CASE over the code; no code passes the level through; others raise when evaluated."""
    pct = v / F.nullif(l1, F.lit(0.0)) - 1.0
    pct_prev = l1 / F.nullif(l2, F.lit(0.0)) - 1.0
    return (
        F.when(tcode.isNull(), v)
        .when(tcode == 1, v)
        .when(tcode == 2, v - l1)
        .when(tcode == 3, (v - l1) - (l1 - l2))
        .when(tcode == 4, lv)
        .when(tcode == 5, lv - ll1)
        .when(tcode == 6, (lv - ll1) - (ll1 - ll2))
        .when(tcode == 7, pct - pct_prev)
        .otherwise(
            F.raise_error(F.concat(F.lit("unknown tcode: "), tcode.cast("string"), F.lit(" (series: "), F.col("series_id"), F.lit(")")))
        )
        .cast("double")
    )


def unknown_tcodes(series: DataFrame) -> DataFrame:
    """The rows of the series dimension whose code is none of the seven."""
    return series.where(F.col("tcode").isNotNull() & ~F.col("tcode").isin(*TCODES))


def check_tcodes(series: DataFrame) -> None:
    """Unknown codes raise before any transform: each code with its number of series and the first of them, and a table of all."""
    bad = unknown_tcodes(series)
    by = bad.groupBy("tcode").agg(F.count(F.lit(1)).alias("n"))
    first = bad.withColumn("k", F.row_number().over(Window.partitionBy("tcode").orderBy("series_id"))).where(F.col("k") <= NAMED)
    first = first.groupBy("tcode").agg(F.array_join(F.sort_array(F.collect_set("series_id")), ", ").alias("ids"))
    found = sorted((r["tcode"], r["n"], r["ids"]) for r in by.join(first, "tcode").orderBy("tcode").limit(NAMED).collect())
    if found:
        path = write_faults(bad, "unknown-tcodes")
        shown = "; ".join(f"unknown tcode: {c} ({n} series: {ids}{', ...' if n > NAMED else ''})" for c, n, ids in found)
        raise ValueError(f"{shown} (all in {path})")


def apply_tcode(panel: DataFrame, tcode: Column, slice_rows: int = 0) -> DataFrame:
    """Transform ``value`` by ``tcode`` (a column or literal). Optionally drop the first rows."""
    w = series_window()
    v = F.col(VALUE)
    lv = F.when(v > 0, F.ln(v))
    staged = panel.select("*", lv.alias("_lv"))
    l1, l2 = F.lag(VALUE, 1).over(w), F.lag(VALUE, 2).over(w)
    ll1, ll2 = F.lag("_lv", 1).over(w), F.lag("_lv", 2).over(w)
    out = staged.withColumn("_rn", F.row_number().over(w)).withColumn(
        VALUE, tcode_value(tcode, v, l1, l2, F.col("_lv"), ll1, ll2)
    )
    if slice_rows:
        # per-series row number == panel row number because panels are dense (one row per month)
        out = out.where(F.col("_rn") > slice_rows)
    return out.drop("_lv", "_rn")


def transform_all(panel: DataFrame, series: DataFrame, check: bool = True) -> DataFrame:
    """Dispatch each series to its code (T9), then drop the first two rows.

    Series missing from ``series`` pass through untransformed.
    """
    if check:
        check_tcodes(series)
    codes = series.select(*K, "tcode")
    cols = panel.columns
    joined = panel.join(codes, K, "left")
    return apply_tcode(joined, F.col("tcode"), slice_rows=2).select(*cols)


def with_leading_flag(transformed: DataFrame) -> DataFrame:
    """``leading`` = no observation yet in this series up to and including this row.

    Uses the same window spec as the lags, so it needs no new exchange or sort.
    """
    running = F.count(VALUE).over(series_window().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return transformed.withColumn("leading", running == 0)
