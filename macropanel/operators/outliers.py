"""Outlier removal (O1-O4): per series, null values outside median +/- k*IQR.

Median averages the two middle values for an even count; the quartiles take
the value at the nearest rank. The band is inclusive and is fitted on every
row the panel holds at that point (the later tcode slice included).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from macropanel.functions.quantile import pick, quantile_rank, rank_columns, select_ranks
from macropanel.model import DATE, K, VALUE, nan_to_null

_STAT_COLS = ["_n", "_median", "_q25", "_q75"]


def with_series_stats(panel: DataFrame, method: str = "nearest") -> DataFrame:
    """Attach per-series n, median, q25, q75 to every row (windows only, no join)."""
    rank, n = rank_columns(K, VALUE)
    ranked = panel.select("*", rank.alias("_rk"), n.alias("_n"))
    w_all = Window.partitionBy(*K)
    rk, n = F.col("_rk"), F.col("_n")
    at = {
        "_m_lo": F.floor((n - 1) / 2).cast("long"),
        "_m_hi": F.ceil((n - 1) / 2).cast("long"),
        "_q25": quantile_rank(0.25, n, method),
        "_q75": quantile_rank(0.75, n, method),
    }
    picked = ranked.select("*", *[pick(rk, r, VALUE).over(w_all).alias(c) for c, r in at.items()])  # one window for all four
    return picked.select(*panel.columns, "_n", "_q25", "_q75", ((F.col("_m_lo") + F.col("_m_hi")) / 2).alias("_median"))


def _band(k: float):
    iqr = F.col("_q75") - F.col("_q25")
    return F.col("_median") - F.lit(k) * iqr, F.col("_median") + F.lit(k) * iqr


def remove_outliers(panel: DataFrame, k: float = 10.0, method: str = "nearest") -> DataFrame:
    """Same rows and columns; values outside the inclusive band become null."""
    lower, upper = _band(k)
    v = F.col(VALUE)
    cleaned = F.when((v >= lower) & (v <= upper), v)
    return with_series_stats(nan_to_null(panel), method).withColumn(VALUE, cleaned).drop(*_STAT_COLS)


def outlier_bounds(panel: DataFrame, k: float = 10.0, method: str = "nearest") -> DataFrame:
    """One row per series: n, median, q25, q75, lower, upper."""
    lower, upper = _band(k)
    stats = with_series_stats(nan_to_null(panel), method)
    return stats.groupBy(*K).agg(
        F.max("_n").cast("long").alias("n_obs"),
        F.max("_median").alias("median"),
        F.max("_q25").alias("q25"),
        F.max("_q75").alias("q75"),
        F.max(lower).alias("lower"),
        F.max(upper).alias("upper"),
    )


def long_series_stats(panel: DataFrame, method: str = "nearest") -> DataFrame:
    """One row per series: _n, _median, _q25, _q75, by passes over all partitions instead of one sort per series."""
    n = panel.groupBy(*K).agg(F.count(VALUE).alias("_n"))
    c = F.col("_n")
    ranks = F.create_map(
        *[x for name, r in (("m_lo", F.floor((c - 1) / 2)), ("m_hi", F.ceil((c - 1) / 2)), ("q25", quantile_rank(0.25, c, method)), ("q75", quantile_rank(0.75, c, method))) for x in (F.lit(name), r.cast("long"))]
    )
    targets = n.where("_n > 0").select(*K, F.explode(ranks).alias("target", "rank"))
    at = select_ranks(panel, targets, K, VALUE).groupBy(*K).agg(*[F.max(F.when(F.col("target") == t, F.col("picked"))).alias(f"_{t}") for t in ("m_lo", "m_hi", "q25", "q75")])
    return n.join(at, K, "left").select(*K, "_n", ((F.col("_m_lo") + F.col("_m_hi")) / 2).alias("_median"), "_q25", "_q75")


def remove_outliers_long(panel: DataFrame, k: float = 10.0, method: str = "nearest") -> DataFrame:
    """``remove_outliers`` for series too long for one task: same rows, columns and values.

    The band of a series is a row that joins its cells (broadcast while the planner knows it to be small).
    """
    panel = nan_to_null(panel)
    lower, upper = _band(k)
    v = F.col(VALUE)
    band = long_series_stats(panel, method).select(*K, lower.alias("_lower"), upper.alias("_upper"))
    kept = F.when((v >= F.col("_lower")) & (v <= F.col("_upper")), v)
    return panel.join(band, K, "left").withColumn(VALUE, kept).drop("_lower", "_upper")


def outlier_count(panel: DataFrame, k: float = 10.0) -> DataFrame:
    """Per series: how many non-null values the band nulls out."""
    before = panel.select(*K, DATE, F.col(VALUE).isNotNull().alias("_had"))
    after = remove_outliers(panel, k)
    return (
        after.join(before, K + [DATE])
        .groupBy(*K)
        .agg(F.count_if(F.col("_had") & F.col(VALUE).isNull()).cast("long").alias("n_outliers"))
    )
