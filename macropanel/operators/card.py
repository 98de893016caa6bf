"""Per-series data card (D1-D5), kept/dropped selection (I2), balanced subpanel.

Everything is one ``groupBy(panel_id, series_id)`` over the transformed,
pre-imputation panel carrying the ``leading`` flag. That input is already
hash-partitioned by the same key (from the lag window), so the aggregate adds
no exchange.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macropanel.model import DATE, K, PANEL, SERIES, VALUE, require_columns
from macropanel.operators.stationarity import with_leading_flag


def series_counts(transformed: DataFrame) -> DataFrame:
    """Per series: T, n_obs, leading, internal, first/last observation date."""
    require_columns(transformed, [PANEL, SERIES, DATE, VALUE])
    flagged = transformed if "leading" in transformed.columns else with_leading_flag(transformed)
    miss = F.col(VALUE).isNull()
    obs_date = F.when(~miss, F.col(DATE))
    return flagged.groupBy(*K).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.count(VALUE).cast("long").alias("n_obs"),
        F.count_if(miss & F.col("leading")).cast("long").alias("n_missing_leading"),
        F.count_if(miss & ~F.col("leading")).cast("long").alias("n_missing_internal"),
        F.min(obs_date).alias("first_obs_date"),
        F.max(obs_date).alias("last_obs_date"),
    )


def kept_flag(n_missing: F.Column, n_rows: F.Column, max_missing_frac: float) -> F.Column:
    # inclusive threshold on the unrounded fraction
    return (n_missing / F.greatest(n_rows, F.lit(1))) <= F.lit(float(max_missing_frac))


def build_data_card(
    transformed: DataFrame | None,
    series: DataFrame | None = None,
    max_missing_frac: float = 0.5,
    counts: DataFrame | None = None,
    kept: DataFrame | None = None,
    dropped: DataFrame | None = None,
) -> DataFrame:
    """One row per series present in the panel (and listed in ``series`` if given; its ``pos`` comes along).

    ``counts`` (the output of ``series_counts``) may be given instead of the panel. ``kept`` and ``dropped``
    (panel_id, series_id) are a caller's own selection: a series in neither is ``not_in_panel``. Without them
    the missing fraction decides.
    """
    c = counts if counts is not None else series_counts(transformed)
    order = [x for x in ("pos",) if series is not None and x in series.columns]
    if series is not None:
        c = c.join(series.select(*K, *order), K)
    t = F.greatest(F.col("n_rows"), F.lit(1))
    n_missing = F.col("n_missing_leading") + F.col("n_missing_internal")
    over = F.lit(f"missing_frac>{max_missing_frac}")
    if kept is None and dropped is None:
        keep = kept_flag(n_missing, F.col("n_rows"), max_missing_frac)
        reason = F.when(~keep, over)
    else:
        for name, ids in (("_kept", kept), ("_dropped", dropped)):
            if ids is None:
                c = c.withColumn(name, F.lit(False))
            else:
                c = c.join(ids.select(*K).distinct().withColumn(name, F.lit(True)), K, "left").withColumn(name, F.coalesce(name, F.lit(False)))
        keep = F.col("_kept")
        reason = F.when(~keep, F.when(F.col("_dropped"), over).otherwise("not_in_panel"))
    return c.select(
        PANEL,
        SERIES,
        *order,
        "first_obs_date",
        "last_obs_date",
        "n_obs",
        "n_missing_leading",
        "n_missing_internal",
        F.round(n_missing / t, 4).alias("frac_missing"),
        F.round(F.col("n_missing_leading") / t, 4).alias("frac_missing_leading"),
        F.round(F.col("n_missing_internal") / t, 4).alias("frac_missing_internal"),
        keep.alias("kept"),
        reason.alias("drop_reason"),
    )


def missing_fraction(transformed: DataFrame) -> DataFrame:
    return transformed.groupBy(*K).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.count_if(F.col(VALUE).isNull()).cast("long").alias("n_missing"),
        F.avg(F.col(VALUE).isNull().cast("double")).alias("missing_frac"),
    )


def kept_series(transformed: DataFrame | None, series: DataFrame, max_missing_frac: float = 0.5, counts: DataFrame | None = None) -> DataFrame:
    """Series present in the panel with their header position and kept flag.

    ``counts`` is the output of ``series_counts`` or of ``missing_fraction``.
    """
    if counts is not None and "n_missing" in counts.columns:
        mf = counts.select(*K, "n_rows", "n_missing")
    elif counts is not None:
        mf = counts.select(*K, "n_rows", (F.col("n_missing_leading") + F.col("n_missing_internal")).alias("n_missing"))
    else:
        mf = missing_fraction(transformed)
    present = mf.join(series.select(*K, "pos"), K)
    return present.select(
        PANEL, SERIES, "pos", "n_rows", "n_missing", kept_flag(F.col("n_missing"), F.col("n_rows"), max_missing_frac).alias("kept")
    )


def mask(transformed: DataFrame, kept: DataFrame) -> DataFrame:
    """Missingness mask of kept series (I3): true where the cell will be imputed."""
    ks = kept.where("kept").select(*K)
    return transformed.join(ks, K, "left_semi").select(PANEL, SERIES, DATE, F.col(VALUE).isNull().alias("imputed"))


def balanced_series(card: DataFrame, cutoff: date) -> DataFrame:
    """Kept series observed on or before ``cutoff``."""
    return card.where(F.col("kept") & (F.col("first_obs_date") <= F.lit(cutoff))).select(PANEL, SERIES)


def balanced_projection(df: DataFrame, balanced: DataFrame) -> DataFrame:
    """Rows of ``df`` (panel or mask) whose series is balanced."""
    return df.join(balanced.select(*K), K, "left_semi")


def leading_internal(transformed: DataFrame, kept: DataFrame) -> DataFrame:
    """Leading / internal missing counts of kept series."""
    ks = kept.where("kept").select(*K)
    return series_counts(transformed).join(ks, K, "left_semi").select(
        PANEL, SERIES, "n_rows", "n_missing_leading", "n_missing_internal"
    )


def imputation_counts(
    transformed: DataFrame | None, series: DataFrame, max_missing_frac: float = 0.5, k: int = 8, counts: DataFrame | None = None
) -> DataFrame:
    """Per panel: the count part of the imputation report.

    kept/dropped id lists are ordered by header position; the cell fractions
    use T * n_kept as denominator.
    """
    sc = (counts if counts is not None else series_counts(transformed)).join(series.select(*K, "pos"), K)
    n_missing = F.col("n_missing_leading") + F.col("n_missing_internal")
    kept = kept_flag(n_missing, F.col("n_rows"), max_missing_frac)
    per = sc.select(PANEL, SERIES, "pos", "n_rows", n_missing.alias("n_missing"), "n_missing_leading", "n_missing_internal", kept.alias("kept"))
    ids = lambda cond: F.transform(
        F.array_sort(F.collect_list(F.when(cond, F.struct("pos", SERIES)))), lambda s: s[SERIES]
    )
    agg = per.groupBy(PANEL).agg(
        F.max("n_rows").cast("long").alias("n_dates"),
        ids(F.col("kept")).alias("kept_series"),
        ids(~F.col("kept")).alias("dropped_series"),
        F.count_if("kept").cast("long").alias("n_kept"),
        F.count_if(~F.col("kept")).cast("long").alias("n_dropped"),
        F.sum(F.when(F.col("kept"), F.col("n_missing")).otherwise(0)).cast("long").alias("n_imputed"),
        F.sum(F.when(F.col("kept"), F.col("n_missing_leading")).otherwise(0)).cast("long").alias("n_imputed_leading"),
        F.sum(F.when(F.col("kept"), F.col("n_missing_internal")).otherwise(0)).cast("long").alias("n_imputed_internal"),
    )
    cells = F.greatest(F.col("n_dates") * F.col("n_kept"), F.lit(1))
    k_eff = lambda k: F.when(F.col("n_kept") == 0, F.lit(0)).otherwise(
        F.greatest(F.lit(1), F.least(F.lit(k), F.least(F.col("n_dates"), F.col("n_kept")) - 1))
    )
    return agg.select(
        "*",
        (F.col("n_imputed") / cells).alias("frac_imputed"),
        (F.col("n_imputed_leading") / cells).alias("frac_imputed_leading"),
        (F.col("n_imputed_internal") / cells).alias("frac_imputed_internal"),
        k_eff(k).cast("int").alias("k_factors"),
    )
