"""Per-series validation (V1-V3): basic quality flags and the ADF stationarity test.

Every regression of the test enters only through sums of products. One window
per series gives each row its lags; an Arrow kernel turns rows into sums, a row
per series and batch; a small solve per series reads those. The refit at the
chosen lag has a longer sample: the rows it adds are made from the series' first
few values, which travel with the sums, so there is no second pass. No series
history is ever gathered into one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from macropanel.functions import adf as A
from macropanel.model import DATE, K, PANEL, SERIES, VALUE

INF, NINF = float("inf"), float("-inf")


def series_quality(panel: DataFrame) -> DataFrame:
    """n_obs, null_rate (4 dp), flag_sparse (> 0.5 on the rounded rate), flag_infinite."""
    q = panel.groupBy(*K).agg(
        F.count(VALUE).cast("long").alias("n_obs"),
        F.count(F.lit(1)).alias("_t"),
        F.count_if(F.col(VALUE).isNull()).alias("_nulls"),
        F.count_if(F.col(VALUE).isin(INF, NINF)).alias("_inf"),
    )
    null_rate = F.round(F.col("_nulls") / F.greatest(F.col("_t"), F.lit(1)), 4)
    return q.select(PANEL, SERIES, "n_obs", null_rate.alias("null_rate"), (null_rate > 0.5).alias("flag_sparse"), (F.col("_inf") > 0).alias("flag_infinite"))


def _finite(panel: DataFrame) -> DataFrame:
    return panel.where(F.col(VALUE).isNotNull() & ~F.col(VALUE).isin(INF, NINF) & ~F.isnan(VALUE))


def df_tstat_lag0(panel: DataFrame) -> DataFrame:
    """Dickey-Fuller t-ratio without lagged differences: dx_t = a + b x_{t-1}.

    Over the finite values of each series in date order (gaps closed up).
    """
    w = Window.partitionBy(*K).orderBy(DATE)
    fin = _finite(panel)
    d = fin.select(*K, F.lag(VALUE, 1).over(w).alias("x1"), (F.col(VALUE) - F.lag(VALUE, 1).over(w)).alias("dx"))
    s = d.where(F.col("x1").isNotNull()).groupBy(*K).agg(
        F.count(F.lit(1)).alias("m"),
        F.regr_sxx("dx", "x1").alias("sxx"),
        F.regr_sxy("dx", "x1").alias("sxy"),
        F.regr_syy("dx", "x1").alias("syy"),
    )
    b = F.col("sxy") / F.col("sxx")
    ssr = F.col("syy") - b * F.col("sxy")
    t = b / F.sqrt(ssr / (F.col("m") - 2) / F.col("sxx"))
    ok = (F.col("m") >= 3) & (F.col("sxx") > 0) & (ssr > 0)
    return s.select(PANEL, SERIES, F.col("m").cast("long").alias("n_pairs"), F.round(F.when(ok, t), 6).alias("df_tstat"))


# ------------------------------------------------------------------ full ADF

ADF = "panel_id string, series_id string, adf_lag int, adf_stat double, adf_pvalue double, adf_status string"
SUMS = "panel_id string, series_id string, maxlag int, chunk long, xtx array<double>, xty array<double>, yty double, nobs long, head array<double>"


def _sums_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (series, i, level, difference, lagged differences) -> sums of products per series and batch.

    A series' rows come one after another, so a batch holds few pieces of series; the first values of a series
    go along, for the refit on the longer sample of a shorter lag.
    """
    names = [f.split()[0] for f in SUMS.split(", ")]
    for batch in batches:
        i, maxlag = batch.column("i").to_numpy(), batch.column("maxlag").to_numpy()
        x, dx = batch.column("x1").to_numpy(zero_copy_only=False), batch.column("dx").to_numpy(zero_copy_only=False)
        keys = batch.column(PANEL).to_pandas() + "\0" + batch.column(SERIES).to_pandas()
        code, _ = pd.factorize(keys)
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else []
        out = []
        for a, b in zip(starts, [*starts[1:], len(code)], strict=True):
            m = int(maxlag[a])
            rows = np.arange(a, b)[i[a:b] >= m + 1]  # the common sample: every lag up to maxlag is there
            lags = np.array([row[1 : m + 1] for row in batch.column("d").take(pa.array(rows)).to_pylist()], float).reshape(len(rows), m)
            s = A.sums_of(x[rows], dx[rows], lags)
            early = np.arange(a, b)[i[a:b] <= m + 1]  # i counts from 1: value i - 1 is the level of row i
            head = x[early].tolist()
            out.append((batch.column(PANEL)[a].as_py(), batch.column(SERIES)[a].as_py(), m, int(i[a]), s[0].ravel().tolist(), s[1].tolist(), s[2], s[3], head))
        if out:
            types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.int64(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _solve(pdf: pd.DataFrame) -> pd.DataFrame:
    """One series' partial sums (a row per Arrow batch it spans) -> lag, t-ratio, p-value."""
    pdf = pdf.sort_values("chunk")
    m = int(pdf["maxlag"].iloc[0])
    total = tuple(np.sum(np.stack(pdf[c].to_list()), axis=0) for c in ("xtx", "xty"))
    sums = (total[0].reshape(m + 2, m + 2), total[1], float(pdf["yty"].sum()), int(pdf["nobs"].sum()))
    lag = A.choose_lag(*sums, m)
    tau = A.tau_stat(*A.own_sample(sums, np.concatenate(pdf["head"].to_list()), lag, m), lag)
    row = {PANEL: pdf[PANEL].iloc[0], SERIES: pdf[SERIES].iloc[0], "adf_lag": lag, "adf_stat": tau}
    return pd.DataFrame([row | {"adf_pvalue": None if tau is None else A.mackinnon_p(tau), "adf_status": "ok" if tau is not None else "degenerate"}])


def adf_test(panel: DataFrame, min_obs: int = 30) -> DataFrame:
    """Per series: lag (AIC), statistic, p-value and status.

    ``adf_status``: ``ok``; ``short`` (fewer than ``min_obs`` non-null values, or fewer than 6 finite ones);
    ``constant``; ``degenerate`` (the level is a combination of the other regressors). All but ``ok`` have null
    statistic and p-value.

    Each series is centred and scaled by its own deviation, so lag, statistic and p-value don't depend on its
    unit. Its lags are one array per row, as long as its own maximum lag asks; the rows go straight from the
    window into an Arrow kernel that returns sums, so no lag is written anywhere.
    """
    w, wall = Window.partitionBy(*K).orderBy(DATE), Window.partitionBy(*K)
    value = F.col(VALUE)
    lengths = panel.groupBy(*K).agg(
        F.count(VALUE).alias("nn"),
        F.count_if(value.isNotNull() & ~value.isin(INF, NINF) & ~F.isnan(value)).alias("n"),
        F.min(F.when(~value.isin(INF, NINF) & ~F.isnan(value), value)).alias("lo"),
        F.max(F.when(~value.isin(INF, NINF) & ~F.isnan(value), value)).alias("hi"),
    )
    short = (F.col("nn") < min_obs) | (F.col("n") < 6)
    status = F.when(short, "short").when(F.col("lo") == F.col("hi"), "constant")
    told = lengths.select(*K, "n", status.alias("adf_status"))
    longest = told.where("adf_status is null").agg(F.max("n").alias("n")).first()["n"]
    none = told.where("adf_status is not null").select(*K, F.lit(None).cast("int").alias("adf_lag"), F.lit(None).cast("double").alias("adf_stat"), F.lit(None).cast("double").alias("adf_pvalue"), "adf_status")
    if longest is None:
        return none
    fin = _finite(panel.join(told.where("adf_status is null").select(*K), K, "left_semi"))
    fin = fin.select(*K, DATE, VALUE, F.count(VALUE).over(wall).alias("n"), F.avg(VALUE).over(wall).alias("mu"), F.stddev_pop(VALUE).over(wall).alias("sd"))
    n = F.col("n")
    maxlag = F.least(F.floor(n / 2) - 2, F.ceil(F.lit(12.0) * F.pow(n / 100.0, 0.25))).cast("int")
    x = fin.select(*K, DATE, maxlag.alias("maxlag"), ((F.col(VALUE) - F.col("mu")) / F.col("sd")).alias("x"), (F.row_number().over(w) - 1).alias("i"))
    x = x.withColumn("x1", F.lag("x", 1).over(w)).withColumn("dx", F.col("x") - F.col("x1"))
    # the row's own difference and those before it, newest first, as many as the series' own maximum lag asks
    before = F.reverse(F.collect_list("dx").over(w.rowsBetween(-A.maxlag_for(int(longest)), 0)))
    lagged = x.select(*K, "i", "maxlag", "x1", "dx", F.slice(before, 1, F.col("maxlag") + 1).alias("d")).where("i >= 1")
    sums = lagged.mapInArrow(_sums_kernel, SUMS)
    return sums.groupBy(*K).applyInPandas(_solve, ADF).unionByName(none)


def build_validation(panel: DataFrame, series: DataFrame | None = None, min_obs: int = 30) -> DataFrame:
    """V3: one row per series (present in ``series`` if given, with its ``pos`` if it has one)."""
    q = series_quality(panel)
    order = [c for c in ("pos",) if series is not None and c in series.columns]
    if series is not None:
        q = q.join(series.select(*K, *order), K)
    j = q.join(adf_test(panel, min_obs), K, "left")
    return j.select(
        PANEL,
        SERIES,
        *order,
        "n_obs",
        "null_rate",
        "flag_sparse",
        "flag_infinite",
        F.round("adf_pvalue", 4).alias("adf_pvalue"),
        F.coalesce(F.col("adf_pvalue") >= 0.05, F.lit(False)).alias("flag_nonstationary"),
    )
