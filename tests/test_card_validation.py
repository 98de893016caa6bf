from __future__ import annotations

import math
from datetime import date

import numpy as np
import pytest

from conftest import long_panel, month_dates
from macropanel.functions import adf as A
from macropanel.operators import card as C
from macropanel.operators.validation import adf_test, build_validation, df_tstat_lag0, series_quality


def card_of(spark, cols, n=10, frac=0.5):
    panel, series = long_panel(spark, cols, month_dates(n))
    return {r.series_id: r for r in C.build_data_card(panel, series, frac).collect()}, panel, series


def test_card_rows(spark):
    cols = {
        "LEAD": [None, None, 1, 2, 3, 4, 5, 6, 7, 8],
        "TRAIL": [1, 2, 3, 4, 5, 6, 7, 8, None, None],
        "GAPS": [1, None, 3, None, 5, 6, 7, 8, 9, 10],
        "NONE": [None] * 10,
        "HALF": [None] * 5 + [1, 2, 3, 4, 5],
    }
    card, _, _ = card_of(spark, cols)
    lead = card["LEAD"]
    assert (lead.n_obs, lead.n_missing_leading, lead.n_missing_internal) == (8, 2, 0)
    assert lead.first_obs_date == date(1990, 3, 1) and lead.last_obs_date == date(1990, 10, 1)
    trail = card["TRAIL"]  # trailing missing counts as internal
    assert (trail.n_missing_leading, trail.n_missing_internal) == (0, 2)
    assert card["GAPS"].n_missing_internal == 2 and card["GAPS"].frac_missing == 0.2
    none = card["NONE"]
    assert (none.n_obs, none.n_missing_leading, none.n_missing_internal) == (0, 10, 0)
    assert none.first_obs_date is None and not none.kept and none.drop_reason == "missing_frac>0.5"
    assert card["HALF"].kept and card["HALF"].drop_reason is None  # exactly 50 % is kept
    for r in card.values():
        assert r.n_obs + r.n_missing_leading + r.n_missing_internal == 10


def test_card_fraction_rounding(spark):
    card, _, _ = card_of(spark, {"A": [None] + [1.0] * 2}, n=3)
    assert card["A"].frac_missing == 0.3333


def test_balanced_cutoff(spark):
    cols = {"ON": [None, 1, 2, 3], "BEFORE": [1, 2, 3, 4], "AFTER": [None, None, 2, 3], "DROP": [None, None, None, 1]}
    panel, series = long_panel(spark, cols, month_dates(4))
    card = C.build_data_card(panel, series, 0.5)
    got = {r.series_id for r in C.balanced_series(card, date(1990, 2, 1)).collect()}
    assert got == {"ON", "BEFORE"}
    proj = C.balanced_projection(panel, C.balanced_series(card, date(1990, 2, 1)))
    assert proj.count() == 8


def test_series_quality(spark):
    cols = {"X": [1.0, None, None, None, None], "Y": [1.0, 2.0, 3.0, None, 5.0], "Z": [1.0, math.inf, 2.0, 3.0, 4.0]}
    panel, _ = long_panel(spark, cols, month_dates(5))
    q = {r.series_id: r for r in series_quality(panel).collect()}
    assert q["X"].null_rate == pytest.approx(0.8) and q["X"].flag_sparse
    assert not q["Y"].flag_sparse and q["Y"].n_obs == 4
    assert q["Z"].flag_infinite and not q["Y"].flag_infinite


def test_sparse_flag_over_half(spark):
    panel, _ = long_panel(spark, {"X": [1.0] + [None] * 9}, month_dates(10))
    assert series_quality(panel).first().flag_sparse


def test_mackinnon_formula_at_critical_values():
    assert A.mackinnon_p(-3.43) == pytest.approx(0.0100, abs=5e-4)
    assert A.mackinnon_p(-2.86) == pytest.approx(0.0502, abs=5e-4)
    assert A.mackinnon_p(-2.57) == pytest.approx(0.0994, abs=5e-4)
    assert A.mackinnon_p(3.0) == 1.0 and A.mackinnon_p(-20.0) == 0.0


def adf_direct(x):
    """Own direct least squares on one series: (tau, lag, p-value)."""
    x = np.asarray(x, float)
    dx, maxlag = np.diff(x), A.maxlag_for(len(x))

    def regression(lag, start):
        t = np.arange(start, len(dx))
        xm = np.column_stack([np.ones(len(t)), x[t], *[dx[t - j] for j in range(1, lag + 1)]])
        scale = np.sqrt((xm**2).sum(axis=0))
        coef, *_ = np.linalg.lstsq(xm / scale, dx[t], rcond=None)
        res = dx[t] - xm / scale @ coef
        return xm / scale, coef, float(res @ res), len(t)

    fits = [regression(p, maxlag) for p in range(maxlag + 1)]
    lag = int(np.argmin([A.aic(ssr, n, p + 2) for p, (_, _, ssr, n) in enumerate(fits)]))
    xm, coef, ssr, n = regression(lag, lag)
    tau = coef[1] / np.sqrt(ssr / (n - lag - 2) * np.linalg.inv(xm.T @ xm)[1, 1])
    return float(tau), lag, A.mackinnon_p(float(tau))


@pytest.fixture(scope="module")
def shapes():
    rng = np.random.default_rng(99)
    ar = [0.0]
    for e in rng.normal(size=199):
        ar.append(0.7 * ar[-1] + e)
    return {"walk": rng.normal(size=200).cumsum() + 40, "ar": np.array(ar), "season": np.sin(np.arange(200) / 3) + rng.normal(scale=0.2, size=200)}


@pytest.mark.parametrize("factor", [1e-10, 1e-6, 1.0, 1e6, 1e10])
def test_adf_does_not_depend_on_the_unit(spark, shapes, factor):
    panel, _ = long_panel(spark, {k: list(v * factor) for k, v in shapes.items()}, month_dates(200))
    got = {r.series_id: r for r in adf_test(panel).collect()}
    for name, x in shapes.items():
        tau, lag, p = adf_direct(x)
        assert (got[name].adf_lag, got[name].adf_status) == (lag, "ok")
        assert got[name].adf_stat == pytest.approx(tau, rel=1e-6) and got[name].adf_pvalue == pytest.approx(p, abs=1e-7)


def test_adf_of_short_and_long_series_in_one_run(spark, shapes):
    """A series of 4,000 days beside monthly ones: each has its own maximum lag, and batches are merged."""
    rng = np.random.default_rng(5)
    days = np.arange(np.datetime64("1990-01-01"), np.datetime64("1990-01-01") + 4000).tolist()
    long_one = rng.normal(size=4000).cumsum()
    a, _ = long_panel(spark, {"days": list(long_one)}, days, "d")
    b, _ = long_panel(spark, {k: list(v) for k, v in shapes.items()}, month_dates(200), "m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got = {r.series_id: r for r in adf_test(a.unionByName(b)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for name, x in {**shapes, "days": long_one}.items():
        tau, lag, p = adf_direct(x)
        assert got[name].adf_lag == lag and got[name].adf_stat == pytest.approx(tau, rel=1e-6) and got[name].adf_pvalue == pytest.approx(p, abs=1e-7)


def test_adf_tells_why_there_is_no_statistic(spark):
    nan, inf = float("nan"), float("inf")
    cols = {"few": [1.0, 5.0, 2.0] + [None] * 37, "flat": [8.0] * 40, "line": [float(i) for i in range(40)], "inf": [inf] * 36 + [1.0, 2.0, 4.0, 3.0], "nan": [nan] * 40}
    panel, series = long_panel(spark, cols, month_dates(40))
    got = {r.series_id: r for r in adf_test(panel).collect()}
    assert {k: r.adf_status for k, r in got.items()} == {"few": "short", "flat": "constant", "line": "degenerate", "inf": "short", "nan": "short"}
    assert all(r.adf_stat is None and r.adf_pvalue is None for r in got.values())
    v = build_validation(panel, series).orderBy("pos").collect()
    assert [r.series_id for r in v] == list(cols) and not any(r.flag_nonstationary for r in v)


def test_one_factor_holds_every_lag(shapes):
    x = shapes["walk"]
    dx, m = np.diff(x), 6
    t = np.arange(m, len(dx))
    lags = np.column_stack([dx[t - j] for j in range(1, m + 1)])
    a, b, c, n = A.sums_of(x[t], dx[t], lags)
    unit, rhs, _ = A._scaled(a, b)
    w = A._forward(*A.cholesky(unit), rhs)
    for p in range(m + 1):
        xm = np.column_stack([np.ones(len(t)), x[t], lags[:, :p]])
        _, ssr, *_ = np.linalg.lstsq(xm, dx[t], rcond=None)
        assert c - (w[: p + 2] ** 2).sum() == pytest.approx(float(ssr[0]), rel=1e-9)


def test_validation_skips_unknown_ids(spark):
    panel, series = long_panel(spark, {"A": [1.0, 2.0, 3.0]}, month_dates(3))
    _, more = long_panel(spark, {"A": [1.0], "NONEXISTENT": [1.0]}, month_dates(1))
    rows = build_validation(panel, more).collect()
    assert [r.series_id for r in rows] == ["A"]


def test_df_lag0_matches_numpy(spark):
    vals = list(np.random.default_rng(4).standard_normal(60).cumsum())
    panel, _ = long_panel(spark, {"W": vals}, month_dates(60))
    got = df_tstat_lag0(panel).first().df_tstat
    x = np.array(vals)
    y, x1 = np.diff(x), x[:-1]
    xm = np.column_stack([np.ones_like(x1), x1])
    coef, *_ = np.linalg.lstsq(xm, y, rcond=None)
    r = y - xm @ coef
    cov = (r @ r) / (len(y) - 2) * np.linalg.inv(xm.T @ xm)
    assert got == pytest.approx(coef[1] / math.sqrt(cov[1, 1]), abs=2e-6)


def test_callers_own_selection_is_told_apart(spark):
    panel, series = long_panel(spark, {"A": [1.0, 2.0], "B": [1.0, None], "C": [3.0, 4.0]}, month_dates(2))
    pick = lambda *ids: series.where(series.series_id.isin(*ids))
    card = {r.series_id: r for r in C.build_data_card(panel, series, kept=pick("A"), dropped=pick("B")).collect()}
    assert [(card[s].kept, card[s].drop_reason) for s in "ABC"] == [(True, None), (False, "missing_frac>0.5"), (False, "not_in_panel")]
    assert [card[s].pos for s in "ABC"] == [0, 1, 2]


def test_card_requires_date(spark):
    panel, series = long_panel(spark, {"A": [1.0, 2.0]}, month_dates(2))
    with pytest.raises(ValueError, match="date"):
        C.build_data_card(panel.drop("date"), series)


def test_partition_count_does_not_change_results(spark):
    from macropanel.operators.outliers import remove_outliers
    from macropanel.operators.stationarity import transform_all

    rng = np.random.default_rng(11)
    cols = {f"S{i}": [None if rng.random() < 0.1 else float(v) for v in rng.standard_normal(40).cumsum() + 50] for i in range(6)}
    panel, series = long_panel(spark, cols, month_dates(40), tcodes={"S0": 2, "S1": 5, "S2": 7, "S4": 3})
    results = []
    for parts in ("1", "4", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        t = transform_all(remove_outliers(panel.repartition(int(parts) if parts != "200" else 7)), series)
        results.append(sorted(C.build_data_card(t, series).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]
