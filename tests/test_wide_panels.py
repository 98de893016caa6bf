"""EM without a Gram matrix: the block iteration against dense eigenvectors, and the wide path against the others."""

from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from __spark_entry__ import queries
from macropanel.model import Params
from macropanel.operators import subspace
from macropanel.operators.factors import counts_of, em_impute, panels_by_series, series_rows, series_vectors
from macropanel.plans.inputs import wide_part_panel
from macropanel.sources.panels import cells_of, facts_to_panel
from test_factors import dense, frame, gram_steps, two_factors  # noqa: F401


def iterate(z: np.ndarray, k: int, parts: int = 3) -> tuple[np.ndarray, int]:
    """Leading vectors by passes over the parts of z, as the tasks make them."""
    n = z.shape[1]
    s = np.linalg.qr(np.random.default_rng(1).normal(size=(n, min(*z.shape, k + subspace.EXTRA))))[0]
    lead = s.shape[1]
    for passes in range(1, subspace.MOST_PASSES):
        each = [part @ s for part in np.array_split(z, parts)]
        r = np.linalg.qr(np.concatenate([np.linalg.qr(y, mode="r") for y in each]), mode="r")
        gs = sum(part.T @ y for part, y in zip(np.array_split(z, parts), each, strict=True))
        v, more = subspace.rotate(s, gs, r, k, lead)
        if more is None:
            return v[:, :k], passes
        s, lead = more, v.shape[1]
    raise AssertionError("no end")


@pytest.mark.parametrize(("t", "n", "k"), [(120, 60, 8), (60, 200, 8), (40, 12, 3), (300, 90, 1), (9, 40, 8)])
def test_projector_equals_dense_eigenvectors(t, n, k):
    z = np.random.default_rng(t + n).normal(size=(t, n)) @ np.diag(np.linspace(2, 0.2, n))
    v, passes = iterate(z, k)
    _, vectors = np.linalg.eigh(z.T @ z)
    top = vectors[:, -k:]
    assert np.abs(v @ v.T - top @ top.T).max() < 1e-8
    assert passes < 120


def test_rank_deficient_and_zero_matrices():
    z = np.outer(np.arange(1.0, 31), np.ones(50))
    v, _ = iterate(z, 3)
    assert np.abs(z @ v @ v.T - z).max() < 1e-8
    assert np.isfinite(iterate(np.zeros((20, 30)), 2)[0]).all()


def test_wide_path_equals_the_formula(spark, two_factors):  # noqa: F811
    """Three panels at once, one of them complete, dealt over small groups: steps, change and cells of the dense formula."""
    _, holes = two_factors
    rng = np.random.default_rng(31)
    small = rng.normal(size=(45, 14)).cumsum(axis=0)
    small[3:9, 1] = small[[20, 33], 2] = np.nan
    whole = rng.normal(size=(28, 3))
    parts = {"holes": frame(spark, holes, "holes"), "small": frame(spark, small, "small"), "whole": frame(spark, whole, "whole")}
    panel, series = parts["holes"]
    for name in ("small", "whole"):
        panel, series = panel.unionByName(parts[name][0]), series.unionByName(parts[name][1])
    res = em_impute(panel, series, Params(k=2, max_iter=6, tol=1e-3, cells_per_task=150, gram_series=0))
    reports = {r.panel_id: r for r in res.report.collect()}
    for name, x in (("holes", holes), ("small", small)):
        want, steps, stopped, change = gram_steps(x, 2, 6, 1e-3)
        assert (reports[name].n_iter, reports[name].converged) == (steps, stopped)
        assert reports[name].final_delta == pytest.approx(change, rel=1e-6)
        np.testing.assert_allclose(dense(res.imputed.where(F.col("panel_id") == name)), want, rtol=1e-7, atol=1e-8)
    assert (reports["whole"].n_iter, reports["whole"].converged) == (1, True)
    np.testing.assert_array_equal(dense(res.imputed.where("panel_id = 'whole'")), whole)


def test_wide_and_narrow_panels_in_one_run(spark, two_factors):  # noqa: F811
    _, holes = two_factors
    rng = np.random.default_rng(9)
    broad = rng.normal(size=(24, 5)) @ rng.normal(size=(5, 60)) + 0.1 * rng.normal(size=(24, 60))
    broad[2:6, 7] = broad[11, 20:40] = np.nan
    panel, series = frame(spark, holes, "narrow")
    b = frame(spark, broad, "broad")
    res = em_impute(panel.unionByName(b[0]), series.unionByName(b[1]), Params(k=2, max_iter=3, tol=1e-9, cells_per_task=700, gram_series=50))
    for name, x in (("narrow", holes), ("broad", broad)):
        want, steps, _, _ = gram_steps(x, 2, 3, 1e-9)
        np.testing.assert_allclose(dense(res.imputed.where(F.col("panel_id") == name)), want, rtol=1e-7, atol=1e-8)


def counted_jobs(spark, group, call):
    """What the call returns, and how many jobs it took."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        return call(), len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_more_series_than_dates_take_one_pass_a_step(spark):
    """Short vectors of the series: the dense formula's cells, the same if the vectors join by salt, and few jobs a step."""
    rng = np.random.default_rng(21)
    broad = rng.normal(size=(12, 4)) @ rng.normal(size=(4, 90)) + 0.2 * rng.normal(size=(12, 90))
    broad[rng.random(broad.shape) < 0.2] = np.nan
    other = rng.normal(size=(9, 40)).cumsum(axis=0)
    other[2:4, 5] = other[7, 8] = np.nan
    full = rng.normal(size=(6, 50))
    parts = {"broad": broad, "other": other, "full": full}
    frames = [frame(spark, x, name) for name, x in parts.items()]
    panel, series = (a.unionByName(b).unionByName(c) for a, b, c in zip(*frames, strict=True))
    p = Params(k=3, max_iter=5, tol=1e-9, cells_per_task=100, gram_series=30)
    short, jobs = counted_jobs(spark, "five steps", lambda: em_impute(panel, series, p))
    _, more = counted_jobs(spark, "eight steps", lambda: em_impute(panel, series, p.with_(max_iter=8)))
    assert more - jobs <= 3 * 6
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = em_impute(panel, series, p)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for res in (short, joined):
        reports = {r.panel_id: r for r in res.report.collect()}
        for name in ("broad", "other"):
            want, steps, stopped, change = gram_steps(parts[name], 3, 5, 1e-9)
            assert (reports[name].n_iter, reports[name].converged) == (steps, stopped)
            assert reports[name].final_delta == pytest.approx(change, rel=1e-6)
            np.testing.assert_allclose(dense(res.imputed.where(F.col("panel_id") == name)), want, rtol=1e-7, atol=1e-8)
        assert (reports["full"].n_iter, reports["full"].converged) == (1, True)
        np.testing.assert_array_equal(dense(res.imputed.where("panel_id = 'full'")), full)


def sparse_facts(spark, rng, panels=("a", "b")):
    """Quarterly facts with holes, null values, dates and names; panel b is two years later."""
    rows = [(p, f"S{i:03d}", date(1990 + 2 * (p == "b") + q // 4, 3 * (q % 4) + 1, 1), float(rng.normal())) for p in panels for i in range(70) for q in range(11) if rng.random() < 0.6]
    rows += [("a", "S001x", date(1991, 4, 1), None), ("a", "S002x", None, 4.0), ("a", None, date(1990, 7, 1), 3.0), ("b", "nan", date(1993, 1, 1), float("nan"))]
    return spark.createDataFrame(rows, "panel_id string, series_id string, date date, value double")


def test_rows_by_series_are_the_panel(spark):
    """The same cells and series whether the spine is laid over cells or inside the rows of series."""
    facts = sparse_facts(spark, np.random.default_rng(3)).repartition(5)
    cells, series = facts_to_panel(facts, "3 MONTH")
    rows, series2 = facts_to_panel(facts, "3 MONTH", by_series=True)
    name = lambda r: tuple(str(x) for x in r)
    assert sorted(map(name, cells.select("panel_id", "series_id", "date", "value").collect())) == sorted(map(name, cells_of(rows).collect()))
    assert sorted(map(name, series.collect())) == sorted(map(name, series2.collect()))


def test_a_series_may_go_on_in_the_next_batch(spark):
    facts = sparse_facts(spark, np.random.default_rng(4))
    want = {str(r) for r in facts_to_panel(facts, "3 MONTH", by_series=True)[0].collect()}
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {str(r) for r in facts_to_panel(facts, "3 MONTH", by_series=True)[0].collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got == want


def test_steps_between_written_states(spark):
    """Panels that end at different steps, before and after a state is written: the dense formula's cells, two jobs a step."""
    rng = np.random.default_rng(77)
    slow = rng.normal(size=(12, 60))
    slow[rng.random(slow.shape) < 0.3] = np.nan
    fast = rng.normal(size=(10, 2)) @ rng.normal(size=(2, 50)) + 0.01 * rng.normal(size=(10, 50))
    fast[2, 5] = fast[7, 8:20] = np.nan
    (panel, series), (other, dim) = frame(spark, slow, "slow"), frame(spark, fast, "fast")
    panel, series = panel.unionByName(other), series.unionByName(dim)
    p = Params(k=2, max_iter=13, tol=2e-3, cells_per_task=100, gram_series=30)
    ends = {}
    for steps in (7, 10, 13):
        res, jobs = counted_jobs(spark, f"{steps} steps", lambda s=steps: em_impute(panel, series, p.with_(max_iter=s), rows=series_rows(panel)))
        reports = {r.panel_id: r for r in res.report.collect()}
        for name, x in (("slow", slow), ("fast", fast)):
            want, n, stopped, change = gram_steps(x, 2, steps, 2e-3)
            assert (reports[name].n_iter, reports[name].converged) == (n, stopped)
            assert reports[name].final_delta == pytest.approx(change, rel=1e-6)
            np.testing.assert_allclose(dense(res.imputed.where(F.col("panel_id") == name)), want, rtol=1e-7, atol=1e-8)
        ends[steps] = (reports["fast"].n_iter, reports["slow"].n_iter, jobs)
    assert ends[13][0] < 13 == ends[13][1]
    assert ends[13][2] - ends[7][2] <= 2 * 6 + 3


def test_moments_and_counts_of_rows(spark):
    """A constant series has no deviation, a missing one no mean; leading gaps are those before the first value."""
    rows = spark.createDataFrame(
        [("p", "const", [0.1 + 1e9] * 3 + [None]), ("p", "none", [None] * 4), ("p", "some", [None, 1.0, None, 4.0]), ("p", "odd", [1.0, float("inf"), None, 2.0])],
        "panel_id string, series_id string, v array<double>",
    ).withColumn("d", F.expr("sequence(date'2000-01-01', date'2000-10-01', interval 3 month)"))
    counts = {r.series_id: (r.n_rows, r.n_missing_leading, r.n_missing_internal) for r in counts_of(rows).collect()}
    assert counts == {"const": (4, 0, 1), "none": (4, 4, 0), "some": (4, 1, 1), "odd": (4, 0, 1)}
    kidx = rows.select("panel_id", "series_id", F.row_number().over(Window.partitionBy("panel_id").orderBy("series_id")).cast("int").alias("idx"))
    across = panels_by_series(rows, kidx)
    got = {r.series_id: r for r in series_vectors(rows, kidx, across).collect()}
    assert all(r.whole for r in got.values())
    assert got["const"].z0 == [0.0, 0.0, 0.0, None] and got["const"].sd == 1.0
    assert (got["none"].z0, got["none"].mu) == ([None] * 4, None)
    assert (got["some"].mu, got["some"].sd, got["some"].z0) == (2.5, 1.5, [None, -1.0, None, 1.0])
    assert got["odd"].nf == [got["odd"].idx] and got["some"].nf == []


def test_wide_panel_with_a_date_twice_is_refused(spark):
    rng = np.random.default_rng(5)
    panel, series = frame(spark, np.where(rng.random((6, 40)) < 0.1, np.nan, rng.normal(size=(6, 40))), "p")
    with pytest.raises(ValueError, match="twice or not at all"):
        em_impute(panel.unionByName(panel.limit(1)), series, Params(k=1, gram_series=20))


def test_query_of_parts(spark, tmp_dir):
    """Long, negative and null keys; a panel whose series are all dropped gives its report's row alone."""
    spark.createDataFrame(
        [(k, float(i), datetime(1995 + i, 1, 5)) for k in (7, -3, 1_234_567_890_123, 1_234_567_890_129, None) for i in (0, 4)] + [(7, 0.5, datetime(1995, 3, 31)), (8, 1.0, None)],
        "l_partkey bigint, l_extendedprice double, l_shipdate timestamp",
    ).write.parquet(f"{tmp_dir}/lineitem.parquet")
    rows, dim = wide_part_panel(spark, tmp_dir)
    got = {r.series_id: r for r in rows.collect()}
    assert set(got) == {None, "P000000000007", "P0000000000-3", "P123456789012", "P000000000008"}
    assert all(len(r.d) == 17 for r in got.values())
    assert (got["P000000000007"].v[0], got["P123456789012"].v[16], got["P000000000008"].v) == (0.5, 8.0, [None] * 17)
    assert [r.pos for r in dim.orderBy("pos").collect()] == [0, 1, 2, 3, 4]
    (row,) = queries()["em_wide_impute"](spark, tmp_dir).collect()
    assert (row.n_kept, row.n_dropped, row.series_id, row.value) == (0, 4, None, None)
