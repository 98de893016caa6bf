"""Outlier band and tcodes by property: what undoes a transform, what leaves it alone, and where nulls go."""

from __future__ import annotations

import math
import statistics

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import long_panel, month_dates, wide
from macropanel.operators import outliers as O
from macropanel.operators import stationarity as S

LEVELS = [7.25, 9.5, 8.125, None, 12.75, 30.5, 29.0, 41.25, 40.0, 77.5]


def transformed(spark, code, columns):
    panel, _ = long_panel(spark, columns, month_dates(len(next(iter(columns.values())))))
    return wide(S.apply_tcode(panel, F.lit(code)))


def by_hand(values, code):
    """A code's definition, value by value; a null or undefined operand gives null."""
    log = [math.log(v) if v is not None and v > 0 else None for v in values]
    src = {1: values, 2: values, 3: values, 4: log, 5: log, 6: log}.get(code)

    def diff(xs):
        return [None] + [None if a is None or b is None else b - a for a, b in zip(xs, xs[1:])]

    if code == 7:
        growth = [None] + [None if a in (None, 0) or b is None else b / a - 1 for a, b in zip(values, values[1:])]
        return diff(growth)
    for _ in range({1: 0, 2: 1, 3: 2, 4: 0, 5: 1, 6: 2}[code]):
        src = diff(src)
    return src


@pytest.mark.parametrize("code", S.TCODES)
def test_codes_equal_their_definition(spark, code):
    columns = {"full": [3.5, 2.25, 6.0, 6.5, 1.125, 8.0, 9.75], "gap": [4.0, None, 5.5, 7.0, None, None, 2.0], "signs": [-1.5, 0.0, 2.0, -3.0, 0.0, 4.0, 5.0]}
    got = transformed(spark, code, columns)
    for name, values in columns.items():
        assert got[name] == [None if x is None else pytest.approx(x, abs=1e-12) for x in by_hand(values, code)]


@pytest.mark.parametrize(("code", "undo"), [(2, lambda x0, d: x0 + np.cumsum(d)), (5, lambda x0, d: x0 * np.exp(np.cumsum(d)))])
def test_differences_are_undone_by_sums(spark, code, undo):
    levels = [v for v in LEVELS if v is not None]
    out = transformed(spark, code, {"s": levels})["s"]
    assert out[0] is None
    np.testing.assert_allclose(undo(levels[0], np.array(out[1:])), levels[1:])


@pytest.mark.parametrize(("code", "change"), [(2, lambda v: v + 1000.0), (3, lambda v: v + 1000.0), (5, lambda v: v * 64.0), (6, lambda v: v * 64.0), (7, lambda v: v * 64.0)])
def test_differences_forget_shift_or_scale(spark, code, change):
    other = [None if v is None else change(v) for v in LEVELS]
    got = transformed(spark, code, {"a": LEVELS, "b": other})
    assert got["b"] == [None if x is None else pytest.approx(x, abs=1e-9) for x in got["a"]]


def test_second_differences_of_a_parabola_and_of_steady_growth_vanish(spark):
    parabola, growth = [0.5 * i * i - 3 * i + 2 for i in range(9)], [5 * 1.25**i for i in range(9)]
    assert transformed(spark, 3, {"s": parabola})["s"][2:] == [pytest.approx(1.0)] * 7
    assert transformed(spark, 6, {"s": growth})["s"][2:] == [pytest.approx(0.0, abs=1e-12)] * 7
    assert transformed(spark, 7, {"s": growth})["s"][2:] == [pytest.approx(0.0, abs=1e-12)] * 7


def test_every_unknown_code_is_named(spark):
    codes = {f"u{i:02d}": 50 + i % 3 for i in range(12)}
    panel, series = long_panel(spark, {**{c: [1.0, 2.0, 4.0] for c in codes}, "fine": [1.0, 1.0, 1.0]}, month_dates(3), tcodes={**codes, "fine": 3})
    with pytest.raises(ValueError) as e:
        S.transform_all(panel, series)
    assert all(c in str(e.value) for c in codes) and "fine" not in str(e.value)
    assert S.unknown_tcodes(series).count() == 12
    with pytest.raises(Exception, match="unknown tcode"):
        S.transform_all(panel, series, check=False).collect()


def test_dispatch_slices_two_rows_and_passes_uncoded_series(spark):
    columns = {"lvl": LEVELS, "dif": LEVELS, "none": LEVELS}
    panel, series = long_panel(spark, columns, month_dates(10), tcodes={"lvl": 1, "dif": 2})
    got = wide(S.transform_all(panel, series))
    assert got["lvl"] == got["none"] == LEVELS[2:]
    assert got["dif"] == by_hand(LEVELS, 2)[2:]


def test_input_order_does_not_matter(spark):
    rng = np.random.default_rng(77)
    columns = {f"k{i}": [None if rng.random() < 0.2 else float(v) for v in rng.uniform(1, 9, 25)] for i in range(4)}
    panel, series = long_panel(spark, columns, month_dates(25), tcodes={"k0": 6, "k1": 7, "k2": 3})
    a = sorted(S.transform_all(O.remove_outliers(panel), series).collect())
    assert sorted(S.transform_all(O.remove_outliers(panel.orderBy(F.rand(1)).repartition(5)), series).collect()) == a


# the outlier band


def band_by_hand(values, k):
    x = sorted(v for v in values if v is not None and not math.isnan(v))
    q = [x[int(math.floor(p * (len(x) - 1) + 0.5))] for p in (0.25, 0.75)]
    mid, spread = statistics.median(x), q[1] - q[0]
    return mid, q[0], q[1], mid - k * spread, mid + k * spread


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.none() | st.integers(-40, 40).map(float), min_size=4, max_size=4), min_size=1, max_size=12), st.sampled_from([1.0, 2.5, 10.0]))
def test_band_against_hand_sorted_ranks(spark_once, rows, k):
    columns = {f"c{j}": [r[j] for r in rows] for j in range(4)}
    panel, _ = long_panel(spark_once, columns, month_dates(len(rows)))
    got = {r["series_id"]: r for r in O.outlier_bounds(panel, k).collect()}
    after = wide(O.remove_outliers(panel, k))
    for name, values in columns.items():
        n = sum(v is not None for v in values)
        assert got[name]["n_obs"] == n
        if n:
            want = band_by_hand(values, k)
            assert tuple(got[name][c] for c in ("median", "q25", "q75", "lower", "upper")) == pytest.approx(want)
            assert after[name] == [v if v is not None and want[3] <= v <= want[4] else None for v in values]


@pytest.fixture(scope="module")
def spark_once(spark):
    return spark


def test_nan_is_a_missing_value(spark):
    nan = float("nan")
    panel, series = long_panel(spark, {"a": [2.0, nan, 4.0, 6.0, nan, 8.0], "b": [2.0, None, 4.0, 6.0, None, 8.0]}, month_dates(6))
    got = {r["series_id"]: tuple(r)[2:] for r in O.outlier_bounds(panel).collect()}
    assert got["a"] == got["b"] and got["a"][0] == 4
    out = wide(O.remove_outliers(panel))
    assert out["a"] == out["b"] == [2.0, None, 4.0, 6.0, None, 8.0]


def test_flat_series_keeps_only_its_level(spark):
    panel, _ = long_panel(spark, {"flat": [3.0] * 9 + [3.5]}, month_dates(10))
    assert wide(O.remove_outliers(panel))["flat"] == [3.0] * 9 + [None]


def test_ranks_by_passes_equal_sorted_values(spark):
    """Ties, huge and tiny values, equal values only, one value, none, infinities' neighbours."""
    import random

    from macropanel.functions.quantile import select_ranks

    rng = random.Random(3)
    groups = {
        "ties": [float(rng.randrange(5)) for _ in range(400)],
        "spread": [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) for _ in range(300)],
        "same": [2.5] * 50,
        "one": [7.0],
        "wide": [-1.7e308, 1.7e308, 0.0, 1e-320, -1e-320, 5.0],
        "none": [],
    }
    rows = [(g, v) for g, vs in groups.items() for v in [*vs, None]]
    cells = spark.createDataFrame(rows, "g string, value double").repartition(5)
    targets = [(g, f"t{i}", i) for g, vs in groups.items() for i in sorted({0, len(vs) // 4, len(vs) // 2, len(vs) - 1}) if 0 <= i < len(vs)]
    got = {(r.g, r.target): r.picked for r in select_ranks(cells, spark.createDataFrame(targets, "g string, target string, rank long"), ["g"], "value").collect()}
    assert got == {(g, t): sorted(groups[g])[i] for g, t, i in targets}


def test_long_series_lose_the_same_outliers(spark):
    from macropanel.operators.outliers import remove_outliers_long

    values = {"a": [1.0, 2.0, 3.0, 2.0, 900.0, None, float("nan"), 1.5], "b": [None] * 8, "c": [4.0] * 7 + [4.1]}
    panel, _ = long_panel(spark, values, month_dates(8))
    key = lambda df: sorted(map(str, df.select("series_id", "date", "value").collect()))
    assert key(remove_outliers_long(panel, 3.0)) == key(O.remove_outliers(panel, 3.0))
