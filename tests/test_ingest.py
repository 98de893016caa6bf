from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import CODES, HEADER, long_panel, month_dates, vintage_rows, vintage_text
from macropanel.sources import vintage as V
from macropanel.sources.panels import facts_to_panel, to_wide, unpivot_wide


def lines_df(spark, text: str, vintage: str = "1985-12"):
    return V.split_lines(spark.createDataFrame([(vintage, text)], "panel_id string, value string"))


def cells(panel):
    return {(r.series_id, r.date): r.value for r in panel.collect()}


def land(folder: str, files: dict[str, str]) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", newline="") as f:
            f.write(text)
    return folder


@pytest.mark.parametrize(("ref", "pin", "want"), [(date(2011, 8, 31), None, "2011-07"), (date(2012, 1, 1), None, "2011-12"), (date(2012, 3, 30), " ", "2012-02"), (date(2012, 3, 30), "1999-4", "1999-04")])
def test_vintage_of_a_day(spark, ref, pin, want):
    df = spark.createDataFrame([(ref, pin)], "ref date, pin string")
    assert df.select(V.vintage_name(F.col("ref"), F.col("pin")), V.vintage_path("gs://x/", F.col("ref"), F.col("pin"))).first()[:] == (want, f"gs://x/{want}-md.csv")


def test_published_file_parses_to_its_numbers(spark):
    panel, dim = V.parse_lines(lines_df(spark, vintage_text()))
    assert [(r.series_id, r.tcode) for r in dim.orderBy("pos").collect()] == [(h, CODES[h]) for h in HEADER]
    days = month_dates(9, date(1985, 3, 1))
    assert cells(panel) == {(h, d): v for h, vs in vintage_rows().items() for d, v in zip(days, vs, strict=True)}


def test_rows_before_the_floor_go(spark):
    panel, _ = V.parse_lines(lines_df(spark, vintage_text()), date_floor=date(1985, 8, 1))
    assert sorted({d for _, d in cells(panel)}) == [date(1985, m, 1) for m in (8, 9, 10, 11)]


def test_short_and_long_lines_give_a_cell_for_every_column(spark):
    text = "d,A,B,C\nt,2\n4/1/2001,1\n5/1/2001,1,2,3,4,5\n6/1/2001,,NaN,.\n,9,9,9\n"
    panel, dim = V.parse_lines(lines_df(spark, text))
    got = cells(panel)
    assert len(got) == 9 and [got[(s, date(2001, 4, 1))] for s in "ABC"] == [1.0, None, None]
    assert [got[(s, date(2001, 5, 1))] for s in "ABC"] == [1.0, 2.0, 3.0]
    assert [got[(s, date(2001, 6, 1))] for s in "ABC"] == [None] * 3
    assert {r.series_id: r.tcode for r in dim.collect()} == {"A": 2, "B": None, "C": None}


def test_words_for_numbers_fail(spark):
    panel, _ = V.parse_lines(lines_df(spark, "d,A\nt,1\n4/1/2001,many\n"))
    with pytest.raises(Exception, match="many"):
        panel.collect()


def test_landing_folder(spark, tmp_dir):
    folder = land(os.path.join(tmp_dir, "in"), {"1985-11-md.csv": vintage_text(8), "1985-12-md.csv": vintage_text(9)})
    panel, dim = V.read_vintages(spark, folder)
    assert {r.panel_id: r.n for r in panel.groupBy("panel_id").agg(F.count("*").alias("n")).collect()} == {"1985-11": 24, "1985-12": 27}
    assert dim.count() == 6
    resolved, _ = V.read_vintages(spark, folder, ref=date(1985, 12, 24))
    assert {r.panel_id for r in resolved.collect()} == {"1985-11"}
    pinned, _ = V.read_vintages(spark, folder, ref=date(1985, 12, 24), pin="1985-12")
    assert pinned.count() == 27
    with pytest.raises(ValueError, match="vintage without a file.*2004-02"):
        V.read_vintages(spark, folder, ref=date(2004, 3, 1))


def test_every_bad_file_is_named(spark, tmp_dir):
    empties = [f"1986-{m:02d}-md.csv" for m in range(1, 9)]
    folder = land(os.path.join(tmp_dir, "in"), {"1985-11-md.csv": vintage_text(3)} | dict.fromkeys(empties, ""))
    with pytest.raises(ValueError) as e:
        V.read_vintages(spark, folder)
    assert all(n in str(e.value) for n in empties)
    odd = land(os.path.join(tmp_dir, "odd"), {"notes.csv": "x"})
    with pytest.raises(ValueError, match="without a vintage.*notes.csv"):
        V.read_vintages(spark, odd)
    with pytest.raises(Exception, match="empty vintage"):
        lines_df(spark, "").collect()


def test_panel_to_lines_and_back(spark):
    panel, series = long_panel(spark, {"A": [1.5, None, 3.25], "B": [None, 2e7, 1e-3]}, month_dates(3), "v1", {"A": 2})
    back, dim = V.parse_lines(V.panel_to_lines(panel, series))
    assert sorted(back.collect()) == sorted(panel.collect())
    assert {r.series_id: r.tcode for r in dim.collect()} == {"A": 2, "B": None}


def test_wide_and_back(spark):
    frame = spark.createDataFrame([(date(2003, 5, 1), 4.0, None, float("nan")), (date(2003, 6, 1), 8.5, 5.0, 1.0)], "date date, `a b` double, `c.d` double, e double")
    long = unpivot_wide(frame, "w")
    assert long.count() == 6 and long.where("value is null").count() == 2  # NaN is missing
    assert [tuple(r)[2:] for r in to_wide(long, ["a b", "c.d", "e"]).collect()] == [(4.0, None, None), (8.5, 5.0, 1.0)]
    with pytest.raises(ValueError, match="case"):
        to_wide(long, ["Ab", "aB"])


def test_spine_is_dense_and_keeps_every_fact(spark):
    facts = [("p", "x", date(2000, 1, 1), 1.0), ("p", "x", date(2000, 4, 1), float("nan")), ("p", "y", date(2000, 6, 1), 2.0), ("q", "x", date(1999, 12, 1), 3.0)]
    panel, series = facts_to_panel(spark.createDataFrame(facts, "panel_id string, series_id string, date date, value double"))
    rows = panel.collect()
    assert sorted((r.panel_id, r.series_id, r.date, r.m) for r in rows) == sorted([("p", s, date(2000, m, 1), m - 1) for s in "xy" for m in range(1, 7)] + [("q", "x", date(1999, 12, 1), 0)])
    assert {(r.panel_id, r.series_id, r.date.month): r.value for r in rows if r.value is not None} == {("p", "x", 1): 1.0, ("p", "y", 6): 2.0, ("q", "x", 12): 3.0}
    assert sorted(map(tuple, series.collect())) == [("p", "x", 0), ("p", "y", 1), ("q", "x", 0)]
