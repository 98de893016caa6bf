"""Digests, runs taken whole, failing rows, split files and the quarantine of the stream."""

from __future__ import annotations

import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

import macropanel.plans.prepare as prepare_module
from conftest import long_panel, month_dates, vintage_rows, vintage_text
from macropanel.model import Params
from macropanel.operators import contracts as C
from macropanel.plans.prepare import prepare
from macropanel.sinks import published as R
from macropanel.sinks.digest import table_digest
from macropanel.sources import vintage as V
from macropanel.streaming.vintages import read_quarantine, start_vintage_stream
from test_ingest import cells, land

P = Params(k=1, max_iter=3, balanced_cutoff=date(1990, 6, 1))


def digest(df):
    return df.transform(lambda d: table_digest(d, ["panel_id"])).select("n_rows", "digest_a", "digest_b").first()


@pytest.fixture()
def panel(spark):
    return long_panel(spark, {"A": [1.0, 2.0, None, 3.5, 5.0, 4.0, 6.0, 7.5], "B": [float(i * i % 7) for i in range(8)]}, month_dates(8))


def test_digest_of_a_multiset(spark):
    rows = lambda *values: spark.createDataFrame([("p", v) for v in values], "panel_id string, value double")
    assert digest(rows(1.0, 1.0)) != digest(rows(2.0, 2.0))
    assert digest(rows(1.0, 1.0, 2.0)) != digest(rows(1.0, 2.0, 2.0))
    assert digest(rows(1.0, None, 2.0)) == digest(rows(2.0, 1.0, None).repartition(3))
    assert digest(rows(0.1 + 0.2)) != digest(rows(0.3)) and digest(rows(0.0)) == digest(rows(-0.0))
    odd = spark.createDataFrame([("p", "a|b", ["x", None])], "panel_id string, `c.d` string, e array<string>")
    assert digest(odd).n_rows == 1


def test_published_run_is_read_back_whole(spark, panel, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    with pytest.raises(ValueError, match="no published run"):
        R.read_published(spark, out, "raw")
    p = prepare(*panel, P)
    run = R.publish(p, out, datetime(2030, 5, 2, tzinfo=timezone.utc))
    got = R.read_published(spark, out, "transformed")
    assert sorted(map(tuple, got.select("series_id", "date", "value").collect())) == sorted(map(tuple, p.panel.select("series_id", "date", "value").collect()))
    assert {(r.year, r.month, r.run) for r in got.select("year", "month", "run").distinct().collect()} == {("2030", "05", run)}
    assert R.read_published(spark, out, "imputation").first().n_kept == 2
    back = {(r.artifact): (r.n_rows, r.digest_a, r.digest_b) for r in R.published_digests(spark, out, ["raw", "mask"]).collect()}
    assert back["raw"] == tuple(digest(p.raw)) and back["mask"] == tuple(digest(p.mask))


def test_failed_run_leaves_the_previous_one(spark, panel, tmp_dir, monkeypatch):
    """Every artifact in turn fails to be written: readers see the run before, whole, and then the next one."""
    out, now = os.path.join(tmp_dir, "out"), datetime(2030, 5, 2, tzinfo=timezone.utc)
    R.publish(prepare(*panel, P), out, now)
    names = ["raw", "transformed", "mask", "data_card"]
    before = [tuple(r) for r in R.published_digests(spark, out, names).orderBy("artifact").collect()]
    changed = prepare(panel[0].withColumn("value", F.col("value") + 1), panel[1], P)
    real = prepare_module.W.write_parquet
    for bad in ("raw", "validation", "manifest"):

        def write(df, path, year, month, bad=bad):
            if path.endswith(f"/{bad}"):
                raise OSError("disk gone")
            real(df, path, year, month)

        monkeypatch.setattr(prepare_module.W, "write_parquet", write)
        with pytest.raises(OSError, match="disk gone"):
            R.publish(changed, out, now)
        assert [tuple(r) for r in R.published_digests(spark, out, names).orderBy("artifact").collect()] == before
    monkeypatch.setattr(prepare_module.W, "write_parquet", real)
    R.publish(changed, out, now)
    after = [tuple(r) for r in R.published_digests(spark, out, names).orderBy("artifact").collect()]
    assert [r[1] for r in after] == [r[1] for r in before] and after != before  # the same month: replaced


def test_catalog_keeps_other_months_and_panels(spark, panel, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    p = prepare(*panel, P)
    first = R.publish(p, out, datetime(2030, 5, 2, tzinfo=timezone.utc))
    second = R.publish(p, out, datetime(2030, 6, 2, tzinfo=timezone.utc))
    assert {tuple(r) for r in R.catalog(spark, out).collect()} == {("p", "2030", "05", first), ("p", "2030", "06", second)}
    assert R.read_published(spark, out, "raw").count() == 2 * p.raw.count()


def test_failing_rows_count_up_to_the_violations(spark, panel, tmp_dir):
    p = prepare(*panel, P)
    raw = p.raw.withColumn("date", F.when(F.col("date") != "1990-03-01", F.col("date"))).unionByName(p.raw.where("series_id = 'A'"))
    card = p.card.withColumn("n_obs", -F.col("n_obs")).withColumn("frac_missing", F.lit(1.25))
    found = C.all_failures({"raw": raw, "data_card": card}).collect()
    counts = {}
    for r in found:
        counts[(r.artifact, r.rule, r.column)] = counts.get((r.artifact, r.rule, r.column), 0) + r.n
    want = {(r.artifact, r.rule, r.column): r.n for r in C.all_violations({"raw": raw, "data_card": card}).where("n > 0").collect()}
    assert counts == want and want[("data_card", "in_0_1", "frac_missing")] == 2
    values = {(r.column, r.value) for r in found if r.artifact == "data_card"}
    assert {("n_obs", str(-r.n_obs)) for r in p.card.collect()} <= values and ("frac_missing", "1.25") in values
    assert {(r.panel_id, r.series_id, r.date) for r in found if r.column == "date"} == {("p", "A", None), ("p", "B", None)}
    with pytest.raises(C.ContractError) as e:
        C.enforce({"raw": raw, "data_card": card})
    assert spark.read.parquet(e.value.table).count() == len(found) and e.value.table in str(e.value)


def test_file_in_several_splits_parses_to_the_same_panel(spark, tmp_dir):
    folder = land(os.path.join(tmp_dir, "in"), {"1985-12-md.csv": vintage_text(9), "1985-11-md.csv": vintage_text(7)})
    want = [sorted(map(tuple, x.collect()), key=str) for x in V.parse_lines(V.split_lines(V.read_vintage_files(spark, folder)))]
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = V.read_vintage_lines(spark, folder)
        assert spark.read.text(folder).rdd.getNumPartitions() > 4
        got = [sorted(map(tuple, x.collect()), key=str) for x in V.parse_lines(lines)]
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10")  # the code line begins in a later split
        with pytest.raises(Exception, match="no code line in the first split"):
            V.read_vintage_lines(spark, folder).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == want


def test_one_vintage_lists_nothing_else(spark, tmp_dir, monkeypatch):
    folder = land(os.path.join(tmp_dir, "in"), {"1985-11-md.csv": vintage_text(8), "1985-12-md.csv": vintage_text(9), "notes.csv": "x"})
    asked = []
    real = V.listing
    monkeypatch.setattr(V, "listing", lambda s, path: asked.append(path) or real(s, path))
    panel, _ = V.read_vintages(spark, folder, pin="1985-12")
    assert panel.count() == 27 and asked == [f"{folder}/1985-12-md.csv"]


def test_landed_files_read_back(spark, tmp_dir):
    panel, series = long_panel(spark, {"A": [1.5, None, 3.25], "B": [None, 2e7, 1e-3]}, month_dates(3), "1999-04", {"A": 2})
    other = panel.withColumn("panel_id", F.lit("1999-05"))
    both = V.panel_to_lines(panel.unionByName(other), series.unionByName(series.withColumn("panel_id", F.lit("1999-05"))))
    assert V.land_vintages(both, os.path.join(tmp_dir, "in")) == ["1999-04", "1999-05"]
    assert sorted(f for f in os.listdir(os.path.join(tmp_dir, "in")) if f[0] != ".") == ["1999-04-md.csv", "1999-05-md.csv"]
    back, dim = V.read_vintages(spark, os.path.join(tmp_dir, "in", "*-md.csv"))
    assert cells(back.where("panel_id = '1999-05'")) == cells(panel) and dim.count() == 4


def test_stream_sets_bad_files_aside(spark, tmp_dir):
    """Bad files of every kind, one of no length among them, and good files in later batches too."""
    landing, out, ckpt, aside = (os.path.join(tmp_dir, d) for d in ("landing", "out", "ckpt", "aside"))
    good = vintage_text(8)
    bad = {
        "1985-01-md.csv": "",
        "readme.csv": "hello",
        "1985-02-md.csv": "sasdate,A",
        "1985-03-md.csv": "d,A\nt,1\n4/31/2001,1\n",
        "1985-04-md.csv": "d,A\nt,1\n4/1/2001,many\n",
        "1985-05-md.csv": "d,A\nt,9\n4/1/2001,1\n",
        "1985-06-md.csv": "d,A\nt,1\n4/1/2001,1\n4/1/2001,2\n",
        "1985-07-md.csv": "d,A\nt,1\n,1\n",
    }
    land(landing, bad | {"1985-11-md.csv": good})
    params = Params(k=1, max_iter=2, balanced_cutoff=date(1985, 12, 1))
    start_vintage_stream(spark, landing, out, ckpt, params, quarantine=aside).awaitTermination(400)
    land(landing, {"1985-12-md.csv": vintage_text(9), "1986-01-md.csv": ""})
    start_vintage_stream(spark, landing, out, ckpt, params, quarantine=aside).awaitTermination(400)
    got = spark.read.parquet(os.path.join(out, "transformed"))
    assert {r.panel_id: r["count"] for r in got.groupBy("panel_id").count().collect()} == {"1985-11": 18, "1985-12": 21}
    rows = {os.path.basename(r.path): (r.reason, r.epoch) for r in read_quarantine(spark, aside).collect()}
    assert rows == {
        "1985-01-md.csv": ("empty vintage file", 0),
        "readme.csv": ("file name without a vintage", 0),
        "1985-02-md.csv": ("no code line", 0),
        "1985-03-md.csv": ("malformed date", 0),
        "1985-04-md.csv": ("malformed number", 0),
        "1985-05-md.csv": ("unknown tcode", 0),
        "1985-06-md.csv": ("date stands twice", 0),
        "1985-07-md.csv": ("no dated line", 0),
        "1986-01-md.csv": ("empty vintage file", 1),
    }
    assert vintage_rows()  # the good files' content is tested with the reader
