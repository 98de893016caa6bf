from __future__ import annotations

import glob
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import long_panel, month_dates, vintage_rows, vintage_text
from macropanel.model import Params
from macropanel.operators.contracts import ContractError, check_input, enforce, violations
from macropanel.plans.prepare import prepare, write_all
from macropanel.sinks.artifacts import manifest
from macropanel.sources import vintage as V

P = Params(k=1, max_iter=5, balanced_cutoff=date(1990, 6, 1))


def rules(error) -> set[tuple[str, str, str]]:
    return {(a, r, c) for a, r, c, _ in error.value.failures}


def nothing_written(folder: str) -> bool:
    return not glob.glob(os.path.join(folder, "**", "*.*"), recursive=True)


@pytest.fixture(scope="module")
def two(spark):
    cols = {"A": [4.0 + (i * 7 % 5) for i in range(14)], "B": [None, None, *[30 - 1.5 * i for i in range(12)]]}
    return long_panel(spark, cols, month_dates(14), tcodes={"A": 2, "B": 1})


def test_every_failure_of_every_artifact_is_told_at_once(spark, two):
    panel, _ = two
    twice = panel.unionByName(panel.where("series_id = 'B'"))
    undated = panel.withColumn("date", F.when(F.col("value") < 5, F.lit(None)).otherwise(F.col("date")).cast("date"))
    with pytest.raises(ContractError) as e:
        enforce({"raw": twice, "transformed": undated, "imputed": panel})
    assert {("raw", "unique", "series_id+date"), ("transformed", "not_null", "date"), ("imputed", "not_null", "value")} <= rules(e)
    counts = {(a, r): n for a, r, _, n in e.value.failures}
    assert counts[("raw", "unique")] == 14 and counts[("imputed", "not_null")] == 2
    enforce({"raw": panel, "transformed": panel})  # a missing value is fine before imputation


def test_card_contract_counts_each_rule(spark):
    row = ("p", "A", 0, None, None, -1, 2, 3, 0.5, 1.5, -0.1, None, None)
    card = spark.createDataFrame([row, row], "panel_id string, series_id string, pos int, first_obs_date date, last_obs_date date, n_obs long, n_missing_leading long, n_missing_internal long, frac_missing double, frac_missing_leading double, frac_missing_internal double, kept boolean, drop_reason string")
    got = {(r.rule, r.column): r.n for r in violations(card, "data_card").collect() if r.n}
    assert got == {("ge_0", "n_obs"): 2, ("in_0_1", "frac_missing_leading"): 2, ("in_0_1", "frac_missing_internal"): 2, ("not_null", "kept"): 2, ("unique", "series_id"): 1}
    extra = {(r.rule, r.column): r.n for r in violations(card.withColumn("more", F.lit(1)), "data_card").collect()}
    assert extra[("strict_columns", "*")] == 1


def test_input_gate_names_duplicates_and_holes_before_any_work(spark, two):
    panel, series = two
    first = panel.where("series_id = 'A' and date = '1990-03-01'")
    with pytest.raises(ContractError) as e:
        prepare(panel.unionByName(first), series, P)
    assert rules(e) == {("input", "unique", "series_id+date")}
    with pytest.raises(ContractError) as e:
        prepare(panel.exceptAll(first), series, P)
    assert rules(e) == {("input", "dense", "cells of panel p")}
    with pytest.raises(ContractError) as e:
        check_input(panel.unionByName(panel.withColumn("panel_id", F.lit(None).cast("string"))))
    assert ("input", "not_null", "panel_id") in rules(e)


def test_lacking_column_is_the_caller_s_error(spark, two):
    with pytest.raises(ValueError, match="value"):
        prepare(two[0].drop("value"), two[1], P)


@pytest.mark.parametrize("artifact", ["raw", "panel", "mask", "card", "panel_balanced", "mask_balanced"])
def test_gate_holds_the_very_frames_that_are_written(spark, two, tmp_dir, artifact):
    p = prepare(*two, P)
    frame = getattr(p, artifact)
    setattr(p, artifact, frame.unionByName(frame.limit(1)))
    with pytest.raises(ContractError) as e:
        write_all(p, tmp_dir)
    name = {"panel": "transformed", "card": "data_card", "panel_balanced": "transformed_balanced"}.get(artifact, artifact)
    assert {a for a, _, _ in rules(e)} == {name}
    assert nothing_written(tmp_dir)


def test_null_in_the_imputed_panel_is_refused(spark, two, tmp_dir):
    p = prepare(*two, P)
    p.panel = p.panel.withColumn("value", F.when(F.col("date") != "1990-05-01", F.col("value")))
    with pytest.raises(ContractError) as e:
        write_all(p, tmp_dir)
    assert rules(e) == {("transformed", "not_null", "value")} and nothing_written(tmp_dir)


def test_from_published_file_to_artifacts(spark, tmp_dir):
    landing, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(landing)
    with open(os.path.join(landing, "1985-12-md.csv"), "w", newline="") as f:
        f.write(vintage_text(12))
    panel, series = V.read_vintages(spark, landing)
    p = prepare(panel, series, Params(k=2, balanced_cutoff=date(1985, 5, 1)))
    s = p.summary.first()
    assert (s.rows, s.series_input, s.series_kept, s.series_dropped) == (10, 3, 3, 0)
    man = write_all(p, out, now=datetime(2031, 1, 31, 23, 59, tzinfo=timezone.utc))
    kinds = {r.artifact: r.n_rows for r in man.collect()}
    assert {"raw": 36, "transformed": 30, "mask": 30, "data_card": 3, "validation": 3}.items() <= kinds.items()
    assert glob.glob(os.path.join(out, "transformed", "panel_id=1985-12", "year=2031", "month=01", "*.zstd.parquet"))
    rep = spark.read.json(os.path.join(out, "imputation")).first()
    assert rep.n_kept == 3 and rep.pipeline_version == "v2"
    raw = {(r.series_id, r.date): r.value for r in spark.read.parquet(os.path.join(out, "raw")).collect()}
    assert raw[("OUTPUT", date(1985, 3, 1))] == vintage_rows()["OUTPUT"][0]
    # the same run again, after the end of the month, replaces itself
    write_all(p, out, now=datetime(2031, 1, 31, 23, 59, tzinfo=timezone.utc))
    assert spark.read.parquet(os.path.join(out, "transformed")).count() == 30


def test_checksum_tells_content_and_not_order(spark, two):
    panel, _ = two
    a = manifest("raw", panel, "t", "t").first()
    b = manifest("raw", panel.orderBy(F.desc("date"), F.rand(5)).repartition(6), "t", "t").first()
    c = manifest("raw", panel.withColumn("value", F.col("value") * 2), "t", "t").first()
    assert a.checksum == b.checksum != c.checksum
    assert (a.n_rows, a.n_series, a.date_first, a.date_last) == (28, 2, "01/1990", "02/1991")
