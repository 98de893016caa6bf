from __future__ import annotations

import os
import subprocess
import sys
from datetime import date, datetime, timezone

import pytest

from conftest import vintage_text
from macropanel.model import Params
from macropanel.streaming.vintages import start_vintage_stream

SMOKE = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PARAMS = Params(k=1, max_iter=4, balanced_cutoff=date(1985, 12, 1))


def folders(tmp_dir: str) -> tuple[str, str, str]:
    landing, out, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "out", "ckpt"))
    os.makedirs(landing)
    return landing, out, ckpt


def land(landing: str, name: str, text: str) -> None:
    with open(os.path.join(landing, name), "w", newline="") as f:
        f.write(text)


def test_each_vintage_is_taken_once_and_in_small_batches(spark, tmp_dir):
    landing, out, ckpt = folders(tmp_dir)
    land(landing, "1985-11-md.csv", vintage_text(8))
    land(landing, "1985-12-md.csv", vintage_text(9))
    q = start_vintage_stream(spark, landing, out, ckpt, PARAMS, max_files_per_trigger=1)
    q.awaitTermination(400)
    assert sum(p["numInputRows"] > 0 for p in q.recentProgress) == 2  # one file per batch
    got = spark.read.parquet(os.path.join(out, "transformed"))
    assert {r.panel_id: r["count"] for r in got.groupBy("panel_id").count().collect()} == {"1985-11": 18, "1985-12": 21}
    again = start_vintage_stream(spark, landing, out, ckpt, PARAMS)
    again.awaitTermination(400)
    assert again.lastProgress is None or again.lastProgress["numInputRows"] == 0


@pytest.mark.parametrize(("name", "text", "why"), [("1985-12-md.csv", "", "empty vintage file"), ("readme.csv", "hello", "without a vintage")])
def test_bad_file_fails_its_batch_by_name(spark, tmp_dir, name, text, why):
    landing, out, ckpt = folders(tmp_dir)
    land(landing, "1985-11-md.csv", vintage_text(8))
    land(landing, name, text)
    q = start_vintage_stream(spark, landing, out, ckpt, PARAMS)
    with pytest.raises(Exception, match=f"{why}.*{name}"):
        q.awaitTermination(400)
    assert not os.path.exists(os.path.join(out, "transformed"))


def test_retry_after_the_month_ends_leaves_one_copy(spark, tmp_dir):
    """The first try of a batch dies after its writes; the retry, in the next month, replaces them."""
    import macropanel.streaming.vintages as stream

    landing, out, ckpt = folders(tmp_dir)
    land(landing, "1985-12-md.csv", vintage_text(9))
    real = stream.write_all

    def dies(*args):
        real(*args)
        raise RuntimeError("lost the driver")

    stream.write_all = dies
    try:
        q = start_vintage_stream(spark, landing, out, ckpt, PARAMS, started=datetime(2030, 6, 30, 23, 58, tzinfo=timezone.utc))
        with pytest.raises(Exception, match="lost the driver"):
            q.awaitTermination(400)
    finally:
        stream.write_all = real
    start_vintage_stream(spark, landing, out, ckpt, PARAMS, started=datetime(2030, 7, 1, 0, 3, tzinfo=timezone.utc)).awaitTermination(400)
    got = spark.read.parquet(os.path.join(out, "transformed"))
    assert got.count() == 21 and {(r.year, r.month) for r in got.select("year", "month").distinct().collect()} == {(2030, 6)}


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert len(df.collect()) == 25 and "kept" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_works_without_the_optional_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "macropanel.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "data_card" in e.queries() and not any(q.startswith("op") or q == "pipeline" for q in e.queries())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=REPO, env=os.environ | {"PYTHONPATH": REPO}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_brand_panel_matches_fixture_expectations(spark):
    """Independent expectations for the month x brand panel at sf0.001 (FIXTURES.md §2)."""
    import __spark_entry__ as E

    q = E.queries()
    rep = q["em_pca_report"](spark, SMOKE).first()
    assert rep.dropped_series == ["Brand#15", "Brand#9"] and rep.n_kept == 23
    assert (rep.n_iter, rep.converged) == (50, False) and round(rep.final_delta, 4) == 0.0107
    assert q["balanced_series"](spark, SMOKE).count() == 19
    li = q["leading_internal"](spark, SMOKE).groupBy().sum("n_missing_leading", "n_missing_internal").first()
    assert tuple(li) == (85, 342)
    assert q["panel_build"](spark, SMOKE).where("value IS NULL").count() == 351
