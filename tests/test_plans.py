"""Physical-plan properties the design relies on, read from the registered queries."""

from __future__ import annotations

import re

import pytest

from macropanel.plans.catalog import QUERIES
from macropanel.plans.inputs import brand_fixture_panel
from macropanel.sources import panels as P

SMOKE = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    """The plan as it ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(params=["10485760", "-1"], ids=["broadcast", "no-broadcast"])
def threshold(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["data_card", "transform_all"])
def test_per_series_chain_runs_behind_one_exchange_by_series(spark, threshold, name):
    plan = plan_text(QUERIES[name](spark, SMOKE))
    windows = re.findall(r"Window \[.*?\], \[(panel_id#\d+(?:, series_id#\d+)?)\]", plan)
    assert windows and all("series_id" in w for w in windows)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)
    by_series = [k for k in keys if re.fullmatch(r"panel_id#\d+, series_id#\d+", k)]
    assert 1 <= len(by_series) <= 3  # the cells once, and the series dimension where it joins them (tcodes, card)
    assert not any("date" in k for k in keys)
    # rank and count, the four quantile picks, the lags (and the leading flag): no window of the chain is split up
    assert plan.count("Window [") <= 6


def test_cells_of_a_panel_are_spread_by_series(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else a panel this small is one partition again
    try:
        cells, _ = brand_fixture_panel(spark, SMOKE)
        parts = cells.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(n > 0 for n in parts) > 1


def test_lineitem_is_shuffled_at_most_once(spark, threshold):
    facts = P.month_brand_facts(P.read_table(spark, SMOKE, "lineitem"), P.read_table(spark, SMOKE, "part"))
    plan = plan_text(facts)
    by_part = re.findall(r"Exchange hashpartitioning\(l_partkey", plan)
    assert len(by_part) == (0 if threshold != "-1" else 2)  # lineitem's and part's side of the join
    assert re.search(r"partial_sum", plan)


def test_fact_scan_prunes_columns(spark):
    facts = P.month_brand_facts(P.read_table(spark, SMOKE, "lineitem"), P.read_table(spark, SMOKE, "part"))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", facts._jdf.queryExecution().executedPlan().toString())
    assert "l_partkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz" in scans
    assert "p_partkey:bigint,p_brand:string" in scans
