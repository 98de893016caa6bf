"""Panels from fact tables (X3), the dense calendar spine (S10), wide <-> long.

A panel is monthly: ``date`` is the first day of the month. Every series of a
panel gets every month between the panel's first and last month, so per-series
row positions line up with the panel's rows (what a wide table guarantees).
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from macropanel.model import DATE, PANEL, SERIES, VALUE, nan_to_null
from macropanel.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def month_of(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def facts_to_panel(facts: DataFrame, step: str = "1 MONTH", by_series: bool = False, named: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Dense long panel from sparse monthly facts ``(panel_id, series_id, date, value)``.

    Returns ``(cells, series)``: cells carry ``m`` (month index in the panel)
    and ``pos`` (series rank by id); ``series`` has one row per series.

    The facts are the output of the big scan + aggregate and are tiny next to
    it (months x series), so they are checkpointed once to the session's
    reliable checkpoint folder, and so is the series dimension that is made
    from them. The spine of each series and its facts go through one exchange
    by (panel, series) and meet there in an aggregate by date; everything per
    series that follows stays in that partitioning.

    With ``by_series``, for panels of many series and few dates, the cells come as one row per series
    (see ``cells_of``): its facts meet once, and the spine is laid inside the row. The facts then have a
    date of a series once, and may have shorter keys for series ids, of which ``named`` makes these one to one.
    """
    ensure_checkpoint_dir(facts.sparkSession)
    if by_series:
        return _facts_to_series_rows(facts, step, named or (lambda key: key))
    facts = nan_to_null(facts).checkpoint(eager=True)
    bounds = facts.groupBy(PANEL).agg(F.min(DATE).alias("_lo"), F.max(DATE).alias("_hi"))
    rank = F.row_number().over(Window.partitionBy(PANEL).orderBy(SERIES)) - 1  # over one row per series
    series = facts.select(PANEL, SERIES).distinct().join(bounds, PANEL)
    series = series.select(PANEL, SERIES, rank.cast("int").alias("pos"), "_lo", "_hi").checkpoint(eager=True)
    spine = series.select(
        PANEL, SERIES, F.posexplode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias("m", DATE), "pos"
    )
    spine = spine.select(PANEL, SERIES, DATE, F.col("m").cast("int").alias("m"), "pos", F.lit(None).cast("double").alias(VALUE))
    seen = facts.select(PANEL, SERIES, DATE, F.lit(None).cast("int").alias("m"), F.lit(None).cast("int").alias("pos"), VALUE)
    both = spine.unionByName(seen).repartition(PANEL, SERIES)
    cells = both.groupBy(PANEL, SERIES, DATE).agg(F.max(VALUE).alias(VALUE), F.max("pos").alias("pos"), F.max("m").alias("m")).where("m is not null")
    return cells.select(PANEL, SERIES, DATE, VALUE, "pos", "m"), series.select(PANEL, SERIES, "pos")


def _differs(names: pa.ChunkedArray) -> np.ndarray:
    """Whether a name is another one than the name before it; nulls are equal."""
    a, b = names.slice(1), names.slice(0, len(names) - 1)
    other = pc.fill_null(pc.not_equal(a, b), False)
    return pc.or_(other, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy()


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts sorted by series -> a row per series; one that goes on in the next batch waits for it."""
    rest: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        table = rest if batch is None else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if table is None or not len(table):
            continue
        starts = np.flatnonzero(np.concatenate([[True], _differs(table.column(PANEL)) | _differs(table.column(SERIES))]))
        end = len(table) if batch is None else starts[-1]
        rest, table, starts = table.slice(end), table.slice(0, end).combine_chunks(), starts[starts < end]
        if len(starts):
            dated = pc.is_valid(table.column(DATE)).to_numpy()
            offsets = pa.array(np.concatenate([[0], dated.cumsum()])[np.concatenate([starts, [end]])], pa.int32())
            there = table.filter(pa.array(dated)).combine_chunks()
            lists = [pa.ListArray.from_arrays(offsets, pa.concat_arrays(there.column(c).chunks) if len(there) else pa.array([], table.schema.field(c).type)) for c in (DATE, VALUE)]
            heads = table.take(pa.array(starts)).combine_chunks()
            yield pa.RecordBatch.from_arrays([*[pa.concat_arrays(heads.column(c).chunks) for c in (PANEL, SERIES)], *lists], names=[PANEL, SERIES, "_d", "_v"])


def _facts_to_series_rows(facts: DataFrame, step: str, named: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """``facts_to_panel`` with a row per series. A date's value is looked up among its series' own: for some hundred dates."""
    dealt = nan_to_null(facts).repartition(PANEL, SERIES).sortWithinPartitions(PANEL, SERIES)
    key = facts.schema[SERIES].dataType.simpleString()
    seen = dealt.select(PANEL, SERIES, DATE, VALUE).mapInArrow(_gather, f"{PANEL} string, {SERIES} {key}, _d array<date>, _v array<double>")
    seen = seen.withColumn(SERIES, named(F.col(SERIES))).checkpoint(eager=True)
    bounds = seen.groupBy(PANEL).agg(F.min(F.array_min("_d")).alias("_lo"), F.max(F.array_max("_d")).alias("_hi"))
    rank = F.row_number().over(Window.partitionBy(PANEL).orderBy(SERIES)) - 1  # over one row per series
    series = seen.select(PANEL, SERIES, rank.cast("int").alias("pos")).checkpoint(eager=True)
    spine = bounds.select(PANEL, F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}")).alias("_s")).where("_s is not null").checkpoint(eager=True)
    value = F.transform("_s", lambda x: F.get("_v", (F.array_position("_d", x) - 1).cast("int")))
    return seen.join(F.broadcast(spine), PANEL).select(PANEL, SERIES, F.col("_s").alias("d"), value.alias("v")), series


def cells_of(rows: DataFrame) -> DataFrame:
    """The long panel of rows of series (panel, series, dates ``d``, values ``v``)."""
    return rows.select(PANEL, SERIES, F.inline(F.arrays_zip(F.col("d").alias(DATE), F.col("v").alias(VALUE))))


def month_brand_facts(lineitem: DataFrame, part: DataFrame, panel_id: str = "brand_revenue") -> DataFrame:
    """Monthly shipped revenue per part brand: join, then an aggregate that combines map-side to months x brands.

    lineitem is shuffled at most once, for the join, and not at all while part fits the broadcast threshold.
    """
    li = lineitem.select(
        "l_partkey", month_of(F.col("l_shipdate")).alias(DATE), F.col("l_extendedprice").cast("decimal(18,2)").alias("px")
    )
    brands = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias(SERIES))
    return (
        li.join(brands, "l_partkey")
        .groupBy(DATE, SERIES)
        .agg(F.sum("px").cast("double").alias(VALUE))
        .select(F.lit(panel_id).alias(PANEL), SERIES, DATE, VALUE)
    )


def month_nation_orders(orders: DataFrame, customer: DataFrame, panel_id: str = "nation_orders") -> DataFrame:
    """Monthly order value per customer nation: join, then combine map-side."""
    o = orders.select(
        "o_custkey", month_of(F.col("o_orderdate")).alias(DATE), F.col("o_totalprice").cast("decimal(18,2)").alias("px")
    )
    nat = customer.select(
        F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias(SERIES)
    )
    return (
        o.join(nat, "o_custkey")
        .groupBy(DATE, SERIES)
        .agg(F.sum("px").cast("double").alias(VALUE))
        .select(F.lit(panel_id).alias(PANEL), SERIES, DATE, VALUE)
    )


def day_event_values(events: DataFrame, panel_id: str = "event_values") -> DataFrame:
    """Daily summed event value per event type (no join; partial aggregation only)."""
    return (
        events.select(F.to_date("ts").alias(DATE), F.upper(F.col("event_type")).alias(SERIES), "value")
        .groupBy(DATE, SERIES)
        .agg(F.sum("value").alias(VALUE))
        .select(F.lit(panel_id).alias(PANEL), SERIES, DATE, VALUE)
    )


def unpivot_wide(wide: DataFrame, panel_id: str, series_cols: list[str] | None = None) -> DataFrame:
    """Wide (date + one column per series) -> long panel."""
    cols = series_cols or [c for c in wide.columns if c != DATE]
    long = wide.unpivot([DATE], [F.col(f"`{c}`").cast("double").alias(c) for c in cols], SERIES, VALUE)
    return nan_to_null(long.select(F.lit(panel_id).alias(PANEL), SERIES, DATE, VALUE))


def to_wide(panel: DataFrame, series_ids: list[str], value_col: str = VALUE) -> DataFrame:
    """Export view: one row per (panel, date), one column per series, in the given order.

    The explicit pivot list avoids a distinct-values job; names differing only
    by case would collide in Spark's case-insensitive resolution, so reject them.
    """
    lowered = [s.lower() for s in series_ids]
    if len(set(lowered)) != len(lowered):
        raise ValueError("series ids collide when case is ignored; wide export is not possible")
    return panel.groupBy(PANEL, DATE).pivot(SERIES, series_ids).agg(F.first(value_col)).orderBy(PANEL, DATE)
