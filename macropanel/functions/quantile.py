"""Exact per-group order statistics without collecting a group.

Ranks come from ``row_number`` over (key ORDER BY value NULLS LAST), so the
work is a sort that spills, never a list held in memory. A group too long for
one task's sort is served by ``select_ranks``: passes of histograms, each over
all partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macropanel.session import ensure_checkpoint_dir

#: Buckets of a pass of ``select_ranks``.
BUCKETS = 4096


def rank_columns(keys: list[str], value: str) -> tuple[Column, Column]:
    """(0-based rank among non-null values, count of non-null values) over ``keys``."""
    w_rank = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    w_all = Window.partitionBy(*keys)
    return (F.row_number().over(w_rank) - 1), F.count(value).over(w_all)


def quantile_rank(q: float, n: Column, method: str = "nearest") -> Column:
    """0-based rank holding quantile ``q`` of ``n`` sorted values.

    ``nearest``: rank ``round(q*(n-1))`` with halves rounded up (the rule the
    outlier band is defined with). ``lower`` / ``higher`` are floor / ceil.
    """
    pos = F.lit(float(q)) * (n - 1)
    if method == "nearest":
        return F.round(pos).cast("long")
    if method == "lower":
        return F.floor(pos).cast("long")
    if method == "higher":
        return F.ceil(pos).cast("long")
    raise ValueError(f"unknown quantile method: {method}")


def pick(rank: Column, at: Column, value: str) -> Column:
    """Aggregate/window expression: the value whose rank equals ``at``."""
    return F.max(F.when(rank == at, F.col(value)))


def select_ranks(cells: DataFrame, targets: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exact values at 0-based ranks: ``targets`` (keys, target, rank) -> (keys, target, picked). Nulls have no rank.

    Every target has an interval that its value lies in, at first the group's least and greatest value. A pass counts the
    values inside by bucket of the interval, combining map-side to ``BUCKETS`` rows per target and task, and moves to the
    bucket that holds the rank: the interval becomes that bucket's own least and greatest value and the rank is counted
    from there. Bucket numbers grow with the value whatever the rounding, so the choice is exact. A target is
    done when its interval is one value. No group is sorted or gathered; a hot group is as spread as its rows are.
    """
    spark = cells.sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ranks-{uuid.uuid4().hex}"
    seen = cells.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    ends = seen.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))

    def save(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    at = save(targets.select(*keys, "target", F.col("rank").cast("long").alias("_r")).join(ends, keys), "at-0")
    done = at.where("_lo = _hi")
    n = 0
    while not (open_ := at.where("_lo < _hi")).isEmpty():
        n += 1
        # the planner broadcasts the intervals while they are small; a written table has a known size
        inside = seen.join(open_, keys).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        # halves keep the difference of two large values finite
        whole = F.col("_hi") / 2 - F.col("_lo") / 2
        # (neighbours among the smallest doubles have equal halves)
        share = F.when(whole > 0, (F.col("_v") / 2 - F.col("_lo") / 2) / whole).otherwise((F.col("_v") > F.col("_lo")).cast("double"))
        counted = inside.groupBy(*keys, "target", "_r", F.floor(share * (BUCKETS - 1)).alias("_b")).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        below = F.sum("_n").over(Window.partitionBy(*keys, "target").orderBy("_b")) - F.col("_n")  # over BUCKETS rows of a target
        placed = counted.withColumn("_below", below).where((F.col("_r") >= F.col("_below")) & (F.col("_r") < F.col("_below") + F.col("_n")))
        at = save(placed.select(*keys, "target", (F.col("_r") - F.col("_below")).alias("_r"), "_lo", "_hi"), f"at-{n}")
        done = done.unionByName(at.where("_lo = _hi"))
    return done.select(*keys, "target", F.col("_lo").alias("picked"))
