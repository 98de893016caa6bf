"""Connected components of a graph kept in Spark: alternating large-star and small-star steps.

Each step is one combining minimum per vertex and one join back; AQE can split the join at a vertex of many
edges. The loop ends when the edges are stars, each pointing at its component's smallest vertex. Every step's
edges are written to the checkpoint folder, so a lost executor costs no earlier step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macropanel.llm.common import Scratch


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))).select("col.*")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _stars(e: DataFrame) -> bool:
    """Every vertex is a leaf of one edge or a centre, not both."""
    ends = e.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("leaf")), F.struct(F.col("b").alias("v"), F.lit(0).alias("leaf"))))).select("col.*")
    odd = ends.groupBy("v").agg(F.sum("leaf").alias("n"), F.min("leaf").alias("c")).where("n > 1 or (n = 1 and c = 0)")
    return odd.isEmpty()


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """edges (a, b: any orderable type, no nulls) -> (a, b): every vertex but the smallest of its component, and that smallest."""
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, k = scratch.save(pairs, f"{name}-0"), 0
    while not _stars(e):
        e = scratch.save(_small_star(_large_star(e)), f"{name}-{k + 1}")
        scratch.drop(f"{name}-{k}")
        k += 1
    return e
