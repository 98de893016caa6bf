"""Mixing sources to target weights: tokens per source, repetition rates, floor(rate) copies plus a coin.

``source_targets`` is one aggregation to a row per source; the water-filling that follows works on that
table only. ``mix`` gives every document its number of copies, ``emit`` writes them out as rows.

Defined results: a null text has size 0; a null source is a source of its own, ordered last; a source without
words has target 0 and its documents rate 0 (they are taken 0 times); rows that repeat a (doc_id, text) pair
are the same document and share one coin, so reruns and repeats agree; equal documents of other ids have coins of
their own; the words of a very long text are all counted; an empty table gives an empty mix;
columns of the input that this module also makes are never read: only doc_id, text and source are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macropanel.llm.common import Scratch, as_row, whole

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"


def n_words(text: str = "text") -> Column:
    """Number of maximal runs of characters other than ASCII white space."""
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def coin(seed: str = SEED) -> Column:
    """A number in [0, 1) from the document's own values: the first 32 bits of an MD5."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(whole().cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def ranked_sources(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """source, source_size and the source's place in code-point order, null last.

    A range-partitioned sort and the row counts of its partitions give the places; no task and no driver list
    holds all sources.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = by_source.orderBy(F.col("source").asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id())
    ordered = scratch.save(ordered, "sources")
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r["p"], r["n"]) for r in ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    before, rows = 0, []
    for p, n in counts:
        rows.append((p, before))
        before += n
    starts = ordered.sparkSession.createDataFrame(rows, "p long, before long")
    return ordered.join(starts, part == F.col("p")).select("source", "source_size", (F.col("before") + within).alias("place"))


def source_targets(sizes: DataFrame, scratch: Scratch, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """A row per source: source, source_size, target.

    Sources share ``share`` times all words by weight. A source whose part would pass ``most`` times its size
    stops there and the rest is shared anew by weight among the others, until none is above: each round is one
    aggregate of the sources table to three numbers.
    """
    place = F.col("place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    sources = scratch.save(
        ranked_sources(sizes, scratch).select("source", "source_size", weight.alias("w"), (F.col("source_size") * F.lit(most)).alias("cap")), "ranked"
    )
    total = sources.agg((F.sum("source_size") * F.lit(share)).alias("t")).first()["t"] or 0.0
    level = 0.0
    while True:
        above = F.col("cap") <= F.col("w") * F.lit(level)
        r = sources.agg(F.sum(F.when(above, F.col("cap")).otherwise(0.0)).alias("held"), F.sum(F.when(above, 0.0).otherwise(F.col("w"))).alias("w")).first()
        if not r["w"]:
            break  # every source stops at its cap (share >= most, or no words at all)
        raised = (total - r["held"]) / r["w"]
        if raised <= level:
            break
        level = raised
    return sources.select("source", "source_size", F.least("cap", F.col("w") * F.lit(level)).alias("target"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED, keep: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, rate and copies of every document (``keep``: its row as ``row``).

    The sources table joins back by the planner's choice: it is a written table of known size, broadcast under
    the session's threshold and joined by a shuffle with AQE's skew handling beyond it.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    row = [as_row(docs)] if keep else []
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words().alias("size"), coin(seed).alias("coin"), *row)
    if not keep:
        sized = scratch.save(sized, "sized")
    targets = scratch.save(source_targets(sized.select("source", "size"), scratch, weights, share, most), "targets")
    t = targets.select(F.col("source").alias("_s"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    out = sized.join(t, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn("rate", rate)
    copies = F.floor("rate") + F.when(F.col("coin") < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", copies.cast("long").alias("copies"), *(["row"] if keep else []))


def emit(docs: DataFrame, **params) -> DataFrame:
    """The mixture itself: every document's row as often as the mix takes it."""
    taken = mix(docs, keep=True, **params).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op7: a row per document with its size, its source's size and target, and the words taken."""
    m = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


#: DuckDB: the level of the water-filling in closed form (the k sources of the smallest cap per weight are at their caps).
ORACLE = r"""
WITH d AS (
  SELECT doc_id, text, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM s),
l AS (SELECT *, (SELECT 1.5::DOUBLE * sum(source_size) FROM s) AS t,
  coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
  sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM r),
level AS (SELECT coalesce(min_by((t - held) / rest, cap / w) FILTER (WHERE (t - held) / rest < cap / w), max(cap / w)) AS x FROM l),
g AS (SELECT source, source_size, least(cap, w * x) AS target, CASE WHEN source_size > 0 THEN least(cap, w * x) / source_size ELSE 0 END AS rate FROM r, level),
c AS (SELECT doc_id, size, source_size, target, rate,
  ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS coin
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""
