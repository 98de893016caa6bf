"""Line dedup, native: overlapping three-line windows, hashed; later occurrences of a window are removed.

A text is split at "\\n". Every three consecutive lines, unless all three are blank, are a window; a window is
known by 96 bits of its lines. The first occurrence of a window is the one with the smallest
(doc_id, text key, line), null doc_id last; at every other occurrence its three lines are covered, overlapping
and adjacent covers merge into runs, and the covered lines go. Every line removed has an equal line earlier in
that order, of which the earliest stays.

Two shuffles of one small row per window (a combining aggregate to the first occurrence, and a join back that
AQE can split at a hot window), one aggregate of line numbers by document, one join with the texts.

Defined results: null text stays null (no lines); texts of fewer than three lines have no window and stay as
they are; a text of which all lines go becomes empty, its row stays; rows that repeat a (doc_id, text) pair are
one document and are cut alike; of equal windows that of the smallest doc_id (null last), text key and place is the first;
a very long text is cut into its lines whole; an empty table stays empty; other columns pass through, and no column name of
the input can clash because the input row travels as one struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macropanel.llm.common import as_row, text_key, whole

LINES = 3


def windows(docs: DataFrame) -> DataFrame:
    """A row per window: doc_id, key, at (line, from 0), w (64 bits), v (32 more bits)."""
    lines = docs.select("doc_id", text_key().alias("key"), F.split(whole(), "\n", -1).alias("lines"))
    lines = lines.where(F.size("lines") >= LINES)
    hashed = lines.select(
        "doc_id", "key", F.transform("lines", lambda x: F.xxhash64(x)).alias("h"), F.transform("lines", lambda x: F.rlike(x, F.lit(r"\S"))).alias("said")
    )
    three = lambda f, c: lambda i: f(*[F.get(c, i + F.lit(k)) for k in range(LINES)])
    at = F.sequence(F.lit(0), F.size("h") - LINES)
    each = F.transform(
        at,
        lambda i: F.struct(
            i.alias("at"),
            three(F.xxhash64, "h")(i).alias("w"),
            three(F.hash, "h")(i).alias("v"),
            three(lambda a, b, c: a | b | c, "said")(i).alias("said"),
        ),
    )
    return hashed.select("doc_id", "key", F.explode(each).alias("x")).where("x.said").select("doc_id", "key", "x.at", "x.w", "x.v")


def later(docs: DataFrame) -> DataFrame:
    """doc_id, key, starts: the first lines of all windows of a document that occur earlier elsewhere."""
    found = windows(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "at")
    first = found.groupBy("w", "v").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = found.join(first, ["w", "v"]).where(place != F.col("first"))
    return again.groupBy("doc_id", "key").agg(F.collect_list("at").alias("starts"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """row (the input row as a struct), lines (how many), removed (sorted line numbers), runs (merged), kept (text)."""
    base = docs.select(as_row(docs), "doc_id", text_key().alias("key"), "text")
    cut = later(docs.select("doc_id", "text")).select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), "starts")
    both = base.join(cut, (F.col("key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (LINES - 1))))))
    both = both.select("row", "text", F.split(whole(), "\n", -1).alias("l"), F.coalesce(covered, F.array().cast("array<int>")).alias("removed"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("l") - 1), F.col("removed"))
    kept = F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("l", i)), "\n"))
    runs = F.size(F.array_except(F.col("removed"), F.transform("removed", lambda i: i + 1)))
    return both.select("row", F.when(F.col("text").isNull(), 0).otherwise(F.size("l")).alias("lines"), "removed", runs.alias("runs"), kept.alias("kept"))


def replace_text(docs: DataFrame) -> DataFrame:
    """The documents with their texts cut (and n_chars, if there, set to the new length); columns as given."""
    d = dedup_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return d.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op6: a row per document with its lines, how many went, in how many runs, and the text that stays."""
    d = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return d.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("lines").cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        F.col("runs").cast("long").alias("n_runs"),
        F.col("kept").alias("text"),
    )


#: DuckDB: windows are grouped by their three lines themselves, not by a hash (doc_id is a key of the given tables).
ORACLE = r"""
WITH s AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
x AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM s WHERE len(l) >= 3),
w AS (SELECT doc_id, i, l[i] AS a, l[i + 1] AS b, l[i + 2] AS c FROM x),
n AS (SELECT * FROM w WHERE regexp_matches(concat(a, b, c), '[^ \t\n\x0B\f\r]')),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS k FROM n),
g AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM f WHERE k > 1),
t AS (SELECT s.doc_id, u.i, u.line, g.i IS NOT NULL AS gone
  FROM (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM s) u JOIN s USING (doc_id) LEFT JOIN g ON g.doc_id = u.doc_id AND g.i = u.i),
o AS (SELECT *, lag(gone, 1, FALSE) OVER (PARTITION BY doc_id ORDER BY i) AS was FROM t),
r AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT was) AS n_runs,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text FROM o GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_runs, 0)::BIGINT AS n_runs, r.text
FROM documents d LEFT JOIN r USING (doc_id)
"""
