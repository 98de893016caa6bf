"""Periodic run detection: maximal repetitions of words by suffix trees, Lyndon roots and constant-time LCE.

A run is a stretch of words with smallest period q that is at least ``min_length`` words and ``min_exponent``
periods long and that no neighbouring word extends. Per text, inside the tasks:

* Ukkonen's algorithm builds the suffix tree of the words and that of their reversal. A depth-first tour of each
  keeps, between consecutive leaves, the string depth of the shallowest node passed; a sparse table over it gives
  the depth of the lowest common ancestor of two leaves, the longest common extension of two places, by two reads.
* Under either order of the words the longest Lyndon word at a place ends before the next smaller suffix, whose rank
  is the tour's. Every run has such a word as its root under one of the orders; each is a candidate that is
  extended to the right in the one tree and to the left in the other, and kept if it is long enough.
* Trees are built only for the stretches that the text's repeated n-grams cover: a run of the least length and
  exponent has its n-gram of ``min_length * (e - 1) / e`` words a period later again, and all such places of a run
  overlap into one stretch. A hash that two unlike n-grams share adds a stretch and loses none.

Nothing is shuffled. Defined results: words are what the ASCII blanks leave; a null, empty or blank text has no word,
no run, and the empty string collapsed; a null doc_id stays and its row is treated as any other; rows that repeat a
doc_id are texts of their own; of runs with equal place and different period all are given, ordered by start, then
period; an empty table gives an empty result; only doc_id and text are read, other columns cannot clash. A very
long text is worked on whole; its trees take about 400 bytes a word of its longest repeated stretch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macropanel.llm.common import whole

MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Characters of collapsed text that the kernel hands back at a time.
STEP_CHARS = 1_000_000

RUNS = "array<struct<start:long,length:long,period:long>>"


class SuffixTree:
    """Suffix tree of symbols from 1 to ``sigma``, with the end mark 0 behind them.

    ``rank[i]`` is the place of suffix i among all, by the order of the symbols; ``lce`` the longest common extensions.
    """

    def __init__(self, s: list[int], sigma: int):
        self.k = sigma + 1
        self._grow([*s, 0])
        order = self._tour(np.argsort(self.keys))
        self.rank = self._ranks(order)
        up = np.minimum.reduceat(self.depth[self.parent[order]], np.flatnonzero(self.suffix[order] >= 0)[:-1] + 1)
        table = [up.astype(np.int32)]
        while (half := 1 << (len(table) - 1)) * 2 <= len(up):
            low = table[-1]
            table.append(np.minimum(low[:-half], low[half:]))
        self.table = table

    def _grow(self, s: list[int]) -> None:
        """Ukkonen's phases. A node is its edge's start, its string depth and, for a leaf, its suffix."""
        n, k = len(s), self.k
        start, depth, suffix, link = [0], [0], [-1], [0]
        kids: dict[int, int] = {}
        node = edge = length = remaining = 0
        for i, c in enumerate(s):
            remaining += 1
            waiting = 0
            while remaining:
                if not length:
                    edge = i
                key = node * k + s[edge]
                below = kids.get(key)
                if below is None:
                    j = i - remaining + 1
                    kids[key] = len(start)
                    start.append(i)
                    depth.append(n - j)
                    suffix.append(j)
                    link.append(0)
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    span = (i + 1 - start[below]) if suffix[below] >= 0 else depth[below] - depth[node]
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    at = start[below] + length
                    if s[at] == c:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    split = len(start)
                    kids[key] = split
                    start += (start[below], i)
                    depth += (remaining - 1, n - (i - remaining + 1))
                    suffix += (-1, i - remaining + 1)
                    link += (0, 0)
                    start[below] = at
                    kids[split * k + s[at]] = below
                    kids[split * k + c] = split + 1
                    if waiting:
                        link[waiting] = split
                    waiting = split
                remaining -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - remaining + 1
        self.keys = np.fromiter(kids.keys(), np.int64, len(kids))
        self.child = np.fromiter(kids.values(), np.int32, len(kids))
        self.depth, self.suffix = np.array(depth, np.int32), np.array(suffix, np.int32)
        self.parent = np.zeros(len(start), np.int32)
        self.parent[self.child] = self.keys // k

    def _tour(self, by: np.ndarray) -> np.ndarray:
        """Nodes depth first; ``by`` sorts the edges by node, and a node's edges as they are to be walked."""
        ends = np.searchsorted((self.keys // self.k)[by], np.arange(len(self.depth) + 1)).tolist()
        kids = self.child[by].tolist()
        order, stack = [], [0]
        while stack:
            v = stack.pop()
            order.append(v)
            if (a := ends[v]) != (b := ends[v + 1]):
                stack += kids[a:b][::-1]
        return np.array(order)

    def _ranks(self, order: np.ndarray) -> np.ndarray:
        leaves = self.suffix[order]
        leaves = leaves[leaves >= 0]
        rank = np.empty(len(leaves), np.int64)
        rank[leaves] = np.arange(len(leaves))
        return rank

    def rank_reversed(self) -> np.ndarray:
        """Ranks under the opposite order of the symbols; the end mark stays the smallest."""
        node, symbol = self.keys // self.k, self.keys % self.k
        return self._ranks(self._tour(np.lexsort((np.where(symbol, -symbol, -self.k), node))))

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extensions of the suffixes i and j, i != j."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            m = level == k
            t = self.table[k]
            out[m] = np.minimum(t[a[m]], t[b[m] - (1 << int(k))])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every suffix but the last (the end mark) the next one of smaller rank: where its longest Lyndon word ends."""
    r = rank.tolist()
    n = len(r) - 1
    out, stack = [0] * n, [n]
    for i in range(n - 1, -1, -1):
        x = r[i]
        while r[stack[-1]] > x:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(ids: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of the runs of a whole sequence, by start, then period."""
    n = len(ids)
    if n < min_length:
        return np.zeros((0, 3), np.int64)
    names, compact = np.unique(ids, return_inverse=True)
    s = (compact + 1).tolist()
    forward = SuffixTree(s, len(names))
    ends = [next_smaller(rank) for rank in (forward.rank, forward.rank_reversed())]
    places = np.arange(n)
    right = []
    for end in ends:
        inside = end < n
        r = np.zeros(n, np.int64)
        r[inside] = forward.lce(places[inside], end[inside])
        right.append(r)
    del forward
    backward = SuffixTree(s[::-1], len(names))
    found = []
    for end, r in zip(ends, right, strict=True):
        period = end - places
        left = np.zeros(n, np.int64)
        left[1:] = backward.lce(n - places[1:], n - end[1:])
        length = left + period + r
        keep = length >= np.maximum(min_length, min_exponent * period)
        found.append(np.stack([places - left, length, period], axis=1)[keep])
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def stretches(ids: np.ndarray, gram: int) -> list[tuple[int, int]]:
    """[a, b) of the words that n-grams found twice or more cover, touching ones joined."""
    if len(ids) < gram:
        return []
    # an n-gram's hash is built from those of half its length
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    base, held, size = 0xD1342543DE82EF95, None, 0
    for bit in bin(gram)[2:]:
        if size:
            held = held[:-size] * np.uint64(pow(base, size, 1 << 64)) + held[size:]
            size *= 2
        if bit == "1":
            held = h if not size else held[:-1] * np.uint64(base) + h[size:]
            size += 1
    held = held[: len(ids) - gram + 1]
    order = np.argsort(held, kind="stable")
    same = held[order][1:] == held[order][:-1]
    if not same.any():
        return []
    again = np.zeros(len(held), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    places = np.flatnonzero(again)
    cut = np.flatnonzero(np.diff(places) > gram)
    first, last = np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(places) - 1]))
    return [(int(places[a]), int(places[b]) + gram) for a, b in zip(first, last, strict=True)]


def find_runs(words: list[bytes], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of all runs of a text's words, by start, then period."""
    none = np.zeros((0, 3), np.int64)
    if len(words) < min_length:
        return none
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    found = [none]
    for a, b in stretches(ids, math.ceil(min_length * (min_exponent - 1) / min_exponent)):
        rows = runs_of(ids[a:b], min_length, min_exponent)
        rows[:, 0] += a
        found.append(rows)
    return np.concatenate(found)


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run contains after its first period."""
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period), collapsed (text): a row per document."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run is at least two words and two periods long")

    def kernel(batches):
        fields = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        names = ["doc_id", "n_words", "runs", "collapsed"]

        def made(rows):
            columns = list(zip(*rows, strict=True))
            flat = np.concatenate(columns[2])
            ends = np.concatenate(([0], np.cumsum([len(x) for x in columns[2]]))).astype(np.int32)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(fields.value_type))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), parts, type=fields), pa.array(columns[3], pa.string())], names=names)

        for batch in batches:
            ids, texts, held, size = batch.column(0), batch.column(1), [], 0
            for i in range(batch.num_rows):  # one text at a time becomes a Python object
                words = texts[i].as_py().encode().split()
                runs = find_runs(words, min_length, min_exponent)
                held.append((ids[i].as_py(), len(words), runs, collapse(words, runs).decode()))
                size += len(held[-1][3])
                if size > STEP_CHARS:
                    yield made(held)
                    held, size = [], 0
            if held:
                yield made(held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    return rows.mapInArrow(kernel, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def plant(docs: DataFrame) -> DataFrame:
    """doc_id, text: the contract's periodic tails laid on by crc32 of the doc_id (none where it is null)."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split(whole(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hit = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).cast("long").alias("g"))
    n = F.size("w")
    hit = hit.withColumn("a", F.when(n > 0, F.pmod("g", n))).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    tail = F.expr("array_join(transform(w, (x, i) -> w[if(i < a, i, a + (i - a) % p)]), ' ')")
    return hit.select("doc_id", F.when(n > 0, tail).otherwise(F.col("text")).alias("text"))


def _lines(runs: str) -> Column:
    return F.expr(f"array_join(transform({runs}, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")


def query(spark, sf_dir: str) -> DataFrame:
    """op13: runs of every document after the planting, with the digests of its runs and of its collapsed text."""
    found = periodic_runs(plant(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    # exact comparison of length / period by cross-multiplication; runs are in order, so the first of equals stays
    best = F.expr("reduce(slice(runs, 2, greatest(size(runs) - 1, 0)), get(runs, 0), (b, r) -> if(r.length * b.period > b.length * r.period, r, b))")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(_lines("runs").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
