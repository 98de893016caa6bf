"""Approximate nearest neighbours: balanced posting lists with replicated boundary vectors, at two levels.

* Equal vectors are one class with its ``k + 1`` smallest ids, so a common vector makes no large list; the
  search is between classes, and the ids come back in at the end.
* Largest inner product becomes nearest distance by one more coordinate, sqrt(M^2 - |x|^2).
* Cells: about the square root of the number of lists, at most MAX_CELLS. Their centroids come from a bounded sample
  (SAMPLE vectors of the smallest hash): halved at the median along the main direction, so cells are balanced, then
  moved to their means. They are broadcast, and queries search them in an in-memory neighbour graph.
* Lists: a task per cell makes its own in the same way, one for every LIST_SIZE vectors of the cell, from FIT_CELL of its
  vectors at most. The number of lists grows with the table; their centroids stay in a table, grouped by cell.
* A vector goes into its nearest list, and near a border into up to REPLICAS lists whose centroids are within
  ``1 + BORDER`` times its nearest distance. Most vectors are in one list.
* A query probes the cells within ``1 + CELL_PROBE`` times the distance of its NEAR_CELLS-th nearest one, and in them the lists within
  ``1 + PROBE`` times the distance of its NEAR-th nearest list, or of the one up to which HELD * k vectors stand, if that
  is farther (no number of lists is set). The lists up to that one are searched first; from the others only what beats
  the query's k-th score so far leaves the task.
* Vectors and queries of a cell are dealt in blocks of bounded size, so neither a large cell nor one that many
  queries probe makes a large task.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor
do rows without a vec_id, nor vectors of another length than the most frequent one; rows that repeat a
(vec_id, vector) are one row; rows of one vec_id are each other's own row; equal scores go by the smaller vec_id, also
at the k-th place; an empty table, or a single vector, gives no neighbour; fewer candidates than k are all returned if
probed; only vec_id and embedding are read, other columns cannot clash.
"""

from __future__ import annotations

import heapq
from bisect import insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from macropanel.llm.common import Scratch

K = 20
SAMPLE = 20_000
LIST_SIZE = 48
MAX_CELLS = 4096
#: Vectors of a cell that its lists are fitted on.
FIT_CELL = 50_000
REPLICAS = 2
BORDER = 0.01
CELL_PROBE = 0.3
#: The nearest cell whose distance the others' are held against (the nearest may be a query's own small one).
NEAR_CELLS = 4
PROBE = 0.13
#: The nearest list whose distance the others' are held against; those up to it are searched first. In a table of few
#: lists it is the one behind a sixteenth of them.
NEAR = 8
#: Vectors for each place of a result that the nearest lists hold at least, so that lists of a few close copies are not all.
HELD = 8
#: Vectors and queries of a cell that one block holds at most.
LIST_BLOCK = 4096
QUERY_BLOCK = 2048
NEIGHBOURS = 16


def valid(rows: DataFrame) -> DataFrame:
    """vec_id, v (array of doubles) of the rows that take part, repeated rows once."""
    v = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.where("vec_id is not null and v is not null").where(F.coalesce(fine, F.lit(False)))
    return v.dropDuplicates(["vec_id", "v"])


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x from those of c."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :], 0.0)


def nearest_centroid(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The nearest row of c for every row of x, 1024 rows at a time."""
    return np.concatenate([distances(x[a : a + 1024], c).argmin(axis=1) for a in range(0, len(x), 1024)])


def balanced_centroids(x: np.ndarray, lists: int, rounds: int = 3, seed: int = 0) -> np.ndarray:
    """Means of about ``lists`` parts of equal size, after a few rounds of moving vectors to their nearest mean."""
    rng = np.random.default_rng(seed)
    most, parts, done = max(1, -(-len(x) // lists)), [np.arange(len(x))], []
    while parts:
        part = parts.pop()
        if len(part) <= most:
            done.append(part)
            continue
        y = x[part] - x[part].mean(axis=0)
        axis = rng.normal(size=x.shape[1])
        for _ in range(6):
            axis = y.T @ (y @ axis)
            axis /= np.linalg.norm(axis) + 1e-300
        order = part[np.argsort(y @ axis, kind="stable")]
        parts += [order[: len(order) // 2], order[len(order) // 2 :]]
    c = np.array([x[p].mean(axis=0) for p in done])
    for _ in range(rounds):
        near = nearest_centroid(x, c)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def lifted(v: np.ndarray, m: float) -> np.ndarray:
    """Vectors with the coordinate that brings all to the norm sqrt(m)."""
    return np.hstack([v, np.sqrt(np.maximum(m - (v * v).sum(axis=1), 0.0))[:, None]])


def asking(v: np.ndarray, m: float) -> np.ndarray:
    """Queries at the norm sqrt(m), with nothing in the further coordinate."""
    return np.hstack([v * np.sqrt(m / (v * v).sum(axis=1))[:, None], np.zeros((len(v), 1))])


class Graph:
    """Centroids with their nearest neighbours and a few far links, searched best first."""

    def __init__(self, c: np.ndarray, neighbours: int = NEIGHBOURS, seed: int = 0):
        self.c, n = c, len(c)
        rng = np.random.default_rng(seed)
        links = [set() for _ in range(n)]
        for a in range(0, n, 512):
            d = distances(c[a : a + 512], c)
            k = min(neighbours + 1, n)
            for i, near in enumerate(np.argpartition(d, k - 1, axis=1)[:, :k].tolist(), a):
                for j in [*near, *rng.integers(0, n, 2).tolist()]:
                    if i != j:
                        links[i].add(j)
                        links[j].add(i)
        self.links = [np.array(sorted(s), np.int64) for s in links]
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(np.int64))

    def within(self, q: np.ndarray, ratio: float, nth: int = 1) -> list[tuple[float, int]]:
        """(distance, centroid) of the centroids reached within ``ratio`` times the nth nearest distance, nearest first.

        The search walks on through centroids up to a wider ratio, so that it isn't stopped by a ridge.
        """
        d = lambda at: np.sqrt(np.maximum(((self.c[at] - q) ** 2).sum(axis=1), 0.0))
        seen = np.zeros(len(self.c), bool)
        seen[self.entries] = True
        todo = list(zip(d(self.entries).tolist(), self.entries.tolist(), strict=True))
        heapq.heapify(todo)
        found, near = [], sorted(x for x, _ in todo)[:nth]
        while todo and (len(near) < nth or todo[0][0] <= near[-1] * ratio * 1.02):
            x, i = heapq.heappop(todo)
            found.append((x, i))
            new = self.links[i][~seen[self.links[i]]]
            seen[new] = True
            for y, j in zip(d(new).tolist(), new.tolist(), strict=True):
                if len(near) < nth or y < near[-1]:
                    insort(near, y)
                    del near[nth:]
                heapq.heappush(todo, (y, j))
        found.sort()
        return [f for f in found if f[0] <= near[-1] * ratio]


def _stacked(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def _frame(columns: dict[str, list]) -> pd.DataFrame:
    """A frame of the columns; without rows they are objects, because pandas takes an empty list column for one of numbers."""
    return pd.DataFrame(columns, dtype=None if any(columns.values()) else object)


class Index:
    """Posting lists of a table's vectors; ``probes`` and ``nearest`` ask them for rows that an SQL condition names."""

    def __init__(self, rows: DataFrame, k: int = K, list_size: int = LIST_SIZE, replicas: int = REPLICAS, border: float = BORDER, sample: int = SAMPLE, fit_cell: int = FIT_CELL, max_cells: int = MAX_CELLS):
        self.spark, self.k, self.replicas, self.border = rows.sparkSession, k, replicas, border
        self.scratch = scratch = Scratch(self.spark, "ann")
        v = valid(rows)
        lengths = v.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"))
        dims = (lengths.orderBy(F.desc("rows"), F.desc("n")).first() or {"n": 0})["n"]
        self.vectors = scratch.save(v.where(F.size("v") == dims).withColumn("h", F.xxhash64("v")), "vectors")

        # classes of equal vectors, known by the place of their first row in a written table
        same = Window.partitionBy("h", "v").orderBy("vec_id")
        members = scratch.save(self.vectors.withColumn("rn", F.row_number().over(same)).where(F.col("rn") <= k + 1), "members")
        self.classes = scratch.save(members.where("rn = 1").select(F.monotonically_increasing_id().alias("c"), F.col("vec_id").alias("first"), "h", "v"), "classes")
        self.members = scratch.save(self._classed(members).select("c", "vec_id"), "ids")
        scratch.drop("members")

        stats = self.classes.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
        self.n, self.m = stats["n"], float(stats["m"] or 0.0)
        if not self.n:
            return
        drawn = self.classes.orderBy(F.xxhash64("h", F.lit("fit")), "c").limit(sample).select("v").collect()
        x = lifted(np.array([r["v"] for r in drawn]), self.m)
        cells = int(min(max_cells, max(1, round((self.n / list_size) ** 0.5)), max(1, len(x) // 8)))
        self.cells = self.spark.sparkContext.broadcast(balanced_centroids(x, cells))  # at most max_cells rows
        self._post(list_size, fit_cell)

    def _classed(self, rows: DataFrame) -> DataFrame:
        """Rows with h and v, and the class of their vector."""
        on = self.classes.select("c", F.col("h").alias("_h"), F.col("v").alias("_v"))
        return rows.join(on, (F.col("h") == F.col("_h")) & (F.col("v") == F.col("_v")))

    def _sizes(self, table: DataFrame) -> dict[int, int]:
        return {r["cell"]: r["count"] for r in table.groupBy("cell").count().collect()}  # a row per cell

    def _post(self, list_size: int, fit_cell: int) -> None:
        """``lists`` (cell, list, centroid) and ``postings`` (cell, list, c, first, v)."""
        m, cells, replicas, border = self.m, self.cells, self.replicas, self.border

        def place(frames):
            for pdf in frames:
                for a in range(0, len(pdf), 1024):
                    part = pdf.iloc[a : a + 1024]
                    d = np.sqrt(distances(lifted(_stacked(part["v"]), m), cells.value))
                    r = min(replicas, d.shape[1])
                    near = np.argsort(d, axis=1, kind="stable")[:, :r]
                    dn = np.take_along_axis(d, near, axis=1)
                    i, j = np.nonzero(dn <= dn[:, :1] * (1 + border))
                    yield pd.DataFrame({"cell": near[i, j], "home": j == 0, "c": part["c"].to_numpy()[i], "first": part["first"].to_numpy()[i], "v": [part["v"].iloc[t] for t in i]})

        placed = self.scratch.save(self.classes.mapInPandas(place, "cell long, home boolean, c long, first long, v array<double>"), "placed")
        homes = self._sizes(placed.where("home"))
        small = F.broadcast(self.spark.createDataFrame([(c, n, -(-n // list_size)) for c, n in homes.items()], "cell long, n long, lists long"))
        drawn = placed.where("home").join(small, "cell").where(F.pmod(F.xxhash64("c", F.lit("fit")), "n") < fit_cell)

        def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            x = lifted(_stacked(pdf.sort_values("c")["v"]), m)
            c = balanced_centroids(x, int(min(pdf["lists"].iloc[0], max(1, len(x) // 4))))
            return pd.DataFrame({"cell": int(key[0]), "list": range(len(c)), "centroid": list(c)})

        self.lists = self.scratch.save(drawn.select("cell", "lists", "c", "v").groupBy("cell").applyInPandas(fit, "cell long, list int, centroid array<double>"), "lists")

        def assign(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = {"cell": [], "list": [], "d": [], "c": [], "first": [], "v": []}
            if len(left) and len(right):
                right = right.sort_values("list")
                c, x = _stacked(right["centroid"]), lifted(_stacked(left["v"]), m)
                for a in range(0, len(left), 1024):
                    d = np.sqrt(distances(x[a : a + 1024], c))
                    near = np.argsort(d, axis=1, kind="stable")[:, : min(replicas, len(c))]
                    dn = np.take_along_axis(d, near, axis=1)
                    i, j = np.nonzero(dn <= dn[:, :1] * (1 + border))
                    out["list"] += right["list"].to_numpy()[near[i, j]].tolist()
                    out["d"] += dn[i, j].tolist()
                    for name in ("cell", "c", "first", "v"):
                        out[name] += left[name].iloc[a + i].tolist()
            return _frame(out)

        self.near = min(NEAR, max(2, self.lists.count() // 16))

        dealt = self._blocks(placed, self._sizes(placed), LIST_BLOCK, "c")
        near = dealt.groupBy("cell", "b").cogroup(self._every_block(self.lists, self._sizes(placed), LIST_BLOCK).groupBy("cell", "b"))
        near = near.applyInPandas(assign, "cell long, list int, d double, c long, first long, v array<double>")
        of = Window.partitionBy("c")
        kept = near.withColumn("rn", F.row_number().over(of.orderBy("d", "cell", "list"))).withColumn("least", F.min("d").over(of))
        kept = kept.where((F.col("rn") == 1) | (F.col("rn") <= replicas) & (F.col("d") <= F.col("least") * (1 + border)))
        self.postings = self.scratch.save(kept.select("cell", "list", "c", "first", "v"), "postings")
        self.scratch.drop("placed")
        held = self.postings.groupBy("cell", "list").agg(F.count("*").alias("held"))
        self.lists = self.scratch.save(self.lists.join(held, ["cell", "list"], "left").fillna(0, ["held"]), "sized")

    def _blocks(self, rows: DataFrame, sizes: dict[int, int], most: int, by: str) -> DataFrame:
        """Rows with the block of their cell that they are dealt to."""
        n = F.broadcast(self.spark.createDataFrame([(c, -(-x // most)) for c, x in sizes.items()], "cell long, nb long"))
        return rows.join(n, "cell").withColumn("b", F.pmod(F.xxhash64(by), "nb")).drop("nb")

    def _every_block(self, rows: DataFrame, sizes: dict[int, int], most: int, name: str = "b") -> DataFrame:
        """Rows once for every block of their cell."""
        n = F.broadcast(self.spark.createDataFrame([(c, -(-x // most)) for c, x in sizes.items()], "cell long, nb long"))
        return rows.join(n, "cell").withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1))).drop("nb")

    def probes(self, asked: DataFrame, probe: float = PROBE, cell_probe: float = CELL_PROBE) -> DataFrame:
        """Classes (c) -> q, v, cell, early and late: the lists of the cell that the class probes, the nearest ones first."""
        m, cells, nth, least = self.m, self.cells, self.near, HELD * self.k
        g = Graph(cells.value)
        graph = self.spark.sparkContext.broadcast((g.c, g.links, g.entries))

        def ask(frames):
            g = Graph.__new__(Graph)
            g.c, g.links, g.entries = graph.value
            for pdf in frames:
                if not len(pdf):
                    continue
                out = {"cell": [], "q": [], "v": []}
                for q, v, y in zip(pdf["c"], pdf["v"], asking(_stacked(pdf["v"]), m), strict=True):
                    got = [i for _, i in g.within(y, 1 + cell_probe, min(NEAR_CELLS, len(g.c)))]
                    out["cell"] += got
                    out["q"] += [q] * len(got)
                    out["v"] += [v] * len(got)
                yield _frame(out)

        def choose(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = {"cell": [], "q": [], "v": [], "lists": [], "d": [], "n": []}
            if len(left) and len(right):
                c, names, held = _stacked(right["centroid"]), right["list"].to_numpy(), right["held"].to_numpy()
                d = np.sqrt(distances(asking(_stacked(left["v"]), m), c))
                order = np.argsort(d, axis=1, kind="stable")
                for cell, q, v, x, o in zip(left["cell"], left["q"], left["v"], d, order, strict=True):
                    # the cell's own reference is no nearer than the table's
                    at = min(max(nth - 1, int(np.searchsorted(np.cumsum(held[o]), least))), len(o) - 1)
                    o = o[x[o] <= x[o[at]] * (1 + probe)]
                    for name, value in (("cell", cell), ("q", q), ("v", v), ("lists", names[o]), ("d", x[o]), ("n", held[o])):
                        out[name].append(value)
            return _frame(out)

        reached = self.scratch.save(asked.mapInPandas(ask, "cell long, q long, v array<double>"), "reached")
        sizes = self._sizes(reached)
        pairs = self._blocks(reached, sizes, QUERY_BLOCK, "q").groupBy("cell", "b").cogroup(self._every_block(self.lists, sizes, QUERY_BLOCK).groupBy("cell", "b"))
        found = self.scratch.save(pairs.applyInPandas(choose, "cell long, q long, v array<double>, lists array<int>, d array<double>, n array<long>"), "chosen")
        self.scratch.drop("reached")
        # the nearest lists of all cells in order, until there are enough lists and enough vectors in them
        near = F.array_sort(F.flatten(F.collect_list(F.slice(F.arrays_zip("d", "n"), 1, max(nth, least)))))
        upto = f"reduce(a, named_struct('i', 0, 'held', 0L, 'ref', cast(0 as double)), (s, x) -> if(s.i >= {nth} and s.held >= {least}, s, named_struct('i', s.i + 1, 'held', s.held + x.n, 'ref', x.d)), s -> s.ref)"
        ref = found.groupBy("q").agg(near.alias("a")).select(F.col("q").alias("_q"), F.expr(upto).alias("ref"))
        held = found.join(ref, F.col("q") == F.col("_q"))
        some = lambda low, high: F.filter(F.transform("lists", lambda x, i: F.when((F.get("d", i) > low) & (F.get("d", i) <= high), x)), lambda x: x.isNotNull())
        held = held.select("q", "v", "cell", some(F.lit(-1.0), F.col("ref")).alias("early"), some(F.col("ref"), F.col("ref") * (1 + probe)).alias("late"))
        held = self.scratch.save(held.where("size(early) + size(late) > 0"), "probes")
        self.scratch.drop("chosen")
        return held

    def scores_per_query(self, probes: DataFrame) -> float:
        """Vectors that a query is held against, on average, and the centroids of lists (not those of cells)."""
        lists = probes.select("q", "cell", F.explode(F.concat("early", "late")).alias("list"))
        sizes = self.postings.groupBy("cell", "list").agg(F.count("*").alias("n"))
        scored = lists.join(sizes, ["cell", "list"]).agg(F.sum("n").alias("n")).first()["n"] or 0
        looked = probes.join(self.lists.groupBy("cell").agg(F.count("*").alias("n")), "cell").agg(F.sum("n").alias("n")).first()["n"] or 0
        return (scored + looked) / max(1, probes.select("q").distinct().count())

    def _search(self, probes: DataFrame) -> DataFrame:
        """The best k + 1 classes of every block (that beat its query's bound): q, c, first, score. ``want`` names the lists."""
        k, n_p, n_q = self.k, self._sizes(self.postings), self._sizes(probes)
        n_p = {c: n_p.get(c, 1) for c in n_q}
        p = self._every_block(self._blocks(self.postings, n_p, LIST_BLOCK, "c").withColumnRenamed("b", "pb"), n_q, QUERY_BLOCK, "qb")
        q = self._every_block(self._blocks(probes, n_q, QUERY_BLOCK, "q").withColumnRenamed("b", "qb"), n_p, LIST_BLOCK, "pb")

        def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(left) and len(right):
                right = right.sort_values("list", kind="stable")
                a, b = _stacked(left["v"]), _stacked(right["v"])
                c, first, of = right["c"].to_numpy(), right["first"].to_numpy(), right["list"].to_numpy()
                names, start = np.unique(of, return_index=True)
                ends = dict(zip(names.tolist(), zip(start.tolist(), [*start[1:].tolist(), len(of)], strict=True), strict=True))
                asking_: dict[int, list[int]] = {}
                for i, want in enumerate(left["want"]):
                    for x in want:
                        if x in ends:
                            asking_.setdefault(int(x), []).append(i)
                s = np.full((len(a), len(b)), -np.inf)
                for x, who in asking_.items():
                    lo, hi = ends[x]
                    s[who, lo:hi] = a[who] @ b[lo:hi].T
                for q, vec, bound, row in zip(left["q"], a, left["bound"], s, strict=True):
                    at = np.flatnonzero((row >= bound - 1e-9) & (row > -np.inf))
                    at = at[np.unique(c[at], return_index=True)[1]]  # a boundary vector may stand in two lists of the block
                    if len(at) > k + 1:
                        cut = np.partition(row[at], len(at) - k - 1)[len(at) - k - 1]
                        at = at[row[at] >= cut - 1e-12]  # with ties, which the ids decide later
                    if len(at):
                        out.append(pd.DataFrame({"q": q, "c": c[at], "first": first[at], "score": (b[at] * vec).sum(axis=1)}))
            return pd.concat(out) if out else _frame({"q": [], "c": [], "first": [], "score": []})

        key = ["cell", "pb", "qb"]
        return q.groupBy(*key).cogroup(p.groupBy(*key)).applyInPandas(block, "q long, c long, first long, score double")

    def nearest(self, queries: str, probe: float = PROBE, cell_probe: float = CELL_PROBE) -> DataFrame:
        """query_id, rank, vec_id, score: up to k neighbours of every row that the condition holds for."""
        if not self.n:
            return self.spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        k, scratch = self.k, self.scratch
        asked = scratch.save(self._classed(self.vectors.where(queries)).select(F.col("vec_id").alias("query_id"), "c"), "asked")
        wanted = self.probes(self.classes.join(asked.select("c").distinct(), "c", "left_semi").select("c", "v"), probe, cell_probe)

        def best(found: DataFrame) -> DataFrame:
            one = found.groupBy("q", "c", "first").agg(F.max("score").alias("score"))
            order = Window.partitionBy("q").orderBy(F.desc("score"), "first", "c")
            return one.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k + 1).drop("rn")

        unbound = F.lit(float("-inf"))
        early = wanted.where("size(early) > 0").select("q", "v", "cell", F.col("early").alias("want"), unbound.alias("bound"))
        early = scratch.save(best(self._search(early)), "early")
        bound = early.groupBy("q").agg(F.when(F.count("*") > k, F.min("score")).otherwise(unbound).alias("bound"))
        late = wanted.where("size(late) > 0").select("q", "v", "cell", F.col("late").alias("want")).join(bound, "q", "left")
        found = best(early.union(self._search(late.fillna(float("-inf"), ["bound"]))))
        each = found.join(self.members, "c").select("q", "vec_id", "score")
        top = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        each = scratch.save(each.withColumn("rn", F.row_number().over(top)).where(F.col("rn") <= k + 1).drop("rn"), "found")
        mine = asked.join(each, F.col("c") == F.col("q")).where("vec_id != query_id")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        out = mine.select("query_id", F.row_number().over(order).cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
        scratch.drop("early")
        return out


def nearest(rows: DataFrame, queries: str, k: int = K, probe: float = PROBE, **index) -> DataFrame:
    """query_id, rank, vec_id, score: up to k neighbours of every row that the SQL condition ``queries`` holds for."""
    return Index(rows, k, **index).nearest(queries, probe)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: 20 neighbours of every row whose vec_id is divisible by 20."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 20 = 0")
