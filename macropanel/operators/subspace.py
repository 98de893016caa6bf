"""EM steps of wide panels (I7, I9-I11): the top-k eigenvectors without the N x N Gram matrix.

``factors`` forms the Gram matrix of a panel, which a panel of tens of thousands of series cannot afford. Here the
leading eigenvectors of ``Z' Z`` come from a locally optimal block iteration: a basis S of at most 3 (k + extra)
orthonormal columns (Ritz vectors, residuals, last directions) is improved until its leading k span the invariant
subspace. One iteration is

* a pass over the rows: each group of (panel, salt), of at most ``cells_per_task`` cells, computes ``Y = Z S``, the
  triangular factor of its own ``Y`` (a tall-skinny QR by partition) and its part of ``Z' Y``, N x 3 (k + extra);
* sums of those parts by blocks of ``CHUNK`` series, and one QR of the stacked triangular factors, whose singular
  values and vectors are the Ritz values and vectors of ``Z' Z`` on the basis, at the precision of Z itself;
* one group per panel that holds N x 3 (k + extra) numbers, linear in N: rotation, residuals, new basis.

It ends for a panel when the residual is under ``SUBSPACE_TOL`` of the gap behind the k-th eigenvalue. An EM step then
refills the gaps from the projection, and the next one starts from the vectors it has. Several panels go on
together; the driver learns how many are at work. Every pass reads and writes tables in the checkpoint folder.

The state rows are the vectors of the panel's shorter side: its dates' (N long), or, if there are no more dates than
series, its series' (T long). The leading vectors of either side make the same projection, so in what is said above N and
the rows change their places; what a group of a whole panel holds grows with the shorter side only.

Vectors of at most ``SHORT`` numbers need no iteration: their basis has every direction, so the first pass is the last
one and Z' Z S isn't asked for. Their state is blocks: a row holds the vectors of some rows of a panel, about ``HELD``
numbers, and which of them are gaps. An EM step is a pass without a shuffle of the state: each task refills its
vectors from the panel's leading ones, adds up the norms, and tells them and the triangular factor of its vectors, of
which the next leading ones are made. The state is written every ``REDONE`` steps only; the steps in between go on from
there, each time again, with the leading vectors since: these are few numbers, and a refill is cheaper than a write.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from macropanel.model import DATE, PANEL, Params

log = logging.getLogger(__name__)

#: Columns of the block beyond k, and series of a block of the N-sized matrices.
EXTRA, CHUNK = 8, 2048
#: Residual of the leading k over the gap behind them (or over the first eigenvalue, near its rounding).
SUBSPACE_TOL, ROUNDING = 1e-10, 2e-14
#: Passes over the rows that one EM step may take.
MOST_PASSES = 300
#: Numbers of a vector up to which a basis has every direction, and of a block of such vectors.
SHORT, HELD = 128, 16_384
#: Steps after which the state of such vectors is written.
REDONE = 5

#: A block of a matrix with a row per series: rows i0 onward, ``width`` columns, row by row. i0 = -1: a triangular factor.
BLOCK = "panel_id string, i0 int, width int, s array<double>"
BASIS = f"{BLOCK}, lead int, done boolean"
STATE = "panel_id string, salt int, date date, idx int, miss array<int>, z array<double>"  # of a date, or of a series


def names_of(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def vectors_of(column: pa.ListArray) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix; null entries become NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(float).reshape(len(column), -1)


def by_panel(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """(panel, row numbers) of a batch."""
    code, names = pd.factorize(batch.column(PANEL).to_pandas())
    for k, name in enumerate(names):
        yield name, np.flatnonzero(code == k)


def refill(z: np.ndarray, gaps: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One EM step: the gaps take their values from the projection on v; and the norms of the change and of what was there."""
    zhat = (z @ v) @ v.T
    return np.where(gaps, zhat, z), np.array([((zhat - z)[gaps] ** 2).sum(), (z[gaps] ** 2).sum()])


def gaps_of(shape: tuple[int, int], miss: pa.ListArray) -> np.ndarray:
    out = np.zeros(shape, bool)
    out[np.repeat(np.arange(shape[0]), np.diff(miss.offsets.to_numpy())), miss.flatten().to_numpy()] = True
    return out


def blocks(panel: str, x: np.ndarray) -> pd.DataFrame:
    starts = range(0, len(x), CHUNK)
    return pd.DataFrame({PANEL: [panel] * len(starts), "i0": list(starts), "width": x.shape[1], "s": [x[i : i + CHUNK].ravel() for i in starts]})


def matrix(frame: pd.DataFrame) -> np.ndarray:
    """The matrix of which the frame has all blocks."""
    frame = frame.sort_values("i0")
    return np.concatenate([np.asarray(s, float) for s in frame["s"]]).reshape(-1, int(frame["width"].iloc[0]))


def empty(schema: str) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([], dtype=object) for c in names_of(schema)})


def orthonormal(against: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span x beyond ``against`` (orthonormal too); directions lost to rounding are left out."""
    size = np.linalg.norm(x, axis=0)
    x = x[:, size > 0] / size[size > 0]
    for _ in range(2):
        x = x - against @ (against.T @ x)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    u = u[:, s > 1e-9]
    u = u - against @ (against.T @ u)
    return np.linalg.qr(u)[0] if u.shape[1] else u


def rotate(s: np.ndarray, gs: np.ndarray, r: np.ndarray, k: int, lead: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Ritz vectors of the basis ``s`` (with ``gs = Z'Z s`` and ``r`` the factor of ``Z s``), and the next basis or None at the end.

    ``lead`` is the number of columns that the Ritz vectors of the pass before take.
    """
    width = min(k + EXTRA, s.shape[1])
    _, sigma, vt = np.linalg.svd(r)
    theta = np.zeros(s.shape[1])
    theta[: len(sigma)] = sigma**2
    c = vt.T[:, :width]
    v, theta_v = s @ c, theta[:width]
    residual = gs @ c - v * theta_v
    gap = theta[k - 1] - (theta[k] if len(theta) > k else 0.0)
    off = np.linalg.norm(residual[:, :k])
    if off <= max(SUBSPACE_TOL * gap, ROUNDING * max(theta[0], 0.0)) or s.shape[1] >= len(s):
        return v, None
    last = s[:, lead:] @ c[lead:]
    more = orthonormal(v, np.concatenate([residual, last], axis=1))
    return v, (np.concatenate([v, more], axis=1) if more.shape[1] else None)


# ------------------------------------------------------------------ groups


def _first_basis(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
    n, t, k = (int(f[c].iloc[0]) for c in ("n", "t", "k"))
    start = np.random.default_rng(20_240).normal(size=(n, min(n, t, k + EXTRA)))
    return blocks(f[PANEL].iloc[0], np.linalg.qr(start)[0]).assign(lead=0, done=False)


def _products(rows: pd.DataFrame, basis: pd.DataFrame) -> pd.DataFrame:
    if rows.empty or basis.empty:
        return empty(BLOCK)
    z, s = np.stack(rows["z"].to_list()), matrix(basis)
    y = z @ s
    r = np.linalg.qr(y, mode="r")
    panel = rows[PANEL].iloc[0]
    factor = pd.DataFrame({PANEL: [panel], "i0": [-1], "width": [s.shape[1]], "s": [r.ravel()]})
    return pd.concat([blocks(panel, z.T @ y), factor], ignore_index=True)


def _sum(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
    width = int(f["width"].iloc[0])
    if int(key[1]) < 0:
        total = np.linalg.qr(np.concatenate([np.asarray(s, float).reshape(-1, width) for s in f["s"]]), mode="r").ravel()
    else:
        total = np.sum(np.stack(f["s"].to_list()), axis=0)
    return pd.DataFrame({PANEL: [f[PANEL].iloc[0]], "i0": [int(key[1])], "width": [width], "s": [total]})


def _next_basis(sums: pd.DataFrame, basis: pd.DataFrame) -> pd.DataFrame:
    if sums.empty or basis.empty:
        return empty(BASIS)
    factor = sums["i0"] < 0
    s, gs, k = matrix(basis), matrix(sums[~factor]), int(basis["k"].iloc[0])
    r = matrix(sums[factor])
    v, more = rotate(s, gs, r, k, int(basis["lead"].iloc[0]) or s.shape[1])
    return blocks(basis[PANEL].iloc[0], v if more is None else more).assign(lead=v.shape[1], done=more is None)


STEP = f"kind int, {STATE}, num double, den double"


def _refill(rows: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
    """New state rows (kind 0) and the norms of the change (kind 1); rows of a panel that is done pass."""
    if rows.empty:
        return empty(STEP)
    out = rows[names_of(STATE)].assign(kind=0, num=None, den=None)
    if not vectors.empty:
        z, v = np.stack(rows["z"].to_list()), matrix(vectors)[:, : int(vectors["k"].iloc[0])]
        gaps = np.zeros(z.shape, bool)
        for i, miss in enumerate(rows["miss"]):
            gaps[i, np.asarray(miss, int)] = True
        z, (num, den) = refill(z, gaps, v)
        out["z"] = list(z)
        norms = dict.fromkeys(names_of(STEP)) | {"kind": 1, PANEL: rows[PANEL].iloc[0], "num": num, "den": den}
        out = pd.concat([out.astype(object), pd.DataFrame([norms]).astype(object)], ignore_index=True)
    return out[names_of(STEP)]


# ------------------------------------------------------------------ short vectors

ROWS = "panel_id string, salt int, date date, idx int, z0 array<double>"  # null entries are gaps
#: t vectors of n numbers: z row by row, the bits of its gaps, dates and idx as 32-bit numbers (null: none). One salt serves the block.
HELD_ROWS = "panel_id string, salt int, t int, n int, date binary, idx binary, gaps binary, z binary"
#: A step's blocks (kind 0), and what a task says of a panel at work (kind 1): norms and triangular factor.
SHORT_STEP = f"kind int, {HELD_ROWS}, num double, den double, s array<double>"
SHORT_TYPES = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.float64(), pa.float64(), pa.list_(pa.float64())]
TOLD = "panel_id string, n int, num double, den double, s array<double>"
#: What comes of it: a panel's leading vectors, null for one that has converged.
LEADING = "panel_id string, n_iter int, delta double, v array<double>"


def _factor(held: np.ndarray | None, z: np.ndarray) -> np.ndarray:
    """The triangular factor of the vectors so far and more of them."""
    return np.linalg.qr(z if held is None else np.concatenate([held, z]), mode="r")


def _short_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), SHORT_TYPES, strict=True)], names=names_of(SHORT_STEP))


def _told(held: dict[str, np.ndarray], norms: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if held:
        yield _short_batch([(1, p, None, None, r.shape[1], None, None, None, None, *norms.get(p, (None, None)), r.ravel()) for p, r in held.items()])


def _hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows -> blocks with zeros in the gaps, and the factors of them."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for p, at in by_panel(batch):
            part = batch if len(at) == len(batch) else batch.take(pa.array(at))
            z = vectors_of(part.column("z0"))
            gaps, z = np.isnan(z), np.nan_to_num(z, nan=0.0)
            held[p] = _factor(held.get(p), z)
            salt, n = part.column("salt").to_pylist(), z.shape[1]
            names = [None if x.null_count else x.cast(pa.int32()).to_numpy() for x in (part.column(DATE), part.column("idx"))]
            most = max(1, HELD // n)
            for i in range(0, len(z), most):
                some = slice(i, i + most)
                of = [None if x is None else x[some].tobytes() for x in names]
                yield _short_batch([(0, p, salt[i], len(z[some]), n, *of, np.packbits(gaps[some]).tobytes(), z[some].tobytes(), None, None, None)])
    yield from _told(held, {})


def _held(part: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors and gaps of the i-th block."""
    shape = part.column("t")[i].as_py(), part.column("n")[i].as_py()
    z = np.frombuffer(part.column("z")[i].as_buffer()).reshape(shape)
    bits = np.frombuffer(part.column("gaps")[i].as_buffer(), np.uint8)
    return z, np.unpackbits(bits, count=z.size).astype(bool).reshape(shape)


def _since(z: np.ndarray, gaps: np.ndarray, vs: list[np.ndarray]) -> np.ndarray:
    """The vectors after the steps with ``vs``."""
    for v in vs:
        z = np.where(gaps, (z @ v) @ v.T, z)
    return z


def _short_step(known: Broadcast | None, write: bool):
    """What a task says of each panel at work after a step and, with ``write``, the blocks.

    ``known`` has the leading vectors of each panel since the state was written, and the names of the panels at work; or
    the blocks come with those of this step as their column v, null for a panel that isn't at work.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        norms: dict[str, np.ndarray] = {}
        for batch in batches:
            after = []
            for i, p in enumerate(batch.column(PANEL).to_pylist()):
                z, gaps = _held(batch, i)
                if known:
                    vs, at_work = known.value[0].get(p, []), p in known.value[1]
                else:
                    v = batch.column("v")[i].as_py()
                    vs, at_work = [] if v is None else [v], v is not None
                vs = [np.asarray(v).reshape(z.shape[1], -1) for v in vs]
                if at_work:
                    z, change = refill(_since(z, gaps, vs[:-1]), gaps, vs[-1])
                    norms[p] = norms.get(p, 0) + change
                    held[p] = _factor(held.get(p), z)
                elif write:
                    z = _since(z, gaps, vs)
                if write:
                    after.append(z.tobytes())
            if write:
                n, z = batch.num_rows, pa.array(after, pa.binary())
                cols = [pa.array([0] * n, pa.int32()), *[z if c == "z" else batch.column(c) for c in names_of(HELD_ROWS)], *[pa.nulls(n, t) for t in SHORT_TYPES[-3:]]]
                yield pa.RecordBatch.from_arrays(cols, names=names_of(SHORT_STEP))
        for told in _told(held, norms):
            yield told if write else told.select(names_of(TOLD))

    return kernel


def _let_go(known: Broadcast):
    """Blocks -> state rows after the steps with the leading vectors ``known`` by panel."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, p in enumerate(batch.column(PANEL).to_pylist()):
                z, gaps = _held(batch, i)
                z = _since(z, gaps, [v.reshape(z.shape[1], -1) for v in known.value.get(p, [])])
                t, at = len(z), np.nonzero(gaps)[1]
                miss = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], gaps.sum(axis=1).cumsum()]), pa.int32()), pa.array(at, pa.int32()))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(t + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
                of = [batch.column(c)[i] for c in (DATE, "idx")]
                of = [pa.array(np.frombuffer(x.as_buffer(), np.int32)).cast(kind) if x.is_valid else pa.nulls(t, kind) for x, kind in zip(of, (pa.date32(), pa.int32()), strict=True)]
                cols = [pa.array([p] * t, pa.string()), pa.array([batch.column("salt")[i].as_py()] * t, pa.int32()), *of, miss, flat]
                yield pa.RecordBatch.from_arrays(cols, names=names_of(STATE))

    return kernel


def _short_vectors(step: int, k: int, tol: float):
    """One panel: the factors of its tasks -> its leading vectors for the next step, and the change of this one."""

    def kernel(f: pd.DataFrame) -> pd.DataFrame:
        n = int(f["n"].iloc[0])  # the panel's shorter side, which bounds its rank
        delta = math.sqrt(f["num"].sum()) / (math.sqrt(f["den"].sum()) + 1e-12) if step else math.inf
        v = None
        if delta >= tol:
            r = _factor(None, np.concatenate([np.asarray(s, float).reshape(-1, n) for s in f["s"]]))
            v = np.linalg.svd(r)[2][: max(1, min(k, n - 1))].T.ravel()
        return pd.DataFrame({PANEL: [f[PANEL].iloc[0]], "n_iter": [step], "delta": [delta], "v": [v]})

    return kernel


# ------------------------------------------------------------------ the loop


class WidePanels:
    """EM over panels given as ``shapes``: panel, n numbers a vector, t vectors, k, n_salt.

    All their vectors, the complete ones too, are in ``rows`` if they are short, else in ``state``.
    """

    def __init__(self, spark, root: str, rows: DataFrame, state: DataFrame, shapes: DataFrame, params: Params, drop, broadcast_bytes: int):
        self.spark, self.root, self.params, self.drop, self.broadcast_bytes = spark, root, params, drop, broadcast_bytes
        self.rows, self.state, self.shapes, self.passes = rows, state, shapes, 0

    def _save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def _dealt(self, basis: DataFrame) -> DataFrame:
        """The blocks for every salt of their panel."""
        on = basis.join(self.shapes.select(PANEL, "n_salt", "k"), PANEL)
        return on.select("*", F.explode(F.sequence(F.lit(0), F.col("n_salt") - 1)).alias("salt"))

    def leading(self, basis: DataFrame, tag: str) -> DataFrame:
        """Blocks of the leading eigenvectors of every panel that has a basis (k and EXTRA columns)."""
        found: DataFrame | None = None
        for i in range(MOST_PASSES):
            parts = self.state.groupBy(PANEL, "salt").cogroup(self._dealt(basis).groupBy(PANEL, "salt")).applyInPandas(_products, BLOCK)
            sums = parts.groupBy(PANEL, "i0").applyInPandas(_sum, BLOCK)
            held = basis.join(self.shapes.select(PANEL, "k"), PANEL)
            after = sums.groupBy(PANEL).cogroup(held.groupBy(PANEL)).applyInPandas(_next_basis, BASIS)
            watch = Observation()
            after = after.observe(watch, F.count_if((F.col("i0") == 0) & ~F.col("done")).alias("n"))
            table = self._save(after, f"{tag}-{i}")
            self.passes += 1
            done = table.where("done")
            found = done if found is None else found.unionByName(done)
            at_work = watch.get["n"]
            if not at_work:
                return found
            basis = table.where("not done")
        log.warning("%d wide panels reached %d passes; their leading vectors are taken as they are", at_work, MOST_PASSES)
        return found.unionByName(basis)

    def _short(self) -> tuple[DataFrame, DataFrame]:
        """The steps of panels of short vectors: their state at the end, and (panel, n_iter, delta).

        Leading vectors that Spark would broadcast go to the tasks once each; beyond that they join by (panel, salt).
        """
        p, tables, last = self.params, [], {}
        small = REDONE * self.shapes.agg(F.sum(8 * F.col("n") * F.col("k") + 64)).first()[0] <= self.broadcast_bytes

        def leading(told: DataFrame, step: int):
            found = told.groupBy(PANEL).applyInPandas(_short_vectors(step, p.k, p.tol), LEADING)
            self.passes += 1
            if small:
                rows = found.collect()
                last.update({r[PANEL]: (r["n_iter"], r["delta"]) for r in rows})
                vectors = {r[PANEL]: r["v"] for r in rows if r["v"] is not None}
                return vectors, len(vectors)
            watch = Observation()
            tables.append(f"{self.root}/leading-{step}")
            table = self._save(found.observe(watch, F.count("v").alias("n")), f"leading-{step}")
            return table.select(PANEL, "v"), watch.get["n"]

        def written(df: DataFrame, step: int) -> tuple[DataFrame, DataFrame]:
            """The blocks of a step, and what its tasks say."""
            path = f"{self.root}/short-{step}"
            df.write.option("compression", "uncompressed").option("parquet.enable.dictionary", "false").parquet(path)
            table = self.spark.read.schema(SHORT_STEP).parquet(path)
            return table.where("kind = 0").select(*names_of(HELD_ROWS)), table.where("kind = 1").select(*names_of(TOLD))

        since: dict[str, list[np.ndarray]] = {}
        send = self.spark.sparkContext.broadcast

        state, told = written(self.rows.select(*names_of(ROWS)).mapInArrow(_hold, SHORT_STEP), 0)
        vectors, at_work = leading(told, 0)
        step = held = before = 0
        while at_work and step < p.max_iter:
            step += 1
            if small:
                for name, v in vectors.items():
                    since.setdefault(name, []).append(np.array(v))
                known, on = send((since, set(vectors))), state
            else:
                known, on = None, state.join(self._dealt(vectors).select(PANEL, "salt", "v"), [PANEL, "salt"], "left")
            if small and step % REDONE:
                told = on.select(PANEL, "t", "n", "gaps", "z").mapInArrow(_short_step(known, False), TOLD)
            else:
                held = step
                state, told = written(on.mapInArrow(_short_step(known, True), SHORT_STEP), step)
                since = {}
            vectors, at_work = leading(told, step)
            log.info("EM step %d of panels of short vectors: %d go on", step, at_work)
            if held == step:
                self.drop(f"{self.root}/short-{before}")
                before = step
        state = state.mapInArrow(_let_go(send(since)), STATE)
        outcome = "panel_id string, n_iter int, delta double"
        if small:
            return state, self.spark.createDataFrame([(panel, *end) for panel, end in last.items()], outcome)
        # a panel that has converged has no row in the later tables
        every = self.spark.read.schema(LEADING).parquet(*tables)
        return state, every.groupBy(PANEL).agg(F.max("n_iter").alias("n_iter"), F.max_by("delta", "n_iter").alias("delta"))

    def run(self) -> tuple[DataFrame, DataFrame]:
        """State rows at the end, and (panel, n_iter, delta)."""
        ends = []
        shapes = self.shapes
        short = F.col("n") <= SHORT
        for of, way in ((short, self._short), (~short, self._iterated)):
            self.shapes = shapes.where(of)
            if not self.shapes.isEmpty():
                ends.append(way())
        return ends[0] if len(ends) == 1 else tuple(a.unionByName(b) for a, b in zip(*ends, strict=True))

    def _iterated(self) -> tuple[DataFrame, DataFrame]:
        """The steps of panels whose leading vectors take several passes."""
        p = self.params
        outcome = self.shapes.select(PANEL, F.lit(0).alias("n_iter"), F.lit(math.inf).alias("delta"))
        basis = self._save(self.shapes.groupBy(PANEL).applyInPandas(_first_basis, BASIS), "basis")
        history: list[DataFrame] = []
        for step in range(1, p.max_iter + 1):
            vectors = self.leading(basis, f"pass-{step}")
            moved = self.state.groupBy(PANEL, "salt").cogroup(self._dealt(vectors).groupBy(PANEL, "salt")).applyInPandas(_refill, STEP)
            path = f"wide-{step}"
            moved.write.partitionBy("kind").parquet(f"{self.root}/{path}")
            self.state = self.spark.read.schema(STATE).parquet(f"{self.root}/{path}/kind=0")
            norms = self.spark.read.schema(f"{PANEL} string, num double, den double").parquet(f"{self.root}/{path}/kind=1")
            per = norms.groupBy(PANEL).agg((F.sqrt(F.sum("num")) / (F.sqrt(F.sum("den")) + 1e-12)).alias("delta"))
            per = self._save(per.select(PANEL, F.lit(step).alias("n_iter"), "delta"), f"norms-{step}")
            history.append(per)
            going = per.where(F.col("delta") >= p.tol).select(PANEL)
            at_work = going.count()
            log.info("EM step %d of wide panels: %d go on, %d passes so far", step, at_work, self.passes)
            basis = self._save(vectors.join(going, PANEL, "left_semi").withColumn("lead", F.lit(0)).withColumn("done", F.lit(False)), f"start-{step}")
            self.drop(f"{self.root}/wide-{step - 1}/kind=0")
            self.drop(f"{self.root}/start-{step - 1}")
            for i in range(MOST_PASSES):
                if not self.drop(f"{self.root}/pass-{step}-{i}"):
                    break
            if not at_work:
                break
        if history:
            every = history[0]
            for h in history[1:]:
                every = every.unionByName(h)
            outcome = every.groupBy(PANEL).agg(F.max("n_iter").alias("n_iter"), F.max_by("delta", "n_iter").alias("delta"))
        return self.state, outcome
