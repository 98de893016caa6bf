"""Conversation structure repair: cheapest edits to a legal order of roles, by Four-Russians block tables.

A legal conversation has the role initials ``(s?(ua)+)?``. A row may be kept (0), given the role user or assistant
(2) or deleted (3, the only choice for a blank or repeated row); an empty row of either role may be inserted anywhere
(2); a truncated row that stays adds 1. The cheapest edits, and of equally cheap ones those whose letters K, R, D, I
are ASCII-least, come from four states (nothing yet, after s, after u, after a) and their costs:

* the cost vectors, less their smallest entry, are finitely many: a state too dear ever to be on a cheapest path is
  dropped. A table holds, for each vector and each block of ``BLOCK`` row symbols, the vector behind it and what it adds;
* blocks are processed by lookup, keeping the vector before each;
* blocks are then expanded from the last to the first: inside one, the states that lie on some cheapest path are marked
  backward, each with its least letter that stays on such paths, so that the walk from the start meets no tie.

Rows are sorted over all partitions by (conv_id, turn, ...), so a conversation may lie in several tasks; each task has
a *piece* of it, a byte a row. The pieces that touch a partition's edge (two a partition) are put together by their
4 x 4 cost matrices, which have nothing of the rows. Only ``digests`` passes a whole conversation through one task, as a
stream: a hash of one text is sequential.

Defined results: a null role or text is one space; null turns come first; a null conv_id is a conversation of its own;
rows of equal turn stand in the order of the columns named (by default role, then text); a row that equals another in
all columns is its duplicate; a role counts by its first character, any but s, u, a must be changed or deleted; a blank
or very long text is like any other; an empty table gives an empty result; other columns are not read and cannot clash.
"""

from __future__ import annotations

import hashlib
from itertools import chain, groupby, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from macropanel.llm.common import Scratch

#: Rows of a block of the table, and rows that a task hands back at a time.
BLOCK, STEP_ROWS = 4, 2000
#: Blocks with their ends whose ways a task keeps.
KEPT = 200_000
RETYPE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 40
#: What an inserted row leads to from each state.
INSERTED = (USER, USER, ASSISTANT, USER)
#: Row symbols: must go; kept whole; kept although truncated. Each by the initial s, u, a or another one.
GOES, WHOLE, TRUNCATED = "0123", "suao", "SUAO"
SYMBOLS = len(WHOLE) * 2 + 1
CODE = str.maketrans(GOES + WHOLE + TRUNCATED, "000012345678")
INITIAL = str.maketrans(GOES + TRUNCATED, WHOLE * 2)
LEGAL = ("su", "ua", "au")
#: Insertions that end a conversation, by state.
CLOSING = ("", "II", "I", "")
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def row_edges(state: int, code: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the ways past a row, letters in ASCII order."""
    edges = [("D", DELETE, state)]
    if code:
        cut, initial = CUT * (code > 4), "suao"[(code - 1) % 4]
        to = {"s": SYSTEM if state == START else None, "u": USER if state != USER else None, "a": ASSISTANT if state == USER else None}.get(initial)
        if to is not None:
            edges.append(("K", cut, to))
        edges.append(("R", RETYPE + cut, INSERTED[state]))
    return edges


def closed(costs: list[int]) -> tuple[tuple[int, ...], int]:
    """Costs after any insertions, without states off every cheapest path, less the smallest; and that smallest."""
    c = list(costs)
    for _ in range(2):  # no cheapest path inserts three rows in a row
        for s, to in enumerate(INSERTED):
            c[to] = min(c[to], c[s] + INSERT)
    # what starts after a system row can start after an assistant row, and at the beginning too, but for a system row
    if c[SYSTEM] > c[ASSISTANT]:
        c[SYSTEM] = NEVER
    if c[START] > c[ASSISTANT] + DELETE:
        c[START] = NEVER
    low = min(c)
    return tuple(min(x - low, NEVER) if x < NEVER else NEVER for x in c), low


def advance(vector: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int]:
    """The costs behind one row."""
    out = [NEVER] * 4
    for s, cost in enumerate(vector):
        if cost < NEVER:
            for _, w, to in row_edges(s, code):
                out[to] = min(out[to], cost + w)
    return closed(out)


UNITS = [tuple(0 if i == s else NEVER for i in range(4)) for s in range(4)]
FIRST = closed(list(UNITS[START]))[0]


class Solver:
    """Vectors that rows can lead to, the transitions of rows and of blocks between them, and what is done with them.

    A task makes its own; ``expanded`` keeps blocks met before, ``KEPT`` of them at most.
    """

    def __init__(self) -> None:
        self.vectors = list(dict.fromkeys([FIRST, *UNITS]))
        self.number = {v: k for k, v in enumerate(self.vectors)}
        self.expanded: dict[tuple, tuple] = {}
        rows = []
        for v in self.vectors:  # grows as it is walked
            after = [advance(v, code) for code in range(SYMBOLS)]
            for w, _ in after:
                if w not in self.number:
                    self.number[w] = len(self.vectors)
                    self.vectors.append(w)
            rows.append([(self.number[w], low) for w, low in after])
        step, add = (np.array([[x[k] for x in row] for row in rows]) for k in (0, 1))
        at, cost = np.arange(len(rows))[:, None], np.zeros((len(rows), 1), np.int64)
        for _ in range(BLOCK):  # block codes are digits to the base SYMBOLS, the first row's the highest
            cost = (cost[:, :, None] + add[at]).reshape(len(rows), -1)
            at = step[at].reshape(len(rows), -1)
        self.row, self.row_cost, self.block, self.block_cost = step.tolist(), add.tolist(), at.tolist(), cost.tolist()

    def through(self, v: int, block: bytes) -> tuple[int, int]:
        """Vector behind a block and the cost it adds, by lookup; a short last block row by row."""
        if len(block) == BLOCK:
            code = 0
            for c in block:
                code = code * SYMBOLS + c
            return self.block[v][code], self.block_cost[v][code]
        cost = 0
        for c in block:
            v, cost = self.row[v][c], cost + self.row_cost[v][c]
        return v, cost

    def forward(self, blocks: list[bytes], v: int) -> tuple[list[int], int, int]:
        """The vector before each block, the one behind the last, and the cost added."""
        before, cost = [], 0
        for block in blocks:
            before.append(v)
            v, add = self.through(v, block)
            cost += add
        return before, v, cost

    def expand(self, v: int, block: bytes, ends: frozenset[int]) -> tuple[frozenset[int], dict[int, tuple[str, int]]]:
        """Backward through a block: states before it on a cheapest path to ``ends``, each with its letters and its end."""
        if (key := (v, block, ends)) in self.expanded:
            return self.expanded[key]
        costs, at, low = [list(self.vectors[v])], v, 0
        for c in block:
            low += self.row_cost[at][c]
            at = self.row[at][c]
            costs.append([x + low if x < NEVER else NEVER for x in self.vectors[at]])
        ways, on = {s: ("", s) for s in ends}, set(ends)
        for k in range(len(block) - 1, -1, -1):
            here, there = costs[k], costs[k + 1]
            by_row: dict[int, tuple[str, int]] = {}  # the least letter past the row that stays on cheapest paths
            for s in range(4):
                for letter, w, to in row_edges(s, block[k]):
                    if here[s] < NEVER and to in on and here[s] + w == there[to]:
                        by_row[s] = (letter, to)
                        break
            on, leads = marked(here, set(by_row))
            new: dict[int, tuple[str, int]] = {}

            def way(s: int) -> tuple[str, int]:
                if s not in new:
                    if s in leads and (s not in by_row or by_row[s][0] > "I"):
                        letters, end = way(leads[s])
                        new[s] = ("I" + letters, end)
                    else:
                        letters, end = ways[by_row[s][1]]
                        new[s] = (by_row[s][0] + letters, end)
                return new[s]

            for s in on:
                way(s)
            ways = new
        if len(self.expanded) >= KEPT:
            self.expanded.clear()
        self.expanded[key] = frozenset(on), ways
        return self.expanded[key]

    def trace(self, blocks: list[bytes], before: list[int], ends: frozenset[int]) -> dict[int, tuple[str, int]]:
        """For each state before the blocks on a cheapest path: its letters and the state behind the last row."""
        kept = []
        for block, v in zip(reversed(blocks), reversed(before), strict=True):
            ends, ways = self.expand(v, block, ends)
            kept.append(ways)
        out = {}
        for first in ends:
            s, letters = first, []
            for ways in reversed(kept):
                part, s = ways[s]
                letters.append(part)
            out[first] = ("".join(letters), s)
        return out

    def solve(self, symbols: str) -> tuple[int, str]:
        """Cost and letters of a whole conversation."""
        blocks = blocks_of(symbols)
        before, v, cost = self.forward(blocks, self.number[FIRST])
        rest, ends = last_states(list(self.vectors[v]))
        letters, last = self.trace(blocks, before, ends)[START]
        return cost + rest, letters + CLOSING[last]

    def matrix(self, symbols: str) -> list[int]:
        """Costs from each state before a piece to each state behind it, row by row."""
        blocks, out = blocks_of(symbols), []
        for unit in UNITS:
            _, v, cost = self.forward(blocks, self.number[unit])
            out += [min(x + cost, NEVER) for x in self.vectors[v]]
        return out


def blocks_of(symbols: str) -> list[bytes]:
    """Row codes, a byte each, in blocks; the last may be shorter."""
    codes = bytes(c - 48 for c in symbols.translate(CODE).encode())
    return [codes[k : k + BLOCK] for k in range(0, len(codes), BLOCK)]


def marked(costs: list[int], on: set[int]) -> tuple[set[int], dict[int, int]]:
    """``on`` with the states that an insertion leads from at no loss; and where it leads."""
    on, leads = set(on), {}
    for _ in range(2):
        for s, to in enumerate(INSERTED):
            if costs[s] < NEVER and to in on and costs[s] + INSERT == costs[to]:
                on.add(s)
                leads[s] = to
    return on, leads


def last_states(costs: list[int]) -> tuple[int, frozenset[int]]:
    """Cost of a cheapest end, and the states from which it is reached (with insertions)."""
    total = min(costs[START], costs[ASSISTANT])
    return total, frozenset(marked(costs, {s for s in (START, ASSISTANT) if costs[s] == total})[0])


def illegal(symbols: str) -> int:
    initials = symbols.translate(INITIAL)
    return sum(initials[k : k + 2] not in LEGAL for k in range(len(initials) - 1))


# --- Spark ---------------------------------------------------------------------------------------------------


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


class Repair:
    """Repair of all conversations of a table with conv_id, turn, role and text.

    ``lines`` are the rows in order (piece, at) with their fault; ``plans`` has a piece's letters and the state before
    it; ``summary`` and ``repaired`` are made of them. ``order`` names the columns that order rows of equal turn.
    """

    def __init__(self, conversations: DataFrame, order: tuple[str, ...] = ("role", "text")):
        self.scratch = Scratch(conversations.sparkSession, "conversations")
        self.id_type = conversations.schema["conv_id"].dataType.simpleString()
        rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), _text("role").alias("role"), _text("text").alias("text"), *[F.col(c).alias(f"o{k}") for k, c in enumerate(order)])
        rows = self.scratch.save(rows.withColumn("n", F.monotonically_increasing_id()), "rows")
        self.key = ["turn", *[f"o{k}" for k in range(len(order))], "n"]
        sorted_ = self._sorted(self._with_faults(rows))
        self.table = self.scratch.save(sorted_, "sorted")
        for name in ("rows", "again"):
            self.scratch.drop(name)
        self.lines = self.table.where("at >= 0").drop("symbols", "edge")
        self.pieces = self.table.where("at < 0").select("conv_id", "piece", "symbols", "edge")
        self.plans = self.scratch.save(self._plans(), "plans")

    def _with_faults(self, rows: DataFrame) -> DataFrame:
        """The first fault of each row. Repeated (role, text) of a conversation are found by key, with the first's place."""
        place = F.struct(*self.key)
        keyed = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
        again = keyed.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
        again = self.scratch.save(again.toDF("_conv", "_role", "_digest", "_first"), "again")
        on = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
        trimmed = F.rtrim("text", F.lit(BLANK))
        fault = F.when(trimmed == "", "blank").when(place > F.col("_first"), "duplicate").when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated")
        return keyed.join(again, on, "left").select("conv_id", *self.key, "role", "text", fault.alias("fault"))

    def _sorted(self, rows: DataFrame) -> DataFrame:
        """Rows over range partitions, numbered in each piece; a piece's symbols are a row of their own at -1."""
        initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("o")
        goes = F.col("fault").isin("blank", "duplicate")
        symbol = F.when(goes, F.translate(initial, WHOLE, GOES)).when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
        dealt = rows.withColumn("symbol", symbol).repartitionByRange("conv_id", *self.key).sortWithinPartitions("conv_id", *self.key)

        def kernel(batches):
            from pyspark import TaskContext

            piece, first, conv, symbols = TaskContext.get().partitionId(), True, None, []
            names = ["conv_id", "piece", "at", "role", "text", "fault", "symbols", "edge"]

            def closing(edge: bool, kind: pa.DataType) -> pa.RecordBatch:
                values = [conv, piece, -1, None, None, None, "".join(symbols), edge]
                types = [kind, pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_()]
                return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

            kind = None
            for batch in batches:
                kind, at = batch.schema.field(0).type, 0
                for value, same in groupby(batch.column(0).to_pylist()):
                    m = sum(1 for _ in same)
                    if symbols and value != conv:
                        yield closing(first, kind)
                        first, symbols = False, []
                    conv, start = value, sum(map(len, symbols))
                    part = batch.slice(at, m)
                    symbols.append("".join(part.column("symbol").to_pylist()))
                    arrays = [part.column(0), pa.array([piece] * m, pa.int32()), pa.array(range(start, start + m), pa.int64())]
                    arrays += [part.column(c).cast(pa.string()) for c in ("role", "text", "fault")] + [pa.nulls(m, pa.string()), pa.nulls(m, pa.bool_())]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                    at += m
            if symbols:
                yield closing(True, kind)

        return dealt.select("conv_id", "role", "text", "fault", "symbol").mapInArrow(kernel, f"conv_id {self.id_type}, piece int, at long, role string, text string, fault string, symbols string, edge boolean")

    def _plans(self) -> DataFrame:
        """conv_id, piece, state (before it), letters, cost (of the conversation, at its last piece), illegal, first, last."""
        out = f"conv_id {self.id_type}, piece int, state int, letters string, cost long, illegal long, first string, last string"

        fields = _fields(out)

        def inner(batches):
            solver = Solver()
            for batch in batches:
                symbols = batch.column("symbols").to_pylist()
                solved = [solver.solve(x) for x in symbols]
                yield _batch(batch, fields, {"state": [START] * len(symbols), "letters": [x[1] for x in solved], "cost": [x[0] for x in solved], **_seen(symbols)})

        whole = self.pieces.where("not edge").drop("edge").mapInArrow(inner, out)

        # pieces at the edges of partitions, two a partition at most: their matrices meet by conversation
        edges = self.pieces.where("edge").drop("edge")

        with_matrix = f"conv_id {self.id_type}, piece int, m array<long>"
        matrix_fields = _fields(with_matrix)

        def matrices(batches):
            solver = Solver()
            for batch in batches:
                yield _batch(batch, matrix_fields, {"m": [solver.matrix(x) for x in batch.column("symbols").to_pylist()]})

        def put_together(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
            """The vector before each piece and the states behind it on a cheapest path."""
            f = f.sort_values("piece", ignore_index=True)
            ms = [np.array(m, np.int64).reshape(4, 4) for m in f["m"]]
            start = [np.array(FIRST, np.int64)]
            for m in ms:
                c, low = closed([int(x) for x in np.minimum((start[-1][:, None] + m).min(axis=0), NEVER)])
                start.append(np.array([x + low if x < NEVER else NEVER for x in c]))
            total, on = last_states(start[-1].tolist())
            ends = []
            for k in range(len(ms) - 1, -1, -1):
                on, _ = marked(start[k + 1].tolist(), set(on))
                ends.append(sorted(on))
                on = {s for s in range(4) if start[k][s] < NEVER and any(start[k][s] + ms[k][s][t] == start[k + 1][t] for t in on)}
            vectors = [[int(x) for x in v] for v in start[:-1]]
            return pd.DataFrame({"conv_id": _same(key, f), "piece": f["piece"], "vector": vectors, "ends": ends[::-1], "cost": int(total), "behind": f["piece"].shift(-1).isna()})

        started = edges.mapInArrow(matrices, with_matrix).groupBy("conv_id").applyInPandas(put_together, f"conv_id {self.id_type}, piece int, vector array<long>, ends array<int>, cost long, behind boolean")
        started = self.scratch.save(started, "started").select(F.col("conv_id").alias("_conv"), F.col("piece").alias("_piece"), "vector", "ends", "cost", "behind")
        ready = edges.join(started, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece"))).drop("_conv", "_piece")

        with_ways = f"conv_id {self.id_type}, piece int, behind boolean, cost long, letters array<string>, to array<int>, illegal long, first string, last string"
        way_fields = _fields(with_ways)

        def traced(batches):
            solver = Solver()
            for batch in batches:
                symbols, found = batch.column("symbols").to_pylist(), []
                for x, vector, ends in zip(symbols, batch.column("vector").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                    low, blocks = min(vector), blocks_of(x)
                    v = solver.number[tuple(c - low if c < NEVER else NEVER for c in vector)]
                    found.append(solver.trace(blocks, solver.forward(blocks, v)[0], frozenset(ends)))
                ways = [[w.get(s, (None, None)) for s in range(4)] for w in found]
                yield _batch(batch, way_fields, {"letters": [[x[0] for x in w] for w in ways], "to": [[x[1] for x in w] for w in ways], **_seen(symbols)})

        ways = self.scratch.save(ready.mapInArrow(traced, with_ways), "ways")

        def walk(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
            f = f.sort_values("piece", ignore_index=True)
            states = [START]
            for to in f["to"]:
                states.append(int(to[states[-1]]))
            return pd.DataFrame({"conv_id": _same(key, f), "piece": f["piece"], "state": states[:-1], "after": states[1:]})

        states = ways.select("conv_id", "piece", "to").groupBy("conv_id").applyInPandas(walk, f"conv_id {self.id_type}, piece int, state int, after int")
        states = states.toDF("_conv", "_piece", "state", "after")
        joined = ways.join(states, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("piece") == F.col("_piece")))
        closing = F.when(F.col("behind"), F.element_at(F.array(*map(F.lit, CLOSING)), F.col("after") + 1)).otherwise("")
        letters = F.concat(F.element_at("letters", F.col("state") + 1), closing)
        cost = F.when(F.col("behind"), F.col("cost")).otherwise(F.lit(0).cast("long"))
        edge_plans = joined.select("conv_id", "piece", "state", letters.alias("letters"), cost.alias("cost"), "illegal", "first", "last")
        return whole.unionByName(edge_plans)

    def summary(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: a row per conversation that has rows."""
        pieces = F.array_sort(F.collect_list(F.struct("piece", "first", "last", "letters")))
        plans = self.plans.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"), pieces.alias("p"))
        between = F.expr(f"size(filter(sequence(0, size(p) - 1), k -> k > 0 and concat(p[k - 1].last, p[k].first) not in {LEGAL}))")
        return plans.select("conv_id", (F.col("illegal") + F.when(F.size("p") > 1, between).otherwise(0)).alias("illegal"), "cost", F.array_join(F.col("p.letters"), "").alias("audit"))

    def faults(self) -> DataFrame:
        """conv_id, blank, duplicate, truncated: rows by their first fault."""
        return self.lines.groupBy("conv_id").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])

    def _stream(self) -> DataFrame:
        plans = self.plans.select("conv_id", "piece", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "letters", "state")
        return self.lines.select("conv_id", "piece", "at", "role", "text", F.lit(None).cast("string").alias("letters"), F.lit(None).cast("int").alias("state")).unionByName(plans)

    def repaired(self) -> DataFrame:
        """conv_id, piece, at, edit, role, text: the repaired rows in order; a deleted row has no row here."""
        dealt = self._stream().repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "at")
        out = f"conv_id {self.id_type}, piece int, at long, edit string, role string, text string"
        fields = _fields(out)

        def kernel(batches):
            rows = _edited(batches)
            while made := list(islice(rows, STEP_ROWS)):
                yield _rows(made, fields)

        return dealt.mapInArrow(kernel, out)

    def digests(self) -> DataFrame:
        """conv_id, repaired_sha256 of the repaired ``role:text`` joined by newlines: each conversation a stream of one task."""
        dealt = self._stream().repartition("conv_id").sortWithinPartitions("conv_id", "piece", "at")
        out = f"conv_id {self.id_type}, repaired_sha256 string"
        fields = _fields(out)

        def hashed(batches):
            for conv, rows in groupby(_edited(batches, marks=True), key=lambda r: r[0]):
                h, between = hashlib.sha256(), b""
                for _, _, _, _, role, text in rows:
                    if role is not None:
                        h.update(between + f"{role}:{text}".encode())
                        between = b"\n"
                yield conv, h.hexdigest()

        def kernel(batches):
            rows = hashed(batches)
            while made := list(islice(rows, STEP_ROWS)):
                yield _rows(made, fields)

        return dealt.mapInArrow(kernel, out)


def _fields(ddl: str) -> pa.Schema:
    """The Arrow form of a schema; made on the driver, as the parser is there."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def _rows(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)


def _batch(batch: pa.RecordBatch, fields: pa.Schema, made: dict[str, list]) -> pa.RecordBatch:
    """The batch's own columns of the schema (a null or large conv_id as it is) and those made."""
    return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name).cast(f.type) for f in fields], schema=fields)


def _seen(symbols: list[str]) -> dict[str, list]:
    """What the places between pieces need of each."""
    initials = [x.translate(INITIAL) for x in symbols]
    return {"illegal": [illegal(x) for x in symbols], "first": [x[0] for x in initials], "last": [x[-1] for x in initials]}


def _same(key: tuple, f: pd.DataFrame) -> pd.Series:
    """The group's conv_id on every row; pandas would make a null id a float."""
    return pd.Series([None if pd.isna(key[0]) else key[0]] * len(f), dtype=object)


def _edited(batches, marks: bool = False):
    """Repaired rows (conv, piece, number in the piece, letter, role, text) of sorted rows, each piece behind its letters.

    With ``marks`` every piece begins with a row of role None, so that a conversation without a row is seen too.
    """
    here, letters, at, state, k = None, "", 0, START, 0
    names = ("conv_id", "piece", "at", "role", "text", "letters", "state")
    rows = (r for batch in batches for r in zip(*[batch.column(c).to_pylist() for c in names], strict=True))
    for conv, piece, place, role, text, plan, before in chain(rows, [(None, None, -1, None, None, None, None)]):
        while at < len(letters) and letters[at] == "I":  # before this row, or behind the piece's last
            state = INSERTED[state]
            yield (*here, k, "I", "user" if state == USER else "assistant", "")
            at, k = at + 1, k + 1
        if place < 0:
            here, letters, at, state, k = (conv, piece), plan or "", 0, before, 0
            if marks and plan is not None:
                yield (*here, -1, "", None, None)
            continue
        letter, at = letters[at], at + 1
        if letter == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        elif letter == "R":
            state = INSERTED[state]
            role = "user" if state == USER else "assistant"
        if letter != "D":
            yield (*here, k, letter, role, text)
            k += 1


# --- the contract's query ------------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's faults by crc32 of ``conv_id:turn``; o_role and o_text are what the row had, copy its number."""
    key = F.concat(_text("conv_id"), F.lit(":"), _text("turn"))
    rows = conversations.select("conv_id", "turn", _text("role").alias("o_role"), _text("text").alias("o_text"), (F.crc32(key.cast("binary")) % 20).alias("c")).where("c != 0")
    text = F.when(F.col("c") == 1, "").when(F.col("c") == 2, F.regexp_replace("o_text", "[.!?]", "")).otherwise(F.col("o_text"))
    copies = F.explode(F.when(F.col("c") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("c") == 4, "user").otherwise(F.col("o_role")).alias("role"), text.alias("text"), "o_role", "o_text", copies.alias("copy"))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every conversation's faults after the damage, the cheapest repair and its digest."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = damage(conversations)
    repair = Repair(rows, ("o_role", "o_text", "copy"))
    gaps = rows.groupBy("conv_id").agg(F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count_distinct("turn").alias("n"))
    gaps = gaps.select("conv_id", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n"), F.lit(0)).cast("long").alias("gaps"))
    out = conversations.select("conv_id").distinct()
    for k, part in enumerate((gaps, repair.faults(), repair.summary(), repair.digests())):
        part = part.withColumnRenamed("conv_id", f"_conv{k}")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col(f"_conv{k}")), "left").drop(f"_conv{k}")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
