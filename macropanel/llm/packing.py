"""Best-fit packing: partitions best-fit locally, nearly full bins leave, underfull bins merge up a tree.

``tokenize`` cuts documents into pieces of at most ``capacity`` ids; ``pack`` places pieces into sequences:

* round 0, in the tasks that made the pieces: best-fit decreasing over up to ``local_items`` pieces at a time;
* bins with at most ``slack`` free places are sequences. The others are items of the next round, known by
  their id and total alone (their pieces stay where they are), dealt over groups of at most ``group_items``
  that are best-fit again, and so on until one group has taken all that is left. Each round writes which item
  went into which bin and where; a round in which less than a share ``least_gain`` of the bins went away ends the tree,
  because what is left no longer fits together.

Nothing but bin ids and totals is shuffled between rounds; a task holds one group of bounded size.

Defined results: a null or empty text is the single id 0 and so a piece of length 1; rows that repeat a doc_id
are documents of their own; a document longer than the capacity is cut so that only its first piece may be
shorter; items of equal length keep their order and bins of equal room fill the last opened first; a very long text
is encoded whole; an empty table packs into no sequence; only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macropanel.llm.common import Scratch, whole
from macropanel.llm.tokens import ByteBpe

CAPACITY = 2048
SLACK = 8
LOCAL_ITEMS = 50_000
GROUP_ITEMS = 50_000
LEAST_GAIN = 0.001
END = 0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: A bin's id: its round (from bit 56), its task or group (from bit 28) and its place there.
ROUND_AT, GROUP_AT = 56, 28


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)]


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing: (bin of each item, its offset there, total of each bin). Ties keep the given order.

    Open bins are kept by free room, and the rooms that some bin has as bits of one integer, so the tightest
    room that still holds an item is its lowest set bit from the item's length on.
    """
    where, offset, totals = [0] * len(lengths), [0] * len(lengths), []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        if fits := rooms >> n:
            room = n + ((fits & -fits).bit_length() - 1)
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(totals)
            totals.append(0)
        where[i], offset[i] = b, totals[b]
        totals[b] += n
        if left := room - n:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return where, offset, totals


def tokenize_and_fit(docs: DataFrame, capacity: int, local_items: int, vocab_dir: str | None) -> DataFrame:
    """Pieces with the bin that round 0 gave them (bin0, offset0) and that bin's total."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "bin0", "offset0", "total"]

    def kernel(batches):
        from pyspark import TaskContext

        encode, task = ByteBpe(vocab_dir), TaskContext.get().partitionId()
        held, made = [], 0

        def fitted():
            where, offset, totals = best_fit([p[3] for p in held], capacity)
            base = (task << GROUP_AT) + made
            columns = [*map(list, zip(*held, strict=True)), [base + b for b in where], offset, [totals[b] for b in where]]
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 6]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names), len(totals)

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):  # one text at a time is a Python object
                x = encode(texts[i].as_py())
                raw = x.astype("<u4").tobytes() + END.to_bytes(4, "little")
                doc = ids[i].as_py()
                held += [(doc, k, a, n, zlib.crc32(raw[4 * a : 4 * (a + n)])) for k, (a, n) in enumerate(cuts(len(x) + 1, capacity))]
                if len(held) >= local_items:
                    out, bins = fitted()
                    held, made = [], made + bins
                    yield out
        if held:
            yield fitted()[0]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    return rows.mapInArrow(kernel, f"{PIECES}, bin0 long, offset0 long, total long")


def merge_round(bins: DataFrame, round_: int, groups: int, capacity: int) -> DataFrame:
    """bins (bin, total) -> (bin, into, offset, total of into), best-fit within each group."""

    def kernel(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["total", "bin"], ascending=[False, True], ignore_index=True)
        where, offset, totals = best_fit(pdf["total"].tolist(), capacity)
        base = (round_ << ROUND_AT) + (int(key[0]) << GROUP_AT)
        return pd.DataFrame({"bin": pdf["bin"], "into": [base + b for b in where], "offset": offset, "total": [totals[b] for b in where]})

    dealt = bins.withColumn("g", F.pmod(F.xxhash64("bin", F.lit(round_)), F.lit(groups)))
    return dealt.groupBy("g").applyInPandas(kernel, "bin long, into long, offset long, total long")


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    slack: int = SLACK,
    local_items: int = LOCAL_ITEMS,
    group_items: int = GROUP_ITEMS,
    least_gain: float = LEAST_GAIN,
    vocab_dir: str | None = None,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row per piece."""
    scratch = Scratch(docs.sparkSession, "pack")
    pieces = scratch.save(tokenize_and_fit(docs, capacity, local_items, vocab_dir), "pieces")
    under = f"total < {capacity - slack}"
    left = scratch.save(pieces.where("offset0 = 0").where(under).select(F.col("bin0").alias("bin"), "total"), "left-0")
    n, moves, round_ = left.count(), [], 0
    while n:
        round_ += 1
        groups = -(-n // group_items)
        move = scratch.save(merge_round(left, round_, groups, capacity), f"moves-{round_}")
        moves.append(move)
        scratch.drop(f"left-{round_ - 1}")
        bins = move.where("offset = 0").select(F.col("into").alias("bin"), "total")
        after = bins.count()
        if groups == 1 or n - after < least_gain * n:
            break
        left = scratch.save(bins.where(under), f"left-{round_}")
        n = left.count()
    if not moves:
        return pieces.select(*[c for c in pieces.columns[:5]], F.col("bin0").alias("sequence_id"), F.col("offset0").alias("offset"))

    def through(first: DataFrame, then: DataFrame) -> DataFrame:
        """Both rounds as one: a bin that the later round moved on is followed there."""
        t = then.select(F.col("bin").alias("_b"), F.col("into").alias("_i"), F.col("offset").alias("_o"))
        on = first.join(t, F.col("into") == F.col("_b"), "left")
        return on.select("bin", F.coalesce("_i", "into").alias("into"), (F.col("offset") + F.coalesce("_o", F.lit(0))).alias("offset"))

    final = reduce(through, moves[1:], moves[0].select("bin", "into", "offset"))
    out = pieces.join(final.select("bin", "into", F.col("offset").alias("_o")), F.col("bin0") == F.col("bin"), "left")
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "bin0").alias("sequence_id"), (F.col("offset0") + F.coalesce("_o", F.lit(0))).alias("offset")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every document packed into sequences of at most 2048 ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
