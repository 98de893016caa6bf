"""SimHash near-dedup: 64-bit fingerprints of word shingles, pigeonhole blocks, verified Hamming distance.

A fingerprint is cut into 6 blocks. Two fingerprints that differ in at most 3 bits agree in at least 3 blocks,
so a join on every choice of 3 blocks (20 keys of 31 to 33 bits each) finds all close pairs; the distance is
then verified. Work is on distinct fingerprints: any number of equal texts is one row there.

Within a bucket the members are first tied to the bucket's smallest by one verified star; only members that
are not yet in one component are then compared, so a large group of near copies makes few rows. A bucket of more
than ``crowd`` members is cut the same way once more: the bits that its key leaves over make 6 half blocks of 5 or 6
bits, of which a close pair again shares 3, so its members meet by 20 finer keys and no group can hold
more than 2^18 fingerprints, whatever the table's size.
Components are found in Spark (``components``).

Defined results: null and empty texts, and texts without a word, have fingerprint zero and are linked like any
other; a text of fewer words than a shingle is one shingle; a null doc_id takes part, and component_id is the
smallest doc_id of the component that is not null (null if there is none); rows that repeat a doc_id keep
their rows; a bit set in exactly half the hashes is 0; a very long text is hashed whole, in steps; an empty table gives an empty result; only doc_id and text are read, other columns cannot clash.
"""

from __future__ import annotations

from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macropanel.llm.common import Scratch, as_row, text_key
from macropanel.llm.components import connected_components

WORDS = 3
BITS = 3
#: Bit positions from the highest at which the blocks of a fingerprint begin and end.
CUTS = (0, 11, 22, 33, 44, 54, 64)
WIDEST = max(b - a for a, b in pairwise(CUTS))
SEED = 42
#: Members of a bucket from which on it is cut into finer ones.
CROWD = 1024
#: Characters of text whose hashes the kernel sums up at a time.
STEP_CHARS = 1_000_000


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint of one text, by the definition (the brute-force form that the tests use)."""
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s, SEED) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def _shingle_hashes(text: str, words: int) -> list[int]:
    w = text.encode().lower().split()
    if len(w) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(w), SEED)] if w else []
    flat, digest = b" ".join(w), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w))) + np.arange(len(w))
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [digest(flat[a:b], SEED) for a, b in zip(starts[: len(w) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]


def _majority(texts: list[str], words: int) -> np.ndarray:
    """Fingerprints of several texts (uint64): bit sums over all their shingle hashes at once."""
    each = [_shingle_hashes(t, words) for t in texts]
    n = np.array([len(x) for x in each], np.int64)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        h = np.concatenate([np.array(each[i], dtype=np.uint64) for i in some])
        first = np.concatenate(([0], np.cumsum(n[some])[:-1]))
        sums = np.empty((len(some), 64), np.int64)
        for k in range(8):  # a byte of the hash at a time bounds the unpacked bits to 8 bytes a shingle
            byte = ((h >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
            sums[:, 8 * k : 8 * k + 8] = np.add.reduceat(np.unpackbits(byte[:, None], axis=1, bitorder="little"), first, axis=0, dtype=np.int64)
        set_bits = 2 * sums > n[some][:, None]
        out[some] = (set_bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out


def with_fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, key (64 bits of the text), fp (the fingerprint as a signed long)."""

    def kernel(batches):
        for batch in batches:
            texts, held, size, out = batch.column(2), [], 0, [np.zeros(0, np.uint64)]
            for i in range(batch.num_rows):  # one text at a time becomes a Python string
                held.append(texts[i].as_py() or "")
                size += len(held[-1])
                if size > STEP_CHARS:
                    out.append(_majority(held, words))
                    held, size = [], 0
            out.append(_majority(held, words))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(out).view(np.int64))], names=["doc_id", "key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(kernel, "doc_id long, key long, fp long")


def _blocks() -> list[Column]:
    """The 6 blocks of the fingerprint."""
    return [F.shiftrightunsigned("fp", 64 - b).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in pairwise(CUTS)]


def _threes(blocks: list[Column], width: int) -> Column:
    """For every choice of 3 of 6 blocks, none wider than ``width`` bits: the choice's number before the chosen blocks' bits."""
    keys = []
    for c, chosen in enumerate(combinations(blocks, 3)):
        key = F.lit(c).cast("long")
        for block in chosen:
            key = F.shiftleft(key, width).bitwiseOR(block)
        keys.append(key)
    return F.array(*keys)


def _bucket_keys() -> Column:
    """For every choice of 3 blocks: (choice, bits of the chosen blocks)."""
    return _threes(_blocks(), WIDEST)


def _finer_keys() -> Column:
    """The keys of a bucket's member within its bucket: choices of 3 halves of the 3 blocks that the bucket's key leaves over."""
    left = F.array(*[F.array(*[F.lit(i) for i in range(6) if i not in chosen]) for chosen in combinations(range(6), 3)])
    blocks = F.array(*_blocks())
    over = F.get(left, F.shiftright("bucket", 3 * WIDEST).cast("int"))
    halves = []
    for k in range(3):
        block = F.get(blocks, F.get(over, F.lit(k)))
        halves += [F.shiftright(block, WIDEST // 2), block.bitwiseAND(F.lit((1 << WIDEST // 2) - 1))]
    return _threes(halves, WIDEST - WIDEST // 2)


def near_components(fps: DataFrame, scratch: Scratch, bits: int = BITS, crowd: int = CROWD) -> DataFrame:
    """Distinct fingerprints (fp) -> (fp, root): the smallest fingerprint linked to it by steps of at most ``bits`` bits.

    6 blocks of which 3 agree hold for up to 3 bits, at either level; ``crowd`` changes no result.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the blocks are laid out for at most 3 differing bits")
    keyed = fps.select("fp", F.explode(_bucket_keys()).alias("bucket"))
    heads = keyed.groupBy("bucket").agg(F.min("fp").alias("head"), F.count("*").alias("n")).where("n > 1").drop("n")
    shared = scratch.save(keyed.join(heads, "bucket"), "shared")
    close = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits
    stars = shared.where("fp != head").where(close("fp", "head")).select(F.col("fp").alias("a"), F.col("head").alias("b"))
    first = connected_components(stars, scratch, "star")
    root = first.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    placed = shared.select("bucket", "fp").join(root, F.col("fp") == F.col("_a"), "left").select("bucket", "fp", F.coalesce("_b", "fp").alias("root"))
    # buckets whose members are all in one component have nothing left to compare
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where("lo != hi").select("bucket", "n")
    finer = F.when(F.col("n") > crowd, _finer_keys()).otherwise(F.array(F.lit(-1).cast("long")))
    placed = scratch.save(placed.join(open_, "bucket").select("bucket", "fp", "root", F.explode(finer).alias("finer")), "open")
    scratch.drop("shared")
    x, y = (placed.select("bucket", "finer", F.col("fp").alias(f"fp_{s}"), F.col("root").alias(f"root_{s}")) for s in "xy")
    same = (x["bucket"] == y["bucket"]) & (x["finer"] == y["finer"])
    more = x.join(y, same & (F.col("root_x") < F.col("root_y")) & close("fp_x", "fp_y"))
    links = more.select(F.col("root_x").alias("a"), F.col("root_y").alias("b")).distinct()
    found = connected_components(first.union(links), scratch, "all").select(F.col("a").alias("fp"), F.col("b").alias("root"))
    scratch.drop("open")
    return found


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """doc_id, key, fp, root (smallest fingerprint of the component), component_id (its smallest doc_id): a row per document."""
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.save(with_fingerprints(docs, words), "marked")
    roots = scratch.save(near_components(marked.select("fp").distinct(), scratch, bits), "roots")
    scratch.keep("marked", "roots")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    by_fp = least.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    ids = by_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.save(by_fp.join(ids, "root").select("fp", "root", "component_id"), "named")
    scratch.drop("roots")
    return marked.join(named, "fp").select("doc_id", "key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """The documents with one row left of each group: that of the smallest (doc_id, text key), null doc_id last.

    Of rows equal in both, that whose other columns have the smallest hash stays, so reruns keep the same row.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    stay = near_duplicates(docs, words, bits).groupBy("root").agg(F.min(order).alias("s")).select(F.col("s.doc_id").alias("_d"), F.col("s.key").alias("_k"))
    rows = docs.select(as_row(docs), F.col("doc_id").cast("long").alias("_doc"), text_key().alias("_key"))
    one = rows.join(stay, (F.col("_key") == F.col("_k")) & F.col("_doc").eqNullSafe(F.col("_d")), "left_semi")
    other = F.xxhash64(F.to_json(F.col("row").dropFields("text")))
    return one.groupBy("_doc", "_key").agg(F.min_by("row", other).alias("row")).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: doc_id, fingerprint (16 hex digits) and component_id of every document."""
    d = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return d.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
