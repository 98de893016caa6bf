"""Line dedup, SimHash near-dedup and connected components against brute force."""

from __future__ import annotations

import os
import random
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from macropanel.llm import line_dedup, simhash
from macropanel.llm.common import Scratch, dropping_scratch
from macropanel.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts, ids=None):
    rows = [(i, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts, strict=True))]
    return spark.createDataFrame(rows, DOCS)


def lines_by_hand(rows):
    """[(doc_id, text)] -> {(doc_id, text): (kept text, removed lines)}; rows of distinct (doc_id, text) only."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), {}
    for doc, text in order:
        lines = (text or "").split("\n")
        covered = set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if not any(x.strip() for x in w):
                continue
            if w in seen:
                covered |= {i, i + 1, i + 2}
            seen.add(w)
        kept = text if not covered else "\n".join(x for i, x in enumerate(lines) if i not in covered)
        out[(doc, text)] = (kept, sorted(covered))
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["\n".join(rng.choice("abcde ") for _ in range(rng.randrange(0, 14))) for _ in range(120)]
    texts += [None, "", "\n\n\n\n", "a\nb", "long " * 30_000 + "\nx\ny\nz", "x\ny\nz\nx\ny\nz\nx\ny\nz", " \n\t\n \n \n"]
    want = lines_by_hand(list(enumerate(texts)))
    got = line_dedup.dedup_lines(table(spark, texts)).select("row.doc_id", "row.text", "kept", "removed").collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r["kept"], list(r["removed"])) == want[(r["doc_id"], r["text"])]


def test_every_removed_line_stays_somewhere(spark):
    rng = random.Random(6)
    texts = ["\n".join(rng.choice(["p", "q", "r", "s"]) for _ in range(12)) for _ in range(40)]
    kept = [r[0] for r in line_dedup.replace_text(table(spark, texts)).select("text").collect()]
    assert {x for t in texts for x in t.split("\n")} == {x for t in kept for x in t.split("\n") if t}


def test_line_dedup_edge_rows(spark):
    text = "one\ntwo\nthree\nfour"
    rows = [(1, text, "k", 7), (1, text, "k", 7), (None, text, "k", 7), (2, None, "k", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, starts int")  # names that the operator uses
    got = sorted(map(tuple, line_dedup.replace_text(docs).collect()), key=str)
    assert got == sorted([(1, text, "k", 7), (1, text, "k", 7), (None, "", "k", 7), (2, None, "k", 7)], key=str)
    assert line_dedup.replace_text(docs).columns == docs.columns
    assert line_dedup.replace_text(docs.limit(0)).count() == 0


def test_n_chars_follows_the_text(spark):
    got = line_dedup.replace_text(table(spark, ["a\nb\nc\nd", "a\nb\nc\ne"])).orderBy("doc_id").collect()
    assert [(r["text"], r["n_chars"]) for r in got] == [("a\nb\nc\nd", 7), ("e", 1)]


words = st.lists(st.sampled_from(["A", "b", "çé", "Straße", "x1", " ", "word"]), max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(words.map(" \t".join), min_size=1, max_size=6))
def test_fingerprint_kernel_equals_definition(texts):
    assert simhash._majority(texts, 3).tolist() == [simhash.fingerprint(t) for t in texts]


def components_by_hand(fps, bits):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(fps), 2):
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= bits:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("crowd", [simhash.CROWD, 1])
def test_near_components_lose_no_link(spark, crowd):
    rng = random.Random(1)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):  # chains, so that components are wider than 3 bits
            fps.add(f - (1 << 64) if f >> 63 else f)
            for _ in range(rng.randrange(1, 5)):
                f ^= 1 << rng.randrange(64)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r["fp"]: r["root"] for r in simhash.near_components(df, Scratch(spark, "t"), crowd=crowd).collect()}
    want = components_by_hand(fps, 3)
    assert {f: got.get(f, f) for f in fps} == want


def test_dense_group_of_near_copies(spark):
    base = 0x0123456789ABCDEF
    fps = {base} | {base ^ (1 << i) ^ (1 << j) for i in range(24) for j in range(24)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r["fp"]: r["root"] for r in simhash.near_components(df, Scratch(spark, "t")).collect()}
    assert {got.get(f, f) for f in fps} == {min(fps)}


@pytest.mark.parametrize("chosen", [(0, 1, 2), (3, 4, 5), (0, 2, 4)])
def test_crowded_buckets_of_unlike_fingerprints(spark, chosen):
    """Fingerprints that share three blocks and little else: the bucket is cut finer and no link is lost."""
    rng = random.Random(sum(chosen))
    free = [i for k in range(6) if k not in chosen for i in range(64 - simhash.CUTS[k + 1], 64 - simhash.CUTS[k])]
    base, fps = rng.getrandbits(64), set()
    for _ in range(250):
        f = base
        for i in rng.sample(free, 12):
            f ^= 1 << i
        for _ in range(rng.randrange(1, 4)):
            fps.add(f - (1 << 64) if f >> 63 else f)
            for i in rng.sample(free, 3):
                f ^= 1 << i
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    scratch = Scratch(spark, "t")
    got = {r["fp"]: r["root"] for r in simhash.near_components(df, scratch, crowd=100).collect()}
    want = components_by_hand(fps, 3)
    assert len(set(want.values())) > 100 and {f: got.get(f, f) for f in fps} == want
    assert not {"shared", "open"} & scratch.names


def test_finer_keys_of_close_pairs(spark):
    """Any two members of a bucket within 3 bits share a finer key, whichever blocks made the bucket."""
    rng = random.Random(8)
    pairs = []
    for _ in range(300):
        f = rng.getrandbits(64)
        g = f
        for i in rng.sample(range(64), rng.randrange(4)):
            g ^= 1 << i
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (f, g)))
    df = spark.createDataFrame(pairs, "f long, g long")
    sides = [df.select("f", "g", F.col(c).alias("fp")).select("f", "g", "fp", F.explode(simhash._bucket_keys()).alias("bucket")).select("f", "g", "bucket", simhash._finer_keys().alias(f"k{c}")) for c in "fg"]
    both = sides[0].join(sides[1], ["f", "g", "bucket"])
    assert both.select("f", "g").distinct().count() == len(set(pairs))
    assert both.where(~F.arrays_overlap("kf", "kg")).isEmpty()


def test_keep_one_takes_the_same_of_equal_rows(spark):
    rows = [(1, "one two three four", f"v{i}", None if i % 2 else i) for i in range(40)]
    kept = {
        tuple(simhash.keep_one(spark.createDataFrame(rng, "doc_id long, text string, `a``b` string, `c.d` long").repartition(n)).first())
        for n, rng in ((1, rows), (3, rows[::-1]), (7, rows[20:] + rows[:20]))
    }
    assert len(kept) == 1


def test_scratch_goes_with_its_scope(spark):
    docs = table(spark, ["a b c d", "a b c d", "e f g"], [1, 2, 3])
    with dropping_scratch():
        outer = Scratch(spark, "outer")
        kept = outer.save(docs, "kept")
        with dropping_scratch():
            inner = Scratch(spark, "inner")
            inner.save(docs, "gone")
        assert not os.path.exists(inner.root.removeprefix("file:")) and kept.count() == 3
        outer.save(docs, "more")
        outer.keep("kept")
        assert outer.names == {"kept"} and not os.path.exists(f"{outer.root.removeprefix('file:')}/more")
    assert not os.path.exists(outer.root.removeprefix("file:"))


def test_near_duplicates_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    fp = {d: simhash.fingerprint(t) for d, t in text.items()}
    comp = components_by_hand(set(fp.values()), 3)
    least = {}
    for d, f in fp.items():
        least[comp[f]] = min(d, least.get(comp[f], d))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.query(spark, "/root/testdata/sf0.001").collect()}
    assert got == {d: (f"{f:016x}", least[comp[f]]) for d, f in fp.items()}


def test_near_duplicates_edge_rows(spark):
    texts = [None, "", " \n", "one two", "one two", "One TWO", "something else entirely here now"]
    ids = [5, 4, 9, 3, 3, None, 8]
    docs = table(spark, texts, ids).withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    got = simhash.near_duplicates(docs)
    assert sorted(((r["doc_id"], r["component_id"]) for r in got.collect()), key=str) == sorted([(5, 4), (4, 4), (9, 4), (3, 3), (3, 3), (None, 3), (8, 8)], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 8]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    only_null = simhash.near_duplicates(table(spark, ["a b c", "a b c"], [None, None]))
    assert [r["component_id"] for r in only_null.collect()] == [None, None]
    with pytest.raises(ValueError):
        simhash.near_duplicates(docs, bits=4)


def test_connected_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)]
    root = {v: v for e in edges for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            if root[a] != m or root[b] != m:
                root[a] = root[b] = m
                changed = True
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["a"]: r["b"] for r in connected_components(df, Scratch(spark, "t"), "e").collect()}
    assert {v: got.get(v, v) for v in root} == root
