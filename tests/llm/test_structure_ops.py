"""Conversation repair, token counts and periodic runs against brute force and against the library."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from macropanel.llm import conversations, runs, token_counts

SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def spread(spark):
    """Many small partitions, as on a cluster."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


# --- conversations ---------------------------------------------------------------------------------------------


def cheapest(symbols: str) -> tuple[int, str]:
    """Least (cost, letters) over all edits, by dynamic programming on whole strings."""
    legal_next = {"u": (1, 0), "a": (2, 1)}  # state 0: nothing, 1: after u, 2: after a, 3: after s
    done = [None] * (len(symbols) + 1)
    for i in range(len(symbols), -1, -1):
        best = {s: (0, "") if i == len(symbols) and s in (0, 2) else (10**9, "") for s in range(4)}
        for s in range(4):
            if i < len(symbols):
                c = symbols[i]
                nxt = done[i + 1]
                options = [(nxt[s][0] + 3, "D" + nxt[s][1])]
                if c not in "0123":
                    cut, role = c.isupper(), c.lower()
                    keep = {"s": 3 if s == 0 else None, "u": 1 if s != 1 else None, "a": 2 if s == 1 else None, "o": None}[role]
                    if keep is not None:
                        options.append((nxt[keep][0] + cut, "K" + nxt[keep][1]))
                    to = legal_next["a"][0] if s == 1 else legal_next["u"][0]
                    options.append((nxt[to][0] + 2 + cut, "R" + nxt[to][1]))
                best[s] = min([best[s], *options])
        for _ in range(3):
            for s in range(4):
                to = 2 if s == 1 else 1
                best[s] = min(best[s], (best[to][0] + 2, "I" + best[to][1]))
        done[i] = best
    return done[0][0]


def test_block_tables_against_whole_strings():
    rng = random.Random(4)
    solver = conversations.Solver()
    assert len(solver.vectors) < 100
    for _ in range(3000):
        alphabet = rng.choice(["suaoSUAO0123", "uauaua", "ua0", "sua", "uaUA", "oO1ua", "s0S"])
        symbols = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 23)))
        assert solver.solve(symbols) == cheapest(symbols)


def test_pieces_put_together_like_the_whole():
    """Cost matrices of any cuts have the whole's cost."""
    rng = random.Random(7)
    solver = conversations.Solver()
    for _ in range(300):
        symbols = "".join(rng.choice("suaoSUAO0123") for _ in range(rng.randint(2, 40)))
        cut = rng.randint(1, len(symbols) - 1)
        costs = list(conversations.FIRST)
        for part in (symbols[:cut], symbols[cut:]):
            m = solver.matrix(part)
            costs = [min(costs[s] + m[4 * s + t] for s in range(4)) for t in range(4)]
            closed, low = conversations.closed(costs)
            costs = [x + low for x in closed]
        assert conversations.last_states(costs)[0] == cheapest(symbols)[0]


def conversations_by_hand(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kept = held[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            new = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [((turn is not None, turn or 0, role, text, k), turn, "user" if kind == 4 else role, new) for k in range(1 + (kind == 3))]
    out = {}
    for conv, kept in held.items():
        kept.sort(key=lambda r: r[0])
        seen, symbols, faults = set(), "", [0, 0, 0]
        for _, _, role, text in kept:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            core = text.strip(" \t\n\x0b\f\r")
            fault = 0 if not core else 1 if (role, text) in seen else 2 if core[-1] not in ".!?" else None
            if fault is not None:
                faults[fault] += 1
            symbols += "0123"["suao".index(initial)] if fault in (0, 1) else initial.upper() if fault == 2 else initial
            seen.add((role, text))
        turns = [r[1] for r in kept if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(kept, kept[1:], strict=False)]
        cost, audit = cheapest(symbols)
        lines, last, at = [], "", 0
        for letter in audit:
            role, text = (kept[at][2], kept[at][3]) if letter != "I" else ("", "")
            at += letter != "I"
            if letter in "RI":
                role = "assistant" if last == "u" else "user"
            if letter != "D":
                lines.append(f"{role}:{text}")
                last = role[0]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *faults, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


def test_conversations_query_against_brute_force(spark):
    got = {r.conv_id: tuple(r)[1:] for r in conversations.query(spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert got == conversations_by_hand([tuple(r) for r in rows])


def test_conversations_over_many_partitions_and_odd_rows(spark, spread, tmp_path):
    """Long conversations lie in many pieces; null ids, turns, roles and texts; repeated rows; clashing names; ids beyond 2**53."""
    rng = random.Random(5)
    rows = []
    for conv in (None, 1, 2, 2**60, 7):
        for t in range(300 if conv in (None, 2**60) else 3):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "x", "", None])
            rows.append((conv, rng.choice([t, t, t, None]), role, rng.choice(["Hi.", "a", "", ". ", None, f"q{t}!", f"w{t}", f"z{t}.", f"y{t}."])))
    rows += [rows[5], rows[5], (9, 1, "user", "word " * 40_000 + "."), (9, 2, "assistant", "Ja.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("at", "piece", "fault", "n", "o0", "symbols"):
        table = table.withColumn(name, F.lit("x"))
    table.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in conversations.query(spark, str(tmp_path)).collect()}
    assert got == conversations_by_hand(rows)


def test_repaired_rows_are_legal_and_hash_alike(spark, spread):
    rows = conversations.damage(spark.read.parquet(f"{SMALL}/conversations.parquet"))
    repair = conversations.Repair(rows, ("o_role", "o_text", "copy"))
    by = defaultdict(list)
    for r in sorted(repair.repaired().collect(), key=lambda r: (r.conv_id, r.piece, r.at)):
        by[r.conv_id].append(r)
    digests = {r.conv_id: r.repaired_sha256 for r in repair.digests().collect()}
    for conv, lines in by.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in lines))
        assert digests[conv] == hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in lines).encode()).hexdigest()


def test_conversations_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert conversations.query(spark, str(tmp_path)).collect() == []


# --- token counts ----------------------------------------------------------------------------------------------


def whole_count(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_lengths_by_character_like_the_library():
    """Every character that the short way takes, alone and among others, and a spread of the rest."""
    lengths = token_counts.Lengths({})
    for c in [*range(0x300), *range(0x300, 0x3000, 7), *range(0x3000, 0xD800, 97), *range(0xE000, 0x110000, 997)]:
        for text in (chr(c), f"a{chr(c)}b", f"'{chr(c)} .{chr(c)}1"):
            assert lengths.count(text) == whole_count(lengths.tokenizer, text), hex(c)


def test_lengths_of_random_texts_like_the_library():
    rng = random.Random(2)
    lengths = token_counts.Lengths({"stred": 2}, cache_words=50)
    parts = [*"abcDEF'stredvml .,!?\n\t12éÀßİıſ́̇中文Жд\x1c\x85 ", "<|endoftext|>", "<|startoftext|>", "<|", "'s", "'LL", "   "]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert lengths.count(text) == whole_count(lengths.tokenizer, text)
        assert len(lengths) <= 51


def test_long_texts_in_slices():
    text = "Word 'tis <|endoftext|> étude 12\n" * 300 + "x" * 500
    assert "".join(token_counts.slices(text, 100)) == text
    assert len(token_counts.slices(text, 100)) > 50
    lengths = token_counts.Lengths({})
    assert sum(map(lengths.count, token_counts.slices(text, 100))) == whole_count(lengths.tokenizer, text)


def test_token_counts_query_against_the_library(spark):
    got = token_counts.query(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    tokenizer = token_counts.Lengths({}).tokenizer
    assert len(got) == len(texts)
    for r in got:
        n = whole_count(tokenizer, texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 2048)


def test_token_counts_edge_rows(spark):
    long = "Lorem ipsum 12 " * 90_000
    rows = [(1, None), (1, ""), (None, "One two."), (2, "One two."), (2, "One two."), (3, long), (4, "<|endoftext|>中文 и")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_bytes", F.lit(-1)).withColumn("word", F.lit("x"))
    tokenizer = token_counts.Lengths({}).tokenizer
    want = sorted((i is None, i or 0, len((t or "").encode()), whole_count(tokenizer, t)) for i, t in rows)
    for table_words in (0, 3, 20_000):
        got = token_counts.token_counts(docs, table_words).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.token_counts(docs.limit(0)).collect() == []


def test_frequent_words_are_the_corpus_ones(spark):
    docs = spark.createDataFrame([(k, "often often rare" + str(k % 3) + f" often und und w{k}") for k in range(200)], "doc_id long, text string").repartition(6)
    top = [(r.word, r["count"]) for r in token_counts.frequent_words(docs, 2).collect()]
    assert top == [("often", 600), ("und", 400)]


# --- runs ------------------------------------------------------------------------------------------------------


def runs_by_hand(words, min_length=24, exponent=3):
    out, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, exponent * q):
                part = words[i : j + q]
                if all(any(part[k] != part[k + d] for k in range(len(part) - d)) for d in range(1, q)):
                    out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        n = rng.randint(0, 90)
        words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 5, 40])) for _ in range(n)]
        if n and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        least, exponent = rng.choice([(24, 3), (4, 2), (6, 3), (7, 2), (5, 4), (2, 2)])
        assert [tuple(map(int, r)) for r in runs.find_runs(words, least, exponent)] == runs_by_hand(words, least, exponent)


def test_common_extensions_against_words():
    rng = random.Random(3)
    s = [rng.randint(1, 3) for _ in range(200)]
    tree = runs.SuffixTree(s, 3)
    i, j = runs.np.array([(a, b) for a in range(200) for b in range(200) if a != b]).T
    got = tree.lce(i, j)
    for a, b, n in zip(i.tolist(), j.tolist(), got.tolist(), strict=True):
        assert s[a : a + n] == s[b : b + n] and (max(a, b) + n == 200 or s[a + n] != s[b + n])
    assert sorted(range(201), key=lambda k: [*s[k:], 0]) == sorted(range(201), key=lambda k: tree.rank[k])
    back = tree.rank_reversed()
    assert sorted(range(201), key=lambda k: [*(-x for x in s[k:]), -9]) == sorted(range(201), key=lambda k: back[k])


def digests_by_hand(doc, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = runs_by_hand(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = runs.query(spark, SMALL).collect()
    assert len(got) == len(texts)
    some = 0
    for r in got:
        if len((texts[r.doc_id] or "").split()) < 1500:
            assert tuple(r)[1:] == digests_by_hand(r.doc_id, texts[r.doc_id])
            some += r.n_runs > 0
    assert some


def test_runs_edge_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "a b c " * 20), (4, "x " * 24), (4, "x " * 24), (5, "x " * 23), (6, "é中 " * 30), (7, "a b " * 30)]
    rows += [(k, "so it goes on " * 9 + "end") for k in range(8, 30)]  # some of them planted
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("a", F.lit(2)).withColumn("w", F.lit("w"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = runs.query(spark, str(tmp_path)).collect()
    null_last = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    assert sorted(map(tuple, got), key=null_last) == sorted([(i, *digests_by_hand(i, t)) for i, t in rows], key=null_last)
    found = runs.periodic_runs(docs.where("doc_id = 4")).collect()
    assert [(r.n_words, r.collapsed, [tuple(x) for x in r.runs]) for r in found] == [(24, "x", [(0, 24, 1)])] * 2
    assert runs.periodic_runs(docs.limit(0)).collect() == []


def test_runs_of_a_very_long_text(spark):
    """A million words whose one repeated stretch is in the middle, and a long text that is all one run."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**7)}" for _ in range(300_000)]
    words[1000:1000] = ["tick", "tock", "tack"] * 50
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "ab cd " * 30_000)], "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in runs.periodic_runs(docs).collect()}
    assert got == {1: [(1000, 150, 3)], 2: [(0, 60_000, 2)]}
