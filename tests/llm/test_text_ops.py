"""License scan, quality rules, toxicity and PII against brute force and small fixtures."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from macropanel.llm import license_scan, pii, quality, toxicity

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


def table(spark, texts, ids=None, langs=None):
    ids, langs = ids or list(range(len(texts))), langs or ["en"] * len(texts)
    return spark.createDataFrame([(i, t, lang, "s") for i, t, lang in zip(ids, texts, langs, strict=True)], DOCS)


# license scan


def base_by_hand(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TRICKY = ["MIT-License mit\nlicense", "mit license mit license", "the Apache License", "ÉMIT license", "general public licenses", "(general) public, LICENSE!", None, "", "9 mit9 license", "x" * 200_000 + " mit license"]


def test_license_base_counts(spark):
    given_ = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts = TRICKY + given_
    rows = license_scan.scan_licenses(table(spark, texts)).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows}
    assert got == {i: base_by_hand(t) for i, t in enumerate(texts)}
    assert all(set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in rows)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_fuzzy_search_misses_no_notice_within_its_edits(data):
    scan = license_scan.Scanner(license_scan.NOTICES, license_scan.PHRASES, license_scan.CHARS_PER_EDIT)
    label, notice, k, _ = data.draw(st.sampled_from(scan.notices))
    text = list(notice)
    for _ in range(data.draw(st.integers(0, k))):
        at = data.draw(st.integers(0, len(text) - 1))
        kind, c = data.draw(st.sampled_from("ids")), data.draw(st.sampled_from("abz"))
        text[at : at + 1] = {"i": [text[at], c], "d": [], "s": [c]}[kind]
    edited = " ".join("".join(text).split())
    joined = " ".join(("lorem " * 5 + edited + " ipsum" * 3).split())
    if edit_distance(edited, notice) <= k:
        found = [s for s in scan.fuzzy(joined) if s[0] == label]
        assert found
    for _, a, b, edits, _ in scan.fuzzy(joined):
        assert 0 <= a < b <= len(joined) and edits >= 0


def test_fuzzy_spans_verify(spark):
    text = "Intro. Permision is hereby granted, free of charge, to any persn obtaining a copy. All rights reservd"
    r = license_scan.scan_licenses(table(spark, [text])).first()
    assert r["labels"] == "mit,proprietary" and r["base_labels"] == "" and 0.9 < r["score"] < 1
    for s in r["spans"]:
        best = min(edit_distance(s["matched"], n) for n in license_scan.NOTICES[s["label"]])
        assert best == s["edits"]
        words = text.lower().replace(",", "").replace(".", "").split()
        assert " ".join(words[s["start_word"] : s["end_word"]]).startswith(s["matched"][:8])


NAMED = {
    "Released under the BSD license": "bsd",
    "Released under the ISC license.": "isc",
    "Released under the GPL license": "gpl",
    "Released under the zlib license": "zlib",
    "Relased under the MIT licens": "mit",
    "Released under the FOO license": "",
    "Licensed under CC BY 4.0": "cc by",
    "Licensed under CC BY-SA 4.0": "cc by sa",
    "Licensed under CC BY-ND 4.0": "cc by nd",
    "Licensed under CC BY-NC-SA 4.0": "cc by nc sa",
    "Licensed under a Creative Commons Attribution license": "cc by",
    "Licenced under a Creative Commons Attribution-NonCommercial license": "cc by nc",
    "Licensed under a Creative Commons Attribution-ShareAlike license": "cc by sa",
    "This work is CC0 1.0 Universal": "cc0",
    "Mozilla Public License 2.0": "mpl",
    "Eclipse Public License - v 2.0": "epl",
    "GNU Affero General Public License v3": "agpl,gpl",  # gpl is the base phrase's
    "GNU Lesser General Public License v3": "gpl,lgpl",
    "small rights reserved": "",
    "all rights reservedly": "",
    "All rights reservd": "proprietary",
    "smalll rights reserved": "",
}


def test_naming_words_borders_and_longest_notice(spark):
    rows = license_scan.scan_licenses(table(spark, list(NAMED))).collect()
    assert {text: r["labels"] for text, r in zip(NAMED, sorted(rows, key=lambda r: r["doc_id"]), strict=True)} == NAMED
    for r in rows:
        places = sorted((s["start_word"], s["end_word"]) for s in r["spans"])
        assert all(b <= c for (_, b), (c, _) in zip(places, places[1:], strict=False))


def test_long_text_of_notices():
    """Word numbers of all spans in a text of 260,000 characters beyond ASCII: every notice, each at its own words."""
    scan = license_scan.Scanner(license_scan.NOTICES, license_scan.PHRASES, license_scan.CHARS_PER_EDIT)
    part = "Él: released under the MIT license. Permission is hereby granted, free of charge, to any persn obtaining a copy. All rights reserved! "
    one, many = scan(part), scan(part * 2000)
    assert [(s["start_word"], s["end_word"], s["edits"]) for s in one[7]] == [(1, 6, 0), (6, 19, 1), (19, 22, 0)]
    assert many[0] == 22 * 2000 and many[1] == 2000 and (many[2], many[3]) == (4, 22 * 1999 + 4)
    want = [(22 * k + a, 22 * k + b) for k in range(2000) for a, b in ((1, 6), (6, 19), (19, 22))]
    assert [(s["start_word"], s["end_word"]) for s in many[7]] == want


def test_license_edge_rows(spark):
    docs = table(spark, ["MIT License", "MIT License", None], [1, 1, None]).withColumn("labels", F.lit("x")).withColumn("n_words", F.lit("y"))
    rows = license_scan.scan_licenses(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["labels"], r["first_word"]) for r in rows[:2]) == [(1, 2, "mit", 0)] * 2
    assert tuple(rows[2])[:8] == (None, 0, 0, None, None, "", "", 0.0)
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0


# quality rules


def counts_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    w = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {i + j for i in range(len(words) - 2) if w[tuple(words[i : i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_quality_counts(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += [None, "", " \n ", "a a a a", "x y\x85z \x1c|", "l\nl\n\nl\n \n", "ab cd ef ab cd ef", "a b c", "#*$%&|<>", "é" * 30_000 + " b"]
    rows = quality.judged(table(spark, texts)).collect()
    got = {r["doc_id"]: tuple(r[c] for c in quality.MEASURES) for r in rows}
    want = {i: counts_by_hand(t) for i, t in enumerate(texts)}
    assert got == want
    for r in rows:
        n, _, _, _, repeat = want[r["doc_id"]]
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert not (r["kept"] and r["base_failed"])


def test_fertility_by_hand(spark):
    import sentencepiece

    texts = ["the cat sat on the mat", "naïve façade ☃ 漢字", "x"]
    sp = sentencepiece.SentencePieceProcessor(model_file=quality.vocab_path("piece_bpe_32k.model"))
    bpe = quality.byte_bpe()
    for r in quality.measures(table(spark, texts)).collect():
        words = texts[r["doc_id"]].split()
        for prefix, ids, byte in (("", [i for w in words for i in sp.encode(w)], sp.is_byte), ("byte_bpe_", [i for w in words for i in bpe.encode_ordinary(" " + w)], None)):
            p = np.array(list(Counter(ids).values())) / len(ids)
            assert r[f"{prefix}chars_per_token"] == pytest.approx(sum(map(len, words)) / len(ids))
            assert r[f"{prefix}entropy"] == pytest.approx(-(p * np.log2(p)).sum())
            if byte:
                assert r["byte_share"] == pytest.approx(sum(map(byte, ids)) / len(ids))


def test_bands_reject_and_keep(spark):
    nouns = "river town hill market winter garden letter window harbour teacher road bridge forest mill summer kitchen station".split()
    prose = " ".join(f"the {a} near our {b} was quiet" for a, b in zip(nouns, nouns[5:] + nouns[:5], strict=True))
    noise = " ".join(f"{i:03d}#%{(i * 7919) % 9973:05d}&*@!{i}" for i in range(120))
    docs = table(spark, [prose, noise, prose, None], langs=["en", "en", None, "xx"]).withColumn("band", F.lit("clash")).withColumn("n_words", F.lit(0))
    rows = {r["doc_id"]: r for r in quality.judged(docs).collect()}
    assert rows[0]["kept"] and rows[2]["kept"] and rows[2]["band"] == "latin"
    assert not rows[1]["kept"] and not rows[1]["base_failed"] and rows[1]["reject"] == "chars_per_token"
    kept = quality.passing(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2]
    assert quality.passing(docs.limit(0)).count() == 0


def test_quality_keeps_the_labelled_good(spark):
    """Of the documents labelled good, the method rejects none that the base rules keep."""
    j = quality.query(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1"), "doc_id")
    assert j.where("not base_failed and not kept").count() == 0


def test_quality_rejects_labelled_bad_and_keeps_labelled_good(spark):
    """Of the documents that the base rules keep: most of those labelled bad go, those labelled good stay (odd doc_ids; not held out, TIMES was chosen with sight of them)."""
    d = "/root/testdata/sf0.1"
    j = quality.query(spark, d).join(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality"), "doc_id").where("not base_failed and doc_id % 2 = 1")
    n = {r["quality"]: (r["n"], r["out"]) for r in j.groupBy("quality").agg(F.count("*").alias("n"), F.count_if(~F.col("kept")).alias("out")).collect()}
    assert n[0][1] >= 0.75 * n[0][0] and n[1][1] <= 0.002 * n[1][0]


def test_quality_limits_do_not_count_copies(spark):
    """One text a thousand times over moves no limit."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'")
    copy = docs.orderBy("doc_id").limit(1).crossJoin(spark.range(1000).select(F.col("id").alias("_i"))).withColumn("doc_id", F.lit(10**9) + F.col("_i")).drop("_i")
    a = {r["doc_id"]: r["kept"] for r in quality.judged(docs).collect()}
    b = {r["doc_id"]: r["kept"] for r in quality.judged(docs.unionByName(copy)).where("doc_id < 1000000000").collect()}
    assert a == b and not all(a.values())


@pytest.mark.parametrize(("text", "script"), [("hello", "latin"), ("привет мир", "cyrillic"), ("漢字かな", "cjk"), ("שלום", "other"), ("", "latin")])
def test_script_of(text, script):
    assert quality.script_of(text) == script


# toxicity


def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.train(docs, labels.where("doc_id % 3 != 0"))
    held = labels.where("doc_id % 3 = 0").select("doc_id", F.col("toxic").alias("truth"))
    got = toxicity.score(docs.join(held.select("doc_id"), "doc_id", "left_semi"), model).join(held, "doc_id").collect()
    hit = sum(r["toxic"] and r["truth"] == 1 for r in got)
    assert hit >= 0.85 * sum(r["truth"] == 1 for r in got)
    assert sum(r["toxic"] and r["truth"] == 0 for r in got) <= 0.005 * sum(r["truth"] == 0 for r in got)
    for r in got:
        p = [r[f"p_ge_{k}"] for k in (1, 2, 3)]
        assert p == sorted(p, reverse=True) and r["expected_severity"] == pytest.approx(sum(p)) and 0 <= r["severity"] <= 3


def test_cumulative_link_learns_an_order():
    rng = np.random.default_rng(0)
    bad, good = list(range(12)), list(range(12, 200))
    vocab, odds = [f"w{i}".encode() for i in range(200)], np.array([5.0] * 12 + [0.0] * 188)
    found, toxic = [], []
    for i in range(600):
        n = int(rng.integers(1, 10)) if i % 2 else 0
        found.append([*rng.choice(good, 30, replace=False).tolist(), *rng.choice(bad, n, replace=False).tolist()])
        toxic.append(i % 2)
    m = toxicity.fit(found, np.array(toxic), vocab, odds)
    assert (np.diff(m.cuts) > 0).all()
    e = [m.severity({vocab[j] for j in bad[:n]}).sum() for n in (0, 1, 4, 9)]
    assert e == sorted(e) and e[0] < 0.5 and e[-1] > 2


def test_vocabulary_counts_over_the_whole_sample(spark):
    rows = [(i, i % 2, [b"both", b"bad" if i % 2 else b"good", b"x%d" % i]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, toxic int, words array<binary>")
    got = dict(toxicity.vocabulary(df, 100, 100))
    assert set(got) == {b"bad", b"good"} and got[b"bad"] == pytest.approx(np.log(100.5 / 101) - np.log(0.5 / 101)) and got[b"good"] < 0


def test_toxicity_edge_rows(spark):
    docs = table(spark, ["fine words", None, ""], [1, 1, None]).withColumn("toxic", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, 1, None), (None, 1, 1), (1, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        rows = toxicity.score(docs, toxicity.train(docs, labels)).collect()
        assert [(r["expected_severity"], r["toxic"]) for r in rows] == [(0.0, False)] * 3
    assert toxicity.score(docs.limit(0), None).count() == 0


def test_fit_sample_is_bounded_and_repeats(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    a, b = (sorted(r["doc_id"] for r in toxicity.sample(docs, labels, 20).collect()) for _ in range(2))
    assert a == b and len(a) <= 20


# PII


def luhn_by_hand(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def spans_by_hand(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and luhn_by_hand(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


CARD = "4111 1111 1111 1111"
HARD = [
    None, "", "a@b.co_c@d.ef", "a@b@c.de x@y", "é" * 50 + " jo.e@exa-mple.co.uk…", "1.2.3.4.5.6.7.8 999.1.2.3.4 001.002.255.0 1.2.3.256",
    f"pay {CARD}, not {CARD[:-1]}2 or 4111-1111-1111-1111 0", "12345678901234567890123", "+1 (555) 010-9999 +12 +1........2 call+49 30 1234567.", "😀 +1 415 555 2671 😀 a@b.cd",
    "a" * 50_000, "1" * 50_000, "1 " * 20_000, "a.b" * 9_000 + "@x.y", "@" * 3000, "+1" + "-" * 5000,
]


def test_pii_base_spans_against_plain_patterns(spark):
    texts = HARD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    table(spark, texts).createOrReplaceTempView("pii_docs")
    got = pii.find_pii(spark.table("pii_docs")).collect()
    assert len(got) == len(texts)
    for r in got:
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == spans_by_hand(texts[r["doc_id"]]), texts[r["doc_id"]][:80]
        assert all(texts[r["doc_id"]][s["start"] : s["end"]] == s["value"] for s in [*r["base"], *r["found"]])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab@.%+- 019()é", max_size=40))
def test_safe_patterns_equal_the_plain_ones(text):
    """The rewritten expressions, as far as Python's re has the same syntax (no \\G: an email may follow an email at once)."""
    plain = {"ip": r"[0-9]+(?:\.[0-9]+){3}", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for kind, p in plain.items():
        assert [m.span() for m in re.finditer(pii.PATTERNS[kind], text)] == [m.span() for m in re.finditer(p, text)]


def test_bootstrap_finds_unseen_identifiers(spark):
    seen = [f"please write to user{i}@mail.example today" for i in range(6)]
    unseen = ["please write to HANDLE-77Q today", "nothing to see in 2024-05-17 here", "again HANDLE-77Q stands alone"]
    clean = ["the year 1999 was fine", "a version 10.2.33 of it"]
    texts = seen + unseen + clean
    found = {r["doc_id"]: [s["value"] for s in r["found"]] for r in pii.find_pii(table(spark, texts)).collect()}
    assert found[6] == ["HANDLE-77Q"] and found[8] == ["HANDLE-77Q"]
    assert not any(found[i] for i in (*range(6), 7, 9, 10))


def test_bootstrap_finds_secrets_and_what_stands_like_them(spark):
    """Hex after token = is a seed; a like shape after the same word, spaced groups and long values are candidates; other assignments stay."""
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(6)]
    texts = [f'set token = "{h}"{"###" if i == 5 else ""} now{i} x' for i, h in enumerate(hexes)] + [f"mail box {i} reference number user{i}@mail.example" for i in range(16)]
    long, spaced = "Zq7" * 40, "XK41 22B7 901C"
    texts += [f"reference number {long} then", f"reference number {spaced} then", f"copy {hexes[0]} stands alone"]
    texts += ['version = "10.2.33-beta" and', 'day = "2024-05-17" and', f'sha1 = "{hashlib.sha1(b"other").hexdigest()}" and', "the 1234567890123456 is no card"]
    found = {r["doc_id"]: [s["value"] for s in r["found"]] for r in pii.find_pii(table(spark, texts)).collect()}
    assert [found[i] for i in range(6)] == [[h] for h in hexes]
    assert found[22] == [long] and found[23] == [spaced] and found[24] == [hexes[0]]
    assert not any(found[i] for i in (*range(6, 22), *range(25, 29)))


def test_rounds_find_what_the_seeds_do_not_name(spark):
    """Held out: values in a context that no seed expression names, tied to a known one by three values; and values no seed shape fits.

    The seeds are the hex values after token; nothing after credential or bearer is one, nor is a value that is no hex.
    """
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(60)]
    mixed = [hashlib.sha256(str(i).encode()).hexdigest().upper()[:28] + f"Zq{i:02d}Xw" for i in range(12)]
    texts = [f'set token = "{h}" now{i}' for i, h in enumerate(hexes[:12])]
    shared = [f'with credential = "{h}" at{i}' for i, h in enumerate(hexes[:3])]
    hidden = [f'with credential = "{h}" in{i}' for i, h in enumerate(hexes[12:50])]
    odd = [f'set token = "{v}" then{i}' for i, v in enumerate(mixed)]
    beyond = [f'use bearer = "{h}" for{i}' for i, h in enumerate([*hexes[12:15], *hexes[50:]])]  # reached by way of credential only
    clean = [f'sha1 = "{hashlib.sha1(f"x{i}".encode()).hexdigest()}" of{i}' for i in range(30)]
    clean += [f'with version = "1.{i}.3-rc" by{i}' for i in range(10)] + [f'set day = "2024-05-{i:02d}" or{i}' for i in range(10, 20)]
    for part in (hidden, odd, beyond):
        assert not any(re.search(pii.SECRET, re.search('"(.*?)"', t)[1]) and re.search(pii.ASSIGNED, t[: t.index('"') + 1].lower()) for t in part)
    every = texts + shared + hidden + odd + beyond + clean
    found = {r["doc_id"]: [s["value"] for s in r["found"]] for r in pii.find_pii(table(spark, every)).collect()}
    got = [bool(found[i]) for i in range(len(every))]
    at = len(texts) + len(shared)
    for part in (hidden, odd, beyond):
        assert sum(got[at : at + len(part)]) >= 0.9 * len(part)
        at += len(part)
    assert not any(got[at:])


def test_values_known_to_be_none_count_against_a_pattern(spark):
    texts = [f"pay by card 4111 1111 1111 111{i} now" for i in range(10)] + [f"on the day 20{i:02d}-01-0{i % 9 + 1} mail at a{i}@b.cd" for i in range(10, 30)]
    texts += [f"on the day mail{i}@b.cd" for i in range(4)] + ["on the day KX-1234-99 we", "pay by card 4111111111111112 now"]
    found = {r["doc_id"]: [s["value"] for s in r["found"]] for r in pii.find_pii(table(spark, texts)).collect()}
    assert not any(found.values())


def test_pii_edge_rows_and_digest(spark):
    docs = table(spark, ["x a@b.cd", "x a@b.cd", None], [1, 1, None]).withColumn("base", F.lit(1)).withColumn("found", F.lit(2))
    rows = pii.find_pii(docs).collect()
    assert sorted(len(r["base"]) for r in rows) == [0, 1, 1] and not any(r["found"] for r in rows)
    assert pii.find_pii(docs.limit(0)).count() == 0
    q = {r["doc_id"]: r for r in pii.query(spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for d, r in q.items():
        s = ",".join(f"{k}:{a}:{b}" for k, a, b in spans_by_hand(texts[d]))
        assert r["base_sha256"] == hashlib.sha256(s.encode()).hexdigest() and r["spans"].startswith(s)


def test_native_operators_run_no_python(spark):
    from macropanel.llm import line_dedup

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (pii.extract(docs), line_dedup.dedup_lines(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
