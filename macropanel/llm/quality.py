"""Quality rules: tokeniser fertility of public vocabularies, with rejection bands per language or script.

Every distinct word of an Arrow batch is encoded once by each vocabulary (a word is encoded on its own, with
the space before it). A document's measures are, per vocabulary, characters per token and the entropy of its
tokens in bits, and the byte-fallback share: tokens that stand for single bytes of characters that the
vocabulary lacks (piece_bpe_32k) or that end inside a character (byte_bpe_50k). A document is rejected if a
measure lies outside the band of its language, or, where the language has none, of its script.

The outer bands are parameters, wide enough for any ordinary text of the language. Inside them each vocabulary has a
lower limit of its own per language, from the table itself: characters per token may lie ``TIMES`` upper quartiles of
the language's shortfalls below its median (less in long texts, which vary less), entropy as far below the median of
the language's texts of like length. The statistics are exact percentiles of measures rounded to three places over
the distinct measures of documents that the base rules keep, so copies count once and labels have no part in it.
A language of under ``MIN_DOCS`` such documents, and entropy in a length class of under ``MIN_CLASS``, has the outer
band only. A document's verdict therefore depends on the table it stands in.

Defined results: null and empty texts have no words: all measures are 0 and base_failed holds (fewer than 50
words); a null or unknown language takes the band of the script of most of the text's letters; repeated rows
are judged alike; a value that equals a limit is inside it; a very long text is measured whole, one at a time; an empty table gives an empty result; other columns pass through ``passing`` as they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macropanel.llm.common import Scratch, as_row, chunks
from macropanel.llm.tokens import byte_bpe, vocab_path

#: Bands (least, most) by language or script: characters per token, byte-fallback share, token entropy in bits.
#: The entropy band holds for texts of at least MIN_TOKENS tokens. Each lies clear of every document that is
#: labelled good in the given tables (lowest there: 1.82 en, 1.82 de, 1.62 es, 1.61 fr; entropy 5.48).
MIN_TOKENS = 128
BANDS = {
    "en": {"chars_per_token": (1.75, 8.0), "byte_share": (0.0, 0.20), "entropy": (5.2, 14.0)},
    "de": {"chars_per_token": (1.75, 8.0), "byte_share": (0.0, 0.20), "entropy": (5.2, 14.0)},
    "es": {"chars_per_token": (1.50, 8.0), "byte_share": (0.0, 0.20), "entropy": (5.2, 14.0)},
    "fr": {"chars_per_token": (1.50, 8.0), "byte_share": (0.0, 0.20), "entropy": (5.2, 14.0)},
    "latin": {"chars_per_token": (1.30, 8.0), "byte_share": (0.0, 0.20), "entropy": (4.5, 14.0)},
    "cyrillic": {"chars_per_token": (0.5, 8.0), "byte_share": (0.0, 0.60), "entropy": (4.5, 14.0)},
    "cjk": {"chars_per_token": (0.25, 4.0), "byte_share": (0.0, 0.90), "entropy": (4.5, 14.0)},
    "other": {"chars_per_token": (0.15, 8.0), "byte_share": (0.0, 1.00), "entropy": (4.5, 14.0)},
}
#: The limits from the table: shortfalls allowed, and the least shortfall that is one (a share of the median, bits).
TIMES = 8.0
LEAST_SHARE, LEAST_BITS = 0.05, 0.25
#: Least documents of a language and of a length class (half a doubling of tokens); tokens over which a text varies no less.
MIN_DOCS, MIN_CLASS, LONG = 100, 20, 1024
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Bytes of text that the kernel takes out of Arrow at a time.
STEP_BYTES = 1_500_000
SYMBOLS = b"#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"

VOCABS = ("", "byte_bpe_")

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FERTILITY = ["chars_per_token", "byte_share", "entropy", "byte_bpe_chars_per_token", "byte_bpe_byte_share", "byte_bpe_entropy"]
SCHEMA = ", ".join(["doc_id long", *[f"{c} long" for c in MEASURES], *[f"{c} double" for c in FERTILITY], "n_tokens long", "band string"])


def script_of(text: str) -> str:
    """The script of most of the text's letters."""
    at = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    upper, lower = ((at >= 65) & (at <= 90)), ((at >= 97) & (at <= 122))
    n = {
        "latin": int((upper | lower | ((at >= 0xC0) & (at < 0x250))).sum()),
        "cyrillic": int(((at >= 0x400) & (at < 0x530)).sum()),
        "cjk": int((((at >= 0x3040) & (at < 0xA000)) | ((at >= 0xAC00) & (at < 0xD7B0))).sum()),
    }
    n["other"] = int((at >= 0x250).sum()) - n["cyrillic"] - n["cjk"]
    return max(n, key=n.get)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + lengths[i] - 1, one after another."""
    total = int(lengths.sum())
    return np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(total)


def _repeat_words(codes: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per document, the words that lie in a 3-word window found at least twice in it."""
    doc = np.repeat(np.arange(len(n)), n)
    k = int(codes.max()) + 1 if len(codes) else 1
    inside = np.flatnonzero(doc[:-2] == doc[2:]) if len(codes) > 2 else np.zeros(0, np.int64)
    pair = pd.factorize(codes[inside] * k + codes[inside + 1])[0]
    triple = pd.factorize(pair * k + codes[inside + 2])[0]
    own = pd.factorize(triple * len(n) + doc[inside])[0]
    twice = inside[np.bincount(own)[own] > 1] if len(own) else inside
    hit = np.zeros(len(codes), bool)
    for j in range(3):
        hit[twice + j] = True
    return np.bincount(doc[hit], minlength=len(n)) if len(codes) else np.zeros(len(n), np.int64)


class Vocabulary:
    """Ids of distinct words, end to end, and for each id whether it stands for bytes rather than characters."""

    def __init__(self, encode, byte_ids: np.ndarray):
        self.encode, self.is_byte = encode, byte_ids

    def measure(self, words: list[str], codes: np.ndarray, n: np.ndarray, word_chars: np.ndarray) -> tuple[np.ndarray, ...]:
        each = self.encode(words)
        lengths = np.fromiter(map(len, each), np.int64, len(each))
        flat = np.fromiter((i for ids in each for i in ids), np.int64, int(lengths.sum()))
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(each) else lengths
        tokens = flat[_ragged(starts[codes], lengths[codes])]
        per_word = lengths[codes]
        doc = np.repeat(np.repeat(np.arange(len(n)), n), per_word)
        total = np.bincount(doc, minlength=len(n))
        some = np.maximum(total, 1)
        byte = np.bincount(doc[self.is_byte[tokens]], minlength=len(n)) / some
        seen, first = pd.factorize(doc * len(self.is_byte) + tokens)
        count = np.bincount(seen) if len(seen) else np.zeros(0)
        owner = (first // len(self.is_byte)).astype(np.int64)
        p = count / some[owner]
        entropy = np.bincount(owner, weights=-p * np.log2(p), minlength=len(n)) if len(seen) else np.zeros(len(n))
        return np.where(total > 0, word_chars / some, 0.0), byte, entropy + 0.0, total


def vocabularies(vocab_dir: str | None) -> list[Vocabulary]:
    import sentencepiece

    piece = sentencepiece.SentencePieceProcessor(model_file=vocab_path("piece_bpe_32k.model", vocab_dir))
    bpe = byte_bpe(vocab_dir)
    split = np.zeros(bpe.n_vocab, bool)
    for token in bpe.token_byte_values():
        try:
            token.decode()
        except UnicodeDecodeError:
            split[bpe.encode_single_token(token)] = True
    is_byte = np.array([piece.is_byte(i) for i in range(piece.get_piece_size())])
    return [
        Vocabulary(lambda words: piece.encode(words, num_threads=1), is_byte),
        Vocabulary(lambda words: [bpe.encode_ordinary(" " + w) for w in words], split),
    ]


def _measure(texts: list[str], langs: list[str | None], vocabs: list[Vocabulary], bands: dict) -> dict[str, list]:
    raw = [t.encode() for t in texts]
    split = [b.split() for b in raw]
    n = np.fromiter(map(len, split), np.int64, len(split))
    codes, distinct = pd.factorize(np.array([w for s in split for w in s], dtype=object)) if n.sum() else (np.zeros(0, np.int64), [])
    words = [w.decode() for w in distinct]
    codes = codes.astype(np.int64)
    chars = np.fromiter(map(len, words), np.int64, len(words))
    doc = np.repeat(np.arange(len(n)), n)
    word_chars = np.bincount(doc, weights=chars[codes], minlength=len(n)).astype(np.int64) if len(codes) else np.zeros(len(n), np.int64)
    first = np.concatenate(([0], np.cumsum(n)[:-1]))
    out = {
        "n_words": n,
        "word_chars": word_chars,
        "n_symbols": [len(b) - len(b.translate(None, SYMBOLS)) for b in raw],
        "n_dup_lines": [duplicate_lines(t) for t in texts],
        "n_repeat_words": _repeat_words(codes, first, n),
    }
    total = None
    for prefix, v in zip(("", "byte_bpe_"), vocabs, strict=True):
        a, b, c, tokens = v.measure(words, codes, n, word_chars)
        out |= {f"{prefix}chars_per_token": a, f"{prefix}byte_share": b, f"{prefix}entropy": c}
        total = tokens if total is None else total
    band = [lang if lang in bands else script_of(t) for lang, t in zip(langs, texts, strict=True)]
    return out | {"n_tokens": total, "band": band}


def measures(docs: DataFrame, bands: dict = BANDS, vocab_dir: str | None = None, keep: bool = False) -> DataFrame:
    """doc_id, the counts, the fertility measures and the name of the band: a row per row (``keep``: with it as ``row``)."""

    def kernel(batches):
        vocabs = vocabularies(vocab_dir)
        for batch in batches:
            text, lang = batch.column(1), batch.column(2)
            for a, b in chunks(pc.fill_null(pc.binary_length(text), 0).to_pylist(), STEP_BYTES):
                m = _measure([t or "" for t in text[a:b].to_pylist()], lang[a:b].to_pylist(), vocabs, bands)
                cols = [batch.column(0)[a:b]] + [pa.array(np.asarray(m[c], np.int64)) for c in MEASURES] + [pa.array(np.asarray(m[c], np.float64)) for c in FERTILITY]
                cols += [pa.array(np.asarray(m["n_tokens"], np.int64)), pa.array(m["band"], pa.string())]
                names = ["doc_id", *MEASURES, *FERTILITY, "n_tokens", "band"]
                if keep:
                    cols, names = [*cols, batch.column(3)[a:b]], [*names, "row"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    row = [as_row(docs)] if keep else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), lang.alias("lang"), *row)
    schema = T._parse_datatype_string(SCHEMA)
    return rows.mapInArrow(kernel, schema.add(rows.schema["row"]) if keep else schema)


def _length_class() -> Column:
    return F.floor(2 * F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int")


def _weight() -> Column:
    """How much less than one of MIN_TOKENS a text of so many tokens varies."""
    return F.sqrt(F.least(F.greatest(F.col("n_tokens"), F.lit(1)), F.lit(LONG)) / MIN_TOKENS)


def _lookup(entries: dict, key: Column) -> Column:
    """The arrays of numbers, by key; null where there is none."""
    if not entries:
        return F.lit(None).cast("array<double>")
    return F.try_element_at(F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), F.array(*[F.lit(n).cast("double") for n in v]))]), key)


def own_limits(m: DataFrame, scratch: Scratch) -> list[Column]:
    """The least characters per token and entropy of either vocabulary, from the measures ``m`` (with base_failed); null: none.

    The driver gets a row per language and a row per language and length class.
    """
    chars, bits = [f"{v}chars_per_token" for v in VOCABS], [f"{v}entropy" for v in VOCABS]
    once = scratch.save(m.where(~F.col("base_failed")).select("band", "n_tokens", *chars, *bits).distinct(), "distinct")
    middle = lambda c, at=0.5: F.percentile(F.round(c, 3), at)
    per_band = once.groupBy("band").agg(F.count("*").alias("n"), *[middle(c).alias(c) for c in chars]).where(F.col("n") >= MIN_DOCS).collect()
    per_class = once.groupBy("band", _length_class().alias("cls")).agg(F.count("*").alias("n"), *[middle(c).alias(c) for c in bits]).where(F.col("n") >= MIN_CLASS).collect()
    known = {r["band"] for r in per_band}
    usual = _lookup({r["band"]: [r[c] for c in chars] for r in per_band}, F.col("band"))
    alike = _lookup({f"{r['band']} {r['cls']}": [r[c] for c in bits] for r in per_class if r["band"] in known}, F.concat_ws(" ", "band", _length_class()))
    levels = [F.get(x, F.lit(k)) for x in (usual, alike) for k in range(len(VOCABS))]
    weights = [_weight()] * len(VOCABS) + [F.lit(1.0)] * len(VOCABS)
    short = [middle((level - F.col(c)) * w, 0.75).alias(c) for c, level, w in zip(chars + bits, levels, weights, strict=True)]
    spread = _lookup({r["band"]: [r[c] for c in chars + bits] for r in once.where(F.col("band").isin(*known)).groupBy("band").agg(*short).collect()} if known else {}, F.col("band"))
    scratch.drop("distinct")
    least = [LEAST_SHARE * level for level in levels[: len(VOCABS)]] + [F.lit(LEAST_BITS)] * len(VOCABS)
    return [level - F.greatest(TIMES * F.get(spread, F.lit(k)) / w, lo) for k, (level, w, lo) in enumerate(zip(levels, weights, least, strict=True))]


def judged(docs: DataFrame, bands: dict = BANDS, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, vocab_dir: str | None = None, keep: bool = False) -> DataFrame:
    """The measures with base_failed, reject (the first measure outside its band, else null) and kept."""
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    scratch = Scratch(docs.sparkSession, "quality")
    m = scratch.save(measures(docs, bands, vocab_dir, keep).withColumn("base_failed", base), "measures")  # measured once, read by the statistics too
    own = own_limits(m, scratch)
    limits = F.create_map(*[x for name, b in bands.items() for x in (F.lit(name), F.array(*[F.lit(float(v)) for c in ("chars_per_token", "byte_share", "entropy") for v in b[c]]))])
    limit = F.element_at(limits, F.col("band"))
    reject = F.lit(None).cast("string")
    for k, c in reversed(list(enumerate(("chars_per_token", "byte_share", "entropy")))):
        vocab = [c] if c == "byte_share" else [f"{v}{c}" for v in VOCABS]  # a byte-level vocabulary has no fallback to speak of
        out = F.lit(False)
        for i, v in enumerate(vocab):
            out = out | (F.col(v) < F.get(limit, F.lit(2 * k))) | (F.col(v) > F.get(limit, F.lit(2 * k + 1)))
            if c != "byte_share":
                out = out | F.coalesce(F.col(v) < own[k + i], F.lit(False))  # k: 0 for characters, 2 for entropy
        if c == "entropy":
            out = out & (F.col("n_tokens") >= MIN_TOKENS)
        reject = F.when(out, F.lit(c)).otherwise(reject)
    return m.withColumn("reject", reject).withColumn("kept", ~F.col("base_failed") & F.col("reject").isNull())


def passing(docs: DataFrame, **params) -> DataFrame:
    """The documents that the rules keep, with the columns they came with."""
    return judged(docs, keep=True, **params).where("kept").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: the base counts, the fertility measures and the verdict of every document."""
    j = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return j.select("doc_id", *MEASURES, "base_failed", "kept", *FERTILITY, "n_tokens", "band", "reject")
