"""Token counts: a broadcast table of frequent pre-token lengths, misses encoded once per worker.

A text's number of tokens is the sum over its pre-tokens of what the vocabulary's BPE makes of each. Pre-tokens
are counted where they are read and never shuffled:

* the first tier is a table of the corpus's most frequent words with their lengths. A mergeable frequent-items
  sketch runs over all texts (map-side, a sketch per task, merged in two levels), the driver encodes the
  ``table_words`` items it names, and the table, of that many entries at most, is broadcast;
* the second tier is each worker's own cache: a pre-token outside the table is encoded by the library once and kept
  until ``cache_words`` are, when the worker starts again from the table.

Both tiers hold exact strings, so neither changes a count. Texts of Latin characters are lower-cased and cut in
Python; in other texts, and where special strings stand, the library's own normaliser and pre-tokeniser do it (tests
hold both against the library's whole encoding).

Defined results: a null or empty text has no byte and no token; rows that repeat a doc_id are counted each; a null
doc_id stays; special strings in a text are one token each, the library's default; a very long text is counted whole,
in slices that end before a blank; ties between equally frequent words touch only speed; an empty table gives an empty
result (and an empty first tier); only doc_id and text are read, other columns cannot clash.
"""

from __future__ import annotations

import os
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macropanel.llm.common import whole
from macropanel.llm.tokens import PLAIN_BELOW, vocab_path

VOCAB = "word_bpe_49k.json"
LIMIT = 2048
TABLE_WORDS = 20_000
#: Items that a sketch follows, and sketches that the first level of merging makes.
TRACKED, MERGED = 100_000, 256
CACHE_WORDS = 500_000
#: Longer pre-tokens are encoded but not kept.
CACHE_CHARS = 64
STEP_CHARS = 1_000_000

#: Blanks below PLAIN_BELOW, as the vocabulary's pre-tokeniser has them (Python's own class has four more).
BLANKS = r"\x09-\x0D\x20\x85\xA0"


def _plain(kind: str) -> str:
    """The characters below PLAIN_BELOW of one Unicode category, for a character class."""
    return re.escape("".join(c for c in map(chr, range(PLAIN_BELOW)) if unicodedata.category(c)[0] == kind))


class Lengths(dict):
    """Pre-token -> its number of tokens: the broadcast table, and behind it what this worker has met."""

    def __init__(self, table: dict[str, int], vocab_dir: str | None = None, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        super().__init__(table)
        self.table, self.most, self.encoded = table, len(table) + cache_words, 0
        self.tokenizer = Tokenizer.from_file(vocab_path(VOCAB, vocab_dir))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        letters, digits = _plain("L"), _plain("N")
        self.words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{BLANKS}{letters}{digits}]+").findall
        self.other = re.compile(f"[^\x00-{chr(PLAIN_BELOW - 1)}]").search
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))))

    def encode(self, word: str) -> int:
        """Tokens of one pre-token, by the library's model (its pre-tokeniser spells the bytes)."""
        self.encoded += 1
        return sum(len(self.tokenizer.model.tokenize(piece)) for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(word))

    def __missing__(self, word: str) -> int:
        n = self.encode(word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= self.most:
                self.clear()
                self.update(self.table)
            self[word] = n
        return n

    def count(self, text: str) -> int:
        return sum(self._slice(part) for part in slices(text))

    def _slice(self, text: str) -> int:
        get = self.__getitem__
        if not self.other(text) and not self.special.search(text):
            return sum(map(get, self.words(text.lower())))
        total = 0
        for k, part in enumerate(self.special.split(text)):
            total += k > 0  # the special string before this part
            plain = self.tokenizer.normalizer.normalize_str(part)
            total += sum(get(plain[a:b]) for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain))
        return total


def slices(text: str, step: int = STEP_CHARS) -> list[str]:
    """The text in pieces of about ``step`` characters that end before a blank (no pre-token spans one)."""
    if len(text) <= step:
        return [text]
    out, a = [], 0
    while a < len(text):
        cut = re.compile("[ \n]").search(text, a + step)
        b = cut.start() if cut else len(text)
        out.append(text[a:b])
        a = b
    return out


def frequent_words(docs: DataFrame, table_words: int = TABLE_WORDS, tracked: int = TRACKED, merged: int = MERGED) -> DataFrame:
    """word, count: about the most frequent runs of letters of all texts, by a sketch that is merged in two levels."""
    words = docs.select(F.explode(F.split(F.lower(whole()), r"[^\p{L}]+")).alias("word")).where("word != ''")
    sketches = words.groupBy((F.spark_partition_id() % merged).alias("g")).agg(F.expr(f"approx_top_k_accumulate(word, {tracked})").alias("sketch"))
    top = sketches.groupBy(F.col("g") < 0).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")).select(F.expr(f"approx_top_k_estimate(sketch, {table_words})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("word"), F.col("t.count").alias("count"))


def length_table(words: list[str], vocab_dir: str | None = None) -> dict[str, int]:
    """The first tier: those of the words that are one pre-token, with their lengths."""
    lengths = Lengths({}, vocab_dir)
    return {w: lengths.encode(w) for w in words if lengths.words(w.lower()) == [w]}


def token_counts(docs: DataFrame, table_words: int = TABLE_WORDS, cache_words: int = CACHE_WORDS, vocab_dir: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens: a row per document."""
    spark = docs.sparkSession
    # at most table_words rows come to the driver
    table = length_table([r.word for r in frequent_words(docs, table_words).toLocalIterator()], vocab_dir) if table_words else {}
    words, lengths = "\n".join(table), bytes(min(n, 255) for n in table.values())
    shared = spark.sparkContext.broadcast((words, lengths))

    def kernel(batches):
        words, lengths = shared.value
        known = Lengths({w: n for w, n in zip(words.split("\n"), lengths, strict=False) if n < 255}, vocab_dir, cache_words)
        for batch in batches:
            texts = batch.column(2)
            counts = [known.count(texts[i].as_py()) for i in range(batch.num_rows)]  # one text at a time becomes a Python string
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(whole()).cast("long").alias("n_bytes"), whole().alias("text"))
    return rows.mapInArrow(kernel, "doc_id long, n_bytes long, n_tokens long")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: bytes and tokens of every document, and whether they are more than 2048."""
    counts = token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
