"""Toxicity: cumulative-link ordinal regression over sparse word features, giving expected severity.

P(grade >= k) = sigmoid(w . x - c_k) for k = 1..3: one weight vector for all thresholds, ordered cut points.
x are the words and word beginnings of a text that are in the model's vocabulary (present or not), so a long text
is not diluted; the vocabulary holds what differs significantly between the classes.

The labels say toxic or not; the grades of the toxic are made from how many features of the text are telling of toxic
texts, cut at the thirds of the toxic sample; telling are those whose log odds between the two classes exceed
TELLING and are significant. The model is fitted on at most ``max_fit_rows`` labelled
documents (half of each class, those of the smallest hash); everything else covers all documents: each is scored.

Defined results: null and empty texts have no words and get the model's severity of an empty text, which is
not toxic; rows are scored one by one, so repeated rows repeat their result; a document with several labels is
toxic if one of them says so; null labels are no labels; without labels of both classes no document is toxic
(expected_severity 0); of grades with equal probability the lowest is the severity; a very long text is scored whole,
as the words that it has; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macropanel.llm.common import Scratch
from macropanel.llm.license_scan import TABLE

GRADES = 3
MAX_FIT_ROWS = 6000
#: Words of the vocabulary.
MAX_VOCABULARY = 20_000
MIN_TEXTS = 3
#: Share of the toxic sample in as many of whose texts, at least, a feature must stand in the sample.
MIN_SHARE = 0.02
#: Bytes of a word's beginning that are features too, so that compounds of a stem count together.
STEMS = (4, 5)
#: Likelihood ratio (G squared) of a feature against chance that puts it into the vocabulary.
SIGNIFICANT = 22.0
TELLING = 2.5
EPOCHS = 400
RATE = 0.1
L2 = 1e-5


def features(text: str | None) -> set[bytes]:
    """The distinct words of a text, and the beginnings of the longer ones (marked with *)."""
    words = set((text or "").encode().translate(TABLE).split())
    return words.union(*({w[:n] + b"*" for w in words if len(w) > n} for n in STEMS))


@dataclass
class Model:
    weights: dict[bytes, float]
    cuts: np.ndarray

    def severity(self, found: set[bytes]) -> np.ndarray:
        """P(grade >= k), k from 1."""
        score = sum(self.weights[w] for w in found if w in self.weights)
        return 1.0 / (1.0 + np.exp(np.clip(self.cuts - score, -50, 50)))


def grades(toxic: np.ndarray, telling: np.ndarray) -> np.ndarray:
    """0 for the clean, 1 to GRADES for the toxic by their number of telling features."""
    at = np.quantile(telling[toxic == 1], [k / GRADES for k in range(1, GRADES)])
    return np.where(toxic == 1, 1 + (telling[:, None] > at[None, :]).sum(axis=1), 0)


def fit(found: list[list[int]], toxic: np.ndarray, vocab: list[bytes], odds: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, l2: float = L2) -> Model:
    """Maximum likelihood by Adam on the binary splits y >= k, which share w; cut points stay in order.

    ``found``: per text the places of its features in ``vocab``; ``odds``: the features' log odds.
    """
    sizes = [len(f) for f in found]
    row, col = np.repeat(np.arange(len(found)), sizes), np.array([j for f in found for j in f], np.int64)
    y = grades(toxic, np.bincount(row, weights=odds[col] > TELLING, minlength=len(found)))
    target = (y[:, None] >= np.arange(1, GRADES + 1)[None, :]).astype(float)
    w, gap = np.zeros(len(vocab)), np.array([1.0] + [0.0] * (GRADES - 1))  # cuts = first, then steps of exp(gap)
    p, m, v = np.concatenate((w, gap)), 0.0, 0.0
    n = len(vocab)
    for t in range(1, epochs + 1):
        steps = np.exp(p[n + 1 :])
        cuts = p[n] + np.concatenate(([0.0], np.cumsum(steps)))
        z = np.bincount(row, weights=p[col], minlength=len(found))
        err = 1.0 / (1.0 + np.exp(np.clip(cuts[None, :] - z[:, None], -50, 50))) - target
        by_cut = -err.mean(axis=0)
        g = np.concatenate((np.bincount(col, weights=err.sum(axis=1)[row], minlength=n) / len(found) + l2 * p[:n], [by_cut.sum()], steps * np.cumsum(by_cut[::-1])[::-1][1:]))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    cuts = p[n] + np.concatenate(([0.0], np.cumsum(np.exp(p[n + 1 :]))))
    return Model({w: float(x) for w, x in zip(vocab, p[:n], strict=True)}, cuts)


def sample(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """doc_id, toxic, words (distinct features): at most half of ``max_fit_rows`` documents of each class, those of the smallest hash."""
    order = F.xxhash64("doc_id", F.lit("fit"))
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = one.where("toxic = 1").orderBy(order, "doc_id").limit(max_fit_rows // 2).union(one.where("toxic = 0").orderBy(order, "doc_id").limit(max_fit_rows // 2))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(picked, "doc_id")

    def kernel(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                sets = [sorted(features(t.as_py())) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(sets, pa.list_(pa.binary()))], names=["doc_id", "toxic", "words"])

    return texts.select("doc_id", "text", "toxic").mapInArrow(kernel, "doc_id long, toxic int, words array<binary>")


def vocabulary(sampled: DataFrame, n1: int, n0: int, most: int = MAX_VOCABULARY) -> list[tuple[bytes, float]]:
    """(feature, log odds) of the features whose likelihood ratio against chance is significant, the most significant first."""
    df = sampled.select("toxic", F.explode("words").alias("w")).groupBy("w").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    df = df.where(F.col("a") + F.col("b") >= F.lit(max(MIN_TEXTS, MIN_SHARE * n1)))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    share = (F.col("a") + F.col("b")) / F.lit(float(n1 + n0))
    term = lambda c, n: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (n * share))).otherwise(0.0)
    df = df.select("w", odds.alias("odds"), (2 * (term("a", n1) + term("b", n0))).alias("g")).where(F.col("g") >= SIGNIFICANT)
    return [(bytes(r["w"]), r["odds"]) for r in df.orderBy(F.desc("g"), "w").limit(most).collect()]


def train(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> Model | None:
    """The model, or None without labels of both classes. The driver gets the vocabulary and its places in the sample only."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    sampled = scratch.save(sample(docs, labels, max_fit_rows), "sample")
    n = {r["toxic"]: r["count"] for r in sampled.groupBy("toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        return None
    vocab = vocabulary(sampled, n[1], n[0])
    place = {w: i for i, (w, _) in enumerate(vocab)}

    def kernel(batches):
        for batch in batches:
            found = [[place[w] for w in (x.as_py() for x in words) if w in place] for words in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "toxic", "found"])

    rows = sorted(map(tuple, sampled.mapInArrow(kernel, "doc_id long, toxic int, found array<int>").collect()))
    return fit([r[2] for r in rows], np.array([r[1] for r in rows]), [w for w, _ in vocab], np.array([o for _, o in vocab]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, p_ge_1 .. p_ge_3, expected_severity (their sum), severity (the likeliest grade) and toxic (p_ge_1 >= 0.5)."""
    plain = None if model is None else (model.weights, model.cuts)
    sent = docs.sparkSession.sparkContext.broadcast(plain)  # at most MAX_VOCABULARY words

    def kernel(batches):
        m = None if sent.value is None else Model(*sent.value)
        for batch in batches:
            p = np.zeros((batch.num_rows, GRADES))
            if m is not None:
                known = m.weights.keys()
                for i, t in enumerate(batch.column(1)):
                    p[i] = m.severity(known & features(t.as_py()))
            grade = np.concatenate((np.ones((len(p), 1)), p), axis=1) - np.concatenate((p, np.zeros((len(p), 1))), axis=1)
            cols = [pa.array(p[:, k]) for k in range(GRADES)] + [pa.array(p.sum(axis=1)), pa.array(grade.argmax(axis=1).astype(np.int64)), pa.array(p[:, 0] >= 0.5)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", *[f"p_ge_{k + 1}" for k in range(GRADES)], "expected_severity", "severity", "toxic"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(kernel, "doc_id long, " + ", ".join(f"p_ge_{k + 1} double" for k in range(GRADES)) + ", expected_severity double, severity long, toxic boolean")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: severity of every document, from a model fitted on the table's own labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
