"""A corpus pipeline over ``documents``: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept and returns a DataFrame, which
``run`` writes as Parquet into the shared checkpoint folder and reads again as the next stage's docs. All but
the last return the columns of documents; the last returns packed pieces.

Defined results, stage by stage: quality_rules rejects null, empty and blank texts, judges repeated rows alike and keeps
documents of a null lang, source or doc_id; line_dedup cuts repeated rows of one (doc_id, text) alike; simhash_near_dedup
keeps one row of each group, that of the smallest doc_id (null last), then text key, then hash of the other columns;
mixing takes a null source as one of its own, last, and shares one coin among rows of one (doc_id, text); best_fit_packing
packs every row as a document of its own. Very long texts go through whole, as rows. Extra columns travel with their row,
whatever their names, up to the last stage, which reads doc_id and text only. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from macropanel.llm import line_dedup, mixing, packing, quality, simhash
from macropanel.llm.common import Scratch, dropping_scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.passing(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without later occurrences of three-line windows."""
    return line_dedup.replace_text(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id."""
    return simhash.keep_one(docs, words=simhash.WORDS, bits=simhash.BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture takes them."""
    return mixing.emit(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents, placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_documents),
]

#: Tokenisers and XXH64 have no SQL; tests hold every stage and the whole run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        with dropping_scratch():
            docs = scratch.save(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
