"""The corpus pipeline: stages that each take the documents kept so far and return those that stay.

All but the last return the columns of documents unchanged. Null and empty texts have no language and so go in the
first stage. Repeated rows stay or go together. Models are learned from the documents that reach the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import langid, minhash, packing, toxicity
from kerbside.llm.common import store, table
from kerbside.session import prepare


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter, and those less like any learned language than nearly all of its own texts are."""
    train = docs.filter(~langid.held_out())
    profiles = langid.learn(train)
    return langid.keep_known(docs, profiles, langid.bounds(train, profiles))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that are predicted toxic."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, keep the document with the smallest id: five words, similarity 0.8."""
    return minhash.keep_one(docs, width=5, threshold=0.8)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("language", language), ("toxicity", clean), ("near_duplicates", dedup), ("packing", pack)]

# Classifiers learn from texts and tokens come from a vocabulary file, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents; each one's result is stored and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
