"""A training corpus in five stages, each one operator of ``stratus.llm``.

Every stage takes the documents that its predecessor kept, as read back from
Parquet, and returns those that it keeps, in the columns of ``documents``; the
last returns the packed sequences. Cases that a stage defines for null or empty
texts, repeated ids, empty tables and further columns are those of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm import langid, mixing, neardup, packing, passages
from stratus.llm.common import ship, store, table

#: Least score of a document's language; below it, or without a letter, it goes.
LEAST_LANGUAGE_SCORE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; learned from those that name theirs."""
    ship(spark)
    return langid.keep_identified(docs, langid.train(docs), LEAST_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return neardup.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of smaller id has."""
    out = passages.cut_passages(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, some twice, such that sources come near their target weights."""
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("mix", mix), ("pack", pack)]

#: No stage but the mix can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored and read back."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, name)
    return docs
