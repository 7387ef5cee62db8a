"""The corpus pipeline: documents without toxic ones, one of each near-duplicate group, without repeated passages, mixed by
source and packed. Each stage works on all that its predecessor kept.

Defined cases: rows with a null id are never dropped as duplicates; of rows that share an id one stays. A text that
loses all of its words stays as an empty one until the mix, which takes no document of size 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacunar.llm import mixing, packing, simhash, substrings, toxicity
from lacunar.llm.queries import tokenizer_path
from lacunar.llm.scratch import materialize

ORACLE_SQL = None  # tokens and learned scores have no SQL; tests compare with brute force


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8 or more), the one with the smallest id."""
    return simhash.representatives(docs, shingle=5, similarity=0.8)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier."""
    return _measured(substrings.remove_repeats(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return _measured(mixing.mixed_documents(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), end=1, tokens=2048, segments=packing.SEGMENTS, loss=packing.LOSS, prompt_share=packing.PROMPT_SHARE)


STAGES = [("toxicity", clean), ("near-duplicates", distinct), ("substrings", unrepeated), ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole table of documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
