"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that its predecessor kept, and is
written as Parquet before the next one reads it. All but the last return the columns of
``documents``. The classifiers learn from rows that are not held out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import exact_dedup, language, packing, quality, simhash
from footfall.llm.common import documents, stored
from footfall.llm.tokens import word_tokenizer


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for good."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages, or in a few of them."""
    return language.accepted(docs, language.fit(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text; white space makes no difference."""
    return exact_dedup.one_of_each(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, two differing bits at most."""
    return simhash.one_of_each(docs, width=3, radius=2)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences, each window with the sources' proportions."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("simhash", without_near_copies),
    ("packing", packed),
]

#: Trained models and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: one row per piece of a packed document."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
