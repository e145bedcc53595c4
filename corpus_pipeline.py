"""A training-corpus pipeline over ``documents``: STAGES, and run().

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is
written as Parquet before the next one reads it. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from queryset.llm import decontaminate, mixing, near_copies, quality_classifier, token_files, tokens
from queryset.llm.scratch import written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rates good; it learns from all labels, so it does not depend on other stages."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.kept_documents(docs, labels, least=0.7, sample=6000)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: 5-word shingle sets with a Jaccard similarity of 0.8 or more, all pairs found."""
    return near_copies.one_of_each(docs, shingle_words=5)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=13, percent=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, each as often as the mix takes it."""
    return mixing.mixed_documents(docs, weights=(1, 2, 3), max_repeats=3)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row per document of what they hold."""
    return token_files.token_output(docs, tokens.default_path())


STAGES = [("quality classifier", classify), ("near-dedup", near_duplicates), ("benchmark decontamination", clean), ("mixing sources", mix), ("token ids", encode)]

#: SQL can't express the classifier or the tokenizer; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
