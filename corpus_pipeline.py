"""From raw documents to packed token sequences, in stages of the numbered operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm.jaccard import deduplicated
from lodestone.llm.mixing import mixed_documents
from lodestone.llm.packing import packed_documents
from lodestone.llm.quality import accepted_documents
from lodestone.llm.surrogates import with_surrogates
from lodestone.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject the documents that the attention classifier scores below its threshold."""
    return accepted_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return deduplicated(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put surrogates in the place of personal data."""
    return with_surrogates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw the sources to their target weights; a row for each pass over a document."""
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise and pack into sequences."""
    return packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_distinct),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier, the tokenizer and the seeded draws are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
