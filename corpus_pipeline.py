"""A corpus pipeline: quality filter, exact and near dedup, secret masking, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns documents (the last: packed
pieces). run() writes every stage's rows as a Parquet table in the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spliceloom.llm import exact, minhash, packing, quality, secrets
from spliceloom.llm.common import table, written
from spliceloom.llm.registry import tokenizer_file

#: SQL cannot express the trained filter, the joins by sketches or the tokenizer.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.keep_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles of five words link at a similarity of 0.8 or more."""
    return minhash.drop_near_copies(docs, width=5, percent=80)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets masked; n_chars follows the text."""
    return secrets.redact_secrets(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two lengths."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), 0)


STAGES = [("quality", quality_filter), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("secrets", secret_masking), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
