"""Queries of this subpackage over a data folder's tables, with SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from . import align, exact, langid, lines, minhash, packing, pieces, quality, rans, repeats, runs, secrets, vectors
from .common import shared_dir, table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify_documents(docs, langid.train(docs, tokenizer_file("piece_bpe_32k.model")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digest(table(spark, sf_dir, "documents"))


def op4_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/rans-{uuid.uuid4().hex}"
    return rans.round_trip(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), 1, 49_408)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), 0, with_ids=False)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment_digest(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digest(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_suffix_array": op3_suffix_array,
    "op4_rans_tokens": op4_rans_tokens,
    "op5_packing": op5_packing,
    "op6_minhash": op6_minhash,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality": op8_quality,
    "op9_merge_dropout": op9_merge_dropout,
    "op10_vector_graph": op10_vector_graph,
    "op11_alignment": op11_alignment,
    "op12_line_dedup": op12_line_dedup,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}
SQL = {"op2_exact_dedup": exact.SQL, "op12_line_dedup": lines.SQL}
