"""A training-corpus pipeline over ``documents``: five stages, each one operator of ``tidemark.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet to the
shared folder and read back as the next stage's ``docs``. Every stage works on all that its predecessor
kept. The first four return the columns of ``documents``; the last returns the encoded texts.

Odd rows: null, empty and short texts fail the quality rules, so later stages never see them there; on
their own the stages keep such rows (no toxicity, one near-duplicate class of wordless texts, no leak, no
ids). Rows with a null doc_id are kept by every stage that they pass on their text. Repeated rows count as
exact copies. Extra columns are kept by the first four stages and not read. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, near_copies, pieces, quality, toxicity
from tidemark.llm.common import id_bucket, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counting and tokeniser-fertility rules."""
    return quality.keep_good(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from the labelled ones among ``docs``
    that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(id_bucket("doc_id") != 1)
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, similarity 0.8), that with the smallest id.

    Candidates come from op9's operator (SimHash deletion variants, on the five-word sets) and, as about ten of 64 bits
    differ at a similarity of 0.8, from MinHash bands; all are verified on the whole shingle sets (``llm.near_copies``)."""
    return near_copies.keep_representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and round_trip of each document."""
    return pieces.encode_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding and decoding", encode),
]

#: Stages 2, 4 and 5 have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read back before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
