"""A corpus from documents to packed sequences: quality, toxicity, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``docs``, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siteloom.llm import bpe, neardup, packing, quality, toxicity
from siteloom.llm.shared import MEMO_BYTES, table, written

VOCABULARY = "word_bpe_49k.json"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all labelled documents of the stage's input, scores at least 0.3."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is below 0.7."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.keep_first(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    The words a worker remembers take half the usual memory: workers that served the stages before hold more of it.
    """
    made = packing.pack_documents(docs, bpe.vocabulary(VOCABULARY), memo=MEMO_BYTES)
    return packing.digested(made, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


STAGES = [("quality", good_quality), ("toxicity", not_toxic), ("near_duplicates", one_of_each), ("packing", packed)]

# Trained models and hashed signatures are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
