"""End-to-end corpus pipeline over the documents table.

Five stages, each one operator of ``winnow.llm`` with its query's parameters.
Every stage's result is written as Parquet and reread as the next one's input;
all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from winnow.llm import best_fit, common, decontaminate, gru_langid, pii_transducer, simhash_vptree
from winnow.llm.tokenizing import vocabulary
from winnow.session import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of no language (null text, or no letter in it) go; every other row is
    labelled with the predicted one, by which ``packing`` groups."""
    return gru_langid.keep_lettered(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of every SimHash component stays."""
    return simhash_vptree.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts; n_chars follows."""
    return pii_transducer.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces of 1024-token sequences, each of one language."""
    return best_fit.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=2, group_col="lang")


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

ORACLE_SQL = None  # the recurrent network, the fingerprints and the packing have no SQL form; tested by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
