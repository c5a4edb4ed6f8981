"""The corpus pipeline: five stages, each an operator over what the one before kept.

``run`` writes each stage's rows to the shared folder and reads them again, so a
lost executor costs work of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.llm import mixing, piece_bpe, quality_rules, simhash, toxicity
from patronage.llm.common import table
from patronage.session import materialize


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity operator does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def good_kept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep."""
    return quality_rules.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their weights; a row for each pass over a document."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text that they decode to."""
    return piece_bpe.encode_digests(docs)


STAGES = [("toxicity", toxic_out), ("quality", good_kept), ("near_duplicates", one_of_each), ("mixing", mixed),
          ("sentencepiece", encoded)]

#: The first stage fits a model and the last encodes text: SQL can express neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
