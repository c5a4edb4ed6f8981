"""The driver's queries over the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from patronage.llm import (
    ann_mih, chat_windows, embedding_tiles, html_template, license_scan, mixing, periodic_runs, piece_bpe, quality_rules, simhash,
    toxicity, turn_repair, warc_fixity)
from patronage.llm import sql as S
from patronage.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_mih.neighbours(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


ORACLE["op2_quality_rules"] = S.QUALITY


@query
def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat_windows.read_back(chat_windows.windows(turns.unionByName(odd)))


ORACLE["op3_chat_windows"] = S.CHAT


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_digests(table(spark, sf_dir, "documents"))


@query
def op5_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


@query
def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_fixity.audit(*warc_fixity.damaged_copy(warc_fixity.archive(table(spark, sf_dir, "pages"))))


ORACLE["op6_warc_fixity"] = S.FIXITY


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


ORACLE["op8_mixing"] = S.MIXING


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.with_planted_runs(table(spark, sf_dir, "documents")))


ORACLE["op11_periodic_runs"] = S.RUNS


@query
def op12_embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_tiles.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE["op12_embedding_tiles"] = S.VECTORS


@query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_digests(table(spark, sf_dir, "conversations"))


ORACLE["op13_turn_repair"] = S.REPAIR


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
