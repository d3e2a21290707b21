"""The queries of the subpackage by name; each runs its operator over a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from velomet.llm import bpe, chat, fim, forest, hpylm, langid, mixing, negatives, packing, pii, quality, simhash, topk
from velomet.llm.work import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, radius=4)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.report(table(spark, sf_dir, "embeddings"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"))


def op6_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "copies", "taken")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), langid.fit(table(spark, sf_dir, "documents")))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(table(spark, sf_dir, "documents"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.report(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_bpe": op2_bpe,
    "op3_quality": op3_quality,
    "op4_topk": op4_topk,
    "op5_chat": op5_chat,
    "op6_forest": op6_forest,
    "op7_hpylm": op7_hpylm,
    "op8_mixing": op8_mixing,
    "op9_pii": op9_pii,
    "op10_langid": op10_langid,
    "op11_packing": op11_packing,
    "op12_fim": op12_fim,
    "op13_negatives": op13_negatives,
}

ORACLE_SQL = {
    "op4_topk": topk.REPORT_SQL,
    "op5_chat": chat.REPORT_SQL,
    "op6_forest": forest.REPORT_SQL,
    "op8_mixing": mixing.PLAN_SQL,
    "op12_fim": fim.REPORT_SQL,
    "op13_negatives": negatives.REPORT_SQL,
}
