"""A corpus made ready for training: five stages over documents, each on all that the one before kept.

Every stage but the last gives the columns of documents; what a stage gives is written as Parquet and read
again by the next. Null and empty texts pass the quality stage, meet as one group of copies in the
next, have no personal data, count no words in the mix and have no tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomet.llm import bpe, copies, mixing, pii, quality
from velomet.llm.work import keep, table

#: Near duplicates share four fifths of their five-word shingles. Such texts differ in about 19 of 128
#: bits, with a spread of 4; a radius of 25 takes in what lies 1.4 spreads beyond, and the shingles decide.
SHINGLE, WORDS, RADIUS, MISSED, SIMILAR = 5, 2, 25, 0.01, 0.8
#: The key of a row while near copies are searched.
ROW = "_row_of_search"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier keeps."""
    return quality.kept(docs, quality.fit(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, links being of similarity 0.8 or more: that of the smallest id, those without an id coming last. Rows are told
    apart by a hash of id and text, so unlike texts that share an id, or have none, are searched like all others
    and all stay; of rows equal in both, which are copies, one stays."""
    keyed = docs.withColumn(ROW, F.xxhash64("doc_id", "text"))
    found = copies.near_copies(keyed.select(F.col(ROW).alias("doc_id"), "text"), SHINGLE, RADIUS, WORDS, MISSED, SIMILAR)
    groups = found.groupBy(F.col("doc_id").alias(ROW)).agg(F.min("component_id").alias("component_id"))
    ids = keyed.groupBy(ROW).agg(F.min("doc_id").alias("doc_id"))
    first = groups.join(ids, ROW).groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW))[ROW].alias(ROW))
    return keyed.join(first, ROW, "left_semi").dropDuplicates([ROW]).select(docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows."""
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return pii.masked(docs).withColumn("n_chars", F.when(F.col("text").isNotNull(), length).otherwise(F.col("n_chars")))


def mixed_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their number for every document."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, path).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", good_quality),
    ("near_copies", without_near_copies),
    ("personal_data", without_personal_data),
    ("mix", mixed_by_source),
    ("tokens", tokens),
]

#: The classifier's fit and the merges have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
