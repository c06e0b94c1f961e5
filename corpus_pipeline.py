"""A corpus pipeline: five stages over the documents, each written and read again by the next.

Near-duplicate sets use the operator's general settings: shingles of five words and a Jaccard
similarity of 0.8 or more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import decontaminate, jaccard_join, langid, quality_knn, trie_bpe
from kindred.llm.queries import vocabulary
from kindred.llm.shared import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that nearest-neighbour voting predicts as quality 1. Learns from the labelled ones among them."""
    fitted = quality_knn.learn(docs, table(spark, sf_dir, "labels"))
    return quality_knn.score(docs, fitted).where("predicted = 1").select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language prediction is accepted. Learns from their own labels."""
    return langid.predict(docs, langid.learn(docs)).where("accepted").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each connected group; rows without an id stay.

    Of rows that repeat that id one stays, the first by text and then by the other columns.
    """
    scratch = Scratch(spark, "dedup")
    found = jaccard_join.jaccard_components(docs)
    gone = scratch.keep("gone", found.where("doc_id != component_id").select(F.col("doc_id").alias("gone_id")).distinct())
    left = docs.join(gone, docs.doc_id == gone.gone_id, "left_anti")
    again = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again_id"))
    again = scratch.keep("again", again)
    if again.limit(1).count():
        one = left.join(again, left.doc_id == again.again_id, "left_semi")
        rest = [F.col(c).cast("string") for c in docs.columns if c not in ("doc_id", "text")]
        row = F.struct(F.col("text"), *rest, F.struct(*docs.columns).alias("row"))
        one = one.groupBy("doc_id").agg(F.min(row).alias("least")).select("least.row.*")
        left = left.join(again, left.doc_id == again.again_id, "left_anti").unionByName(one)
    return left.select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item; rows without an id go together if one of them does."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token counts and the digests of ids and decoded text."""
    return trie_bpe.encode_decode(docs, vocabulary())


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("encoding", encoding)]

#: Trained models decide, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
