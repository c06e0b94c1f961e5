"""The registered queries of these operators, and their SQL where it can express one."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import decontaminate, gif_media, html_blocks, jaccard_join, langid, lm_scoring, quality_knn, quote_chat, token_counts, trie_bpe
from kindred.llm.shared import fold, table

ORACLES_TABLES = ("documents", "benchmark")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary is; only the driver reads it."""
    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents whose quality label is 1. Background: all documents."""
    docs = lm_scoring.labelled_target(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return lm_scoring.cross_entropy_difference(docs, "in_target")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang").withColumn("held_out", fold("doc_id", 5) == 0)
    fitted = langid.learn(docs.where("NOT held_out"))
    return langid.predict(docs.drop("lang"), fitted).drop("text")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("edits", token_counts.planned_edits(F.col("text")))
    return token_counts.edited_counts(docs, vocabulary())


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir), jaccard_join.JaccardSettings(width=3, percent=90))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fitted = quality_knn.learn(docs.where(fold("doc_id", 4) != 2), table(spark, sf_dir, "labels"))
    return quality_knn.score(docs.withColumn("held_out", fold("doc_id", 4) == 2), fitted).drop("text")


def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.encode_decode(documents(spark, sf_dir), vocabulary()).drop("text")


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif_media.media_columns(documents(spark, sf_dir))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_chat.reply_ordered(table(spark, sf_dir, "conversations"))


def queries() -> dict:
    ops = (op1_lm_scoring, op2_language_id, op3_token_counts, op4_ngram_jaccard_join, op5_html_extraction, op6_benchmark_decontamination, op7_quality_classifier, op8_bpe_encoding, op9_media_columns, op10_chat_formatting)
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op6_benchmark_decontamination": decontaminate.ORACLE, "op4_ngram_jaccard_join": JACCARD}


#: Sets of shingle strings, pairs that share one, and the least id reachable by links.
JACCARD = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM word),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM shingles),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edge AS (SELECT x, y FROM pair UNION SELECT y, x FROM pair),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN edge e ON r.c = e.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM shingles s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""
