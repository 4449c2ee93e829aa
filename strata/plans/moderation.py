"""Comment moderation over the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.moderation import moderate
from strata.plans.registry import query
from strata.sources import tables as t

# The blacklist (words chosen from the comment texts themselves).
BLACKLIST = ["worthless", "idiot", "stupid", "moron", "loser", "trash", "pathetic", "disgusting"]


def comment_moderation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag comments (documents) whose last comma token is listed (P0) or whose whole text
    contains listed words (P1).  Comments are first de-duplicated exactly on id (D10; of
    texts of one id the smallest).  Stand-in: some commenters end on a listed word."""
    ends = F.when(F.col("doc_id") % 7 == 0, F.lit(", trash ")).otherwise(F.lit(""))
    docs = t.read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.concat("text", ends).alias("text"))
    docs = docs.groupBy("id").agg(F.min("text").alias("text"))
    m = moderate(docs, "text", BLACKLIST)
    return m.select("id", "violation", "grade", "words")


def _sql() -> str:
    lst = "[" + ", ".join(f"'{w}'" for w in BLACKLIST) + "]"
    return f"""
WITH c AS (SELECT CAST(doc_id AS VARCHAR) AS id, text || CASE WHEN doc_id % 7 = 0 THEN ', trash ' ELSE '' END AS text FROM documents),
d AS (SELECT id, text, trim(string_split(text, ',')[-1]) AS last_tok,
                  list_filter({lst}, lambda w: contains(text, w)) AS found FROM c)
SELECT id,
  CASE WHEN list_contains({lst}, last_tok) OR len(found) > 0 THEN 1 ELSE 0 END AS violation,
  CASE WHEN list_contains({lst}, last_tok) THEN 'P0' WHEN len(found) > 0 THEN 'P1' ELSE '' END AS grade,
  CASE WHEN list_contains({lst}, last_tok) THEN last_tok WHEN len(found) > 0 THEN array_to_string(found, ', ') ELSE '' END AS words
FROM d
"""


query("comment_moderation", _sql())(comment_moderation)


def moderation_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X13 with a table of words, joined by k-grams: every word of 6 letters or more in the benchmark texts that
    starts with a to f, checked against all documents."""
    words = t.read(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")) \
        .where("length(word) >= 6 and word < 'g'")
    docs = t.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return moderate(docs, "text", words).select("id", "violation", "grade", "words")


query("moderation_word_table", """
WITH w AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM benchmark),
l AS (SELECT word FROM w WHERE length(word) >= 6 AND word < 'g'),
h AS (SELECT doc_id, string_agg(word, ', ' ORDER BY word) AS found FROM documents JOIN l ON contains(text, word) GROUP BY doc_id),
d AS (SELECT doc_id, trim(string_split(text, ',')[-1]) AS last_tok, found FROM documents LEFT JOIN h USING (doc_id))
SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN found IS NULL THEN 0 ELSE 1 END AS violation,
  CASE WHEN last_tok IN (SELECT word FROM l) THEN 'P0' WHEN found IS NULL THEN '' ELSE 'P1' END AS grade,
  CASE WHEN last_tok IN (SELECT word FROM l) THEN last_tok ELSE coalesce(found, '') END AS words
FROM d
""")(moderation_word_table)
