"""Queries over near and exact duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flexspark.llm import minhash, suffix
from flexspark.llm.registry import load, query


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query(f"""
WITH RECURSIVE texts AS (
  SELECT min(doc_id) AS first, text, any_value({_WORDS}) AS words FROM documents WHERE text IS NOT NULL GROUP BY text),
spread AS (SELECT first AS id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts),
runs AS (
  SELECT id, n, i, concat_ws(' ', word, lead(word, 1) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w) AS shingle
  FROM spread WINDOW w AS (PARTITION BY id ORDER BY i)),
sets AS (SELECT DISTINCT id, shingle FROM runs WHERE i <= greatest(n - 3, 1)),
sizes AS (SELECT id, count(*) AS size FROM sets GROUP BY id),
posts AS (SELECT id, size, shingle FROM sets JOIN sizes USING (id)),
links AS (
  SELECT a.id AS a, b.id AS b FROM posts a JOIN posts b ON a.shingle = b.shingle AND a.id <> b.id AND 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size)
  GROUP BY a.id, b.id, a.size, b.size HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))),
reached AS (SELECT first AS id, first AS other FROM texts UNION SELECT r.id, l.b FROM reached r JOIN links l ON r.other = l.a),
named AS (SELECT id, min(other) AS component FROM reached GROUP BY id)
SELECT doc_id, CAST(coalesce(size, 0) AS BIGINT) AS n_shingles, CASE WHEN size > 0 THEN component ELSE doc_id END AS component_id,
       CASE WHEN size > 0 THEN component = doc_id ELSE true END AS kept
FROM documents LEFT JOIN texts USING (text) LEFT JOIN sizes ON sizes.id = first LEFT JOIN named ON named.id = first""")
def op6_minhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents linked at Jaccard similarity 0.8 of four-word shingles."""
    return minhash.near_duplicates(load(spark, folder, "documents"), 4, 80).select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op2_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the 200-byte strings that start more than once."""
    return suffix.remove_repeats(load(spark, folder, "documents"), 200, texts=False).drop("spans", "kept")
