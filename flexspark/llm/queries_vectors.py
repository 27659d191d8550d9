"""Queries over vectors and web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flexspark.llm import extract, forest, warc, whiten
from flexspark.llm.registry import load, query
from flexspark.sources.scratch import stage


@query()
def op1_projection_forest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return forest.nearest(load(spark, folder, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20)


@query("""
WITH sized AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
told AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM sized),
firsts AS (SELECT payload_digest AS digest, min(page_id) AS first FROM told WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM told LEFT JOIN firsts ON payload_digest = digest""")
def op7_warc_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written as a record and read back from the archives."""
    pages = load(spark, folder, "pages")
    archives = stage(warc.write(pages, warc.dictionary(pages)), "archives")
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    as_id = lambda c: F.when(page(c) != "", page(c)).cast("long")
    return warc.read(archives).select(as_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", as_id(F.col("refers_to")).alias("refers_to"), "error")


@query()
def op12_feast_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """A row for every vector and each of the four leading components."""
    rows, found = whiten.whiten(load(spark, folder, "embeddings"), "embedding", 4)
    share = F.array(*[F.lit(x) for x in found.explained]) if found and len(found.values) else F.array().cast("array<double>")
    return rows.select("vec_id", F.lit(found.n if found else 0).cast("long").alias("n"), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(found.identity_error if found else 0.0).alias("identity_error")
    )


@query()
def op11_page_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's article as text."""
    return extract.extract(load(spark, folder, "pages"), ["page_id", "url"])
