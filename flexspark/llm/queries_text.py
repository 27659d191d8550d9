"""Queries over texts: toxicity, leaks, secrets, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flexspark.llm import decontam, quality, secrets, toxic
from flexspark.llm.registry import load, query

TOXIC = 0.3


def train_labels(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "labels").where(~toxic.held_out())


@query()
def op9_nearest_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity score, with the labelled examples nearest to it and their cosines."""
    docs = load(spark, folder, "documents").select("doc_id", "text")
    scored = toxic.score(docs, toxic.fit(docs, train_labels(spark, folder)))
    return scored.select("doc_id", toxic.held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), "near", "cosine")


@query()
def op8_bm25_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item found in a document, with its best passage's BM25 score and the verified overlaps."""
    return decontam.leaks(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


@query()
def op4_structural_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: counts of the base kinds, their digest, and all spans."""
    found = secrets.scan(load(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), "base_sha256", F.col("joined").alias("spans"))


@query()
def op5_bayes_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality; host: its source, path: language within the source. Kept from one half on."""
    labels = load(spark, folder, "labels").where(~toxic.held_out())
    scored = quality.score(load(spark, folder, "documents"), labels, F.col("source"), F.col("lang"))
    return scored.withColumns({"held_out": toxic.held_out(), "kept": F.col("score") >= 0.5})
