"""Queries over sharding and mixing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flexspark.llm import mixing, shard
from flexspark.llm.registry import load, query

SHARDS = 16
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All columns, and law, shard, grown_shard, slot; equal weights, keyed by doc_id."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")))
    placed = shard.assign(docs.withColumn("law", F.lit("key")), F.col("doc_id"), [1.0] * shards)
    return shard.slots(placed, F.col("doc_id"), [crc])


@query()
def op3_rendezvous_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard of 16, slot in it, and shard of 17. Texts are measured before the shuffle and do not take part in it."""
    docs = load(spark, folder, "documents")
    rows = docs.select("doc_id", text_size(F.col("text")).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("text_crc32"))
    placed = shard.assign(rows.withColumn("law", F.lit("key")), F.col("doc_id"), [1.0] * SHARDS)
    return shard.slots(placed, F.col("doc_id"), [F.col("text_crc32")]).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def domain(source: Column) -> Column:
    """The tables name no domain: a source's is its number modulo 4; without a number it is ``none``."""
    n = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(n == "", F.lit("none")).otherwise(F.concat(F.lit("d"), (n.cast("long") % 4).cast("string")))


def tokens(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0))


def weight(values: dict[str, int], column: str) -> Column:
    out = F.lit(1)
    for k, w in values.items():
        out = F.when(F.col(column) == k, w).otherwise(out)
    return out


def mix_documents(docs: DataFrame, budget_share: float, max_epochs: int) -> DataFrame:
    """Domain, language, source tree over documents; sources of one language and domain weigh the same."""
    return mixing.mix(
        docs,
        [domain(F.col("source")), F.col("lang"), F.col("source")],
        [weight(DOMAIN_WEIGHTS, "__l0"), weight(LANG_WEIGHTS, "__l1"), F.lit(1)],
        tokens(F.col("text")),
        F.col("doc_id"),
        [F.col("text")],
        budget_share,
        max_epochs,
    )


_WATER = """
{name}_n AS (SELECT {keys}, sum(cap) AS c, max(b) AS b, max({w}) AS w FROM {prev} GROUP BY ALL),
{name}_o AS (SELECT *, b - coalesce(sum(c) OVER (PARTITION BY {parent} ORDER BY c / w, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest0,
  sum(w) OVER (PARTITION BY {parent}) - coalesce(sum(w) OVER (PARTITION BY {parent} ORDER BY c / w, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w0 FROM {name}_n),
{name}_f AS (SELECT *, c * w0 <= rest0 * w AS full_ FROM {name}_o),
{name}_r AS (SELECT *, b - coalesce(sum(c) FILTER (full_) OVER (PARTITION BY {parent}), 0) AS rest, sum(w) FILTER (NOT full_) OVER (PARTITION BY {parent}) AS wr FROM {name}_f),
{name} AS (SELECT p.* EXCLUDE (b), CASE WHEN r.full_ THEN r.c ELSE least(r.c, (r.rest * r.w) // r.wr) END AS b FROM {prev} p JOIN {name}_r r ON {on})"""


def mix_sql(documents: str, budget_share: float, max_epochs: int, seed: int = 7) -> str:
    """The mixture of a table or subquery of documents, as SQL: its rows with d, tok, epoch."""
    level = []
    for i, (name, w) in enumerate((("m1", "wd"), ("m2", "wl"), ("m3", "ws"))):
        keys = ["d", "lang", "source"][: i + 1]
        level.append(_WATER.format(name=name, w=w, keys=", ".join(keys), prev=f"m{i}", parent=", ".join(keys[:-1]) or "1", on=" AND ".join(f"p.{k} IS NOT DISTINCT FROM r.{k}" for k in keys)))
    return f"""WITH t AS (SELECT *, CASE WHEN regexp_matches(coalesce(source, ''), '[0-9]$') THEN 'd' || (regexp_extract(source, '([0-9]{{1,9}})$', 1)::BIGINT % 4) ELSE 'none' END AS d,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tok FROM {documents}),
m0 AS (SELECT d, lang, source, sum(tok)::BIGINT AS supply, (sum(tok) * {max_epochs})::HUGEINT AS cap,
  CASE d WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END AS wd, CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS wl, 1 AS ws,
  (SELECT floor(sum(tok) * {budget_share}::DOUBLE)::HUGEINT FROM t) AS b FROM t GROUP BY ALL),{",".join(level)},
plan AS (SELECT d, lang, source, (b // supply)::INT AS whole, b % supply AS room FROM m3 WHERE supply > 0),
s AS (SELECT t.*, p.whole, p.room, sum(tok) OVER (PARTITION BY t.d, t.lang, t.source ORDER BY md5('{seed}:' || p.whole || ':' || coalesce(doc_id::VARCHAR, '')), doc_id, text ROWS UNBOUNDED PRECEDING) AS upto
  FROM t JOIN plan p ON t.d = p.d AND t.lang IS NOT DISTINCT FROM p.lang AND t.source IS NOT DISTINCT FROM p.source),
u AS (SELECT *, unnest(range(0, whole + CASE WHEN room > 0 AND upto <= room THEN 1 ELSE 0 END))::INT AS epoch FROM s)
SELECT * FROM u"""


SQL_MIX = f"SELECT doc_id, d AS domain, lang, source, tok AS tokens, epoch FROM ({mix_sql('documents', 0.5, 4)})"


@query(sql=SQL_MIX)
def op10_budget_mix(spark: SparkSession, folder: str) -> DataFrame:
    """A mixture of half of all tokens: one row for each document and epoch that takes it."""
    mixed = mix_documents(load(spark, folder, "documents"), 0.5, 4)
    return mixed.select("doc_id", domain(F.col("source")).alias("domain"), "lang", "source", tokens(F.col("text")).cast("long").alias("tokens"), "epoch")
