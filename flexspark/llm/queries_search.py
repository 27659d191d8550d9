"""Queries over ranked search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flexspark.llm import lexical
from flexspark.llm.registry import load, query

_TERMS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SQL_SEARCH = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS.format("text")} AS ws FROM documents),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(ws))::BIGINT AS words FROM d WHERE len(ws) > 0),
q AS (SELECT item_id, term, count(*)::BIGINT AS q FROM (SELECT item_id, unnest({_TERMS.format("text")}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
m AS (SELECT r, doc_id, 25 + (75 * len(ws) * docs) // words AS m FROM d, s),
x AS (SELECT q.item_id, m.doc_id, m.r, sum(q.q * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * m.m)))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank FROM x WHERE score > 0) WHERE rank <= 10"""


@query(sql=SQL_SEARCH)
def op13_pipelined_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(load(spark, folder, "documents"), load(spark, folder, "benchmark"), 10)
