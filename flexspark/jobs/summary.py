"""Distinct-pair summary of a delimited file, data-quality rules, and shares of personal data per column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.operators.rows import count_distinct_tuples
from flexspark.plans.paths import top


def distinct_pairs(df: DataFrame, first: str, second: str, name: str = "distinct_count") -> DataFrame:
    """Number of distinct pairs; pairs with nulls count too."""
    return count_distinct_tuples(df, [first, second], name)


def summarize_csv(spark: SparkSession, source: str, target: str, first: str, second: str, separator: str = ",", escape: str = '"') -> DataFrame:
    """Read a CSV with header, count its distinct pairs and overwrite the target with the result."""
    rows = spark.read.option("header", "true").option("sep", separator).option("escape", escape).csv(source)
    distinct_pairs(rows, first, second).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def evaluate_rules(df: DataFrame, rules: list[dict]) -> DataFrame:
    """One row per rule: ``rule, column, checked, failed, passed``.

    Rules: ``{"rule": "complete"|"unique"|"in_range"|"in_set"|"row_count", "column": ..., "min": ..., "max": ...,
    "values": [...]}``. All but ``unique`` come from one pass; ``unique`` counts per value, reading its column only.
    """
    out: list[DataFrame] = []
    simple = [(i, r) for i, r in enumerate(rules) if r["rule"] != "unique"]
    if simple:
        aggs = [F.count("*").alias("n")] + [F.count_if(_violates(r)).alias(f"f{i}") for i, r in simple if r["rule"] != "row_count"]
        one = df.agg(*aggs)
        entries = [_entry(i, r, F.col("n"), _row_count(r) if r["rule"] == "row_count" else F.col(f"f{i}")) for i, r in simple]
        out.append(one.select(F.inline(F.array(*entries))))
    for i, r in enumerate(rules):
        if r["rule"] == "unique":
            counts = df.groupBy(top(r["column"]).alias("v")).count().where("v is not null")
            shared = F.when(F.col("count") > 1, F.col("count"))
            totals = counts.agg(
                F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.coalesce(F.sum(shared), F.lit(0)).alias("f")
            )
            out.append(totals.select(F.inline(F.array(_entry(i, r, F.col("n"), F.col("f"))))))
    return reduce(DataFrame.unionByName, out)


def _violates(r: dict) -> Column:
    col = top(r["column"])
    if r["rule"] == "complete":
        return col.isNull()
    if r["rule"] == "in_range":
        low = col < F.lit(r["min"]) if r.get("min") is not None else F.lit(False)
        high = col > F.lit(r["max"]) if r.get("max") is not None else F.lit(False)
        return low | high
    if r["rule"] == "in_set":
        return ~col.isin(list(r["values"]))
    raise ValueError(f"unknown rule {r['rule']!r}")


def _row_count(r: dict) -> Column:
    fits = F.lit(True)
    if r.get("min") is not None:
        fits = fits & (F.col("n") >= F.lit(r["min"]))
    if r.get("max") is not None:
        fits = fits & (F.col("n") <= F.lit(r["max"]))
    return F.when(fits, F.lit(0)).otherwise(F.col("n"))


def _entry(i: int, r: dict, checked: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(i).alias("number"),
        F.lit(r["rule"]).alias("rule"),
        F.lit(r.get("column")).cast("string").alias("column"),
        checked.cast("long").alias("checked"),
        failed.cast("long").alias("failed"),
        (failed == 0).alias("passed"),
    )


# Patterns of personal data, in the syntax both Java and RE2 read.
ENTITY_PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "IP_ADDRESS": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "PHONE_NUMBER": r"\b[0-9]{3}-[0-9]{3}-[0-9]{4}\b",
    "SSN": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}


def entity_share(df: DataFrame, columns: list[str] | None = None, patterns: dict[str, str] | None = None) -> DataFrame:
    """Rows of each text column that hold an entity: ``column, entity, rows, matches``; whole texts, one pass."""
    patterns = patterns or ENTITY_PATTERNS
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = [(c, e) for c in columns for e in patterns]
    one = df.agg(F.count("*").alias("n"), *[F.count_if(top(c).rlike(patterns[e])).alias(f"m{i}") for i, (c, e) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(e).alias("entity"), F.col("n").alias("rows"), F.col(f"m{i}").alias("matches"))
        for i, (c, e) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*entries)))
