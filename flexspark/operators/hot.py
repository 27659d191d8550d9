"""Joins on keys so frequent that one task can't take them."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 256


def frequent_hashes(df: DataFrame, keys: list[Column], share: float) -> list[int]:
    """Hashes of the keys that hold about ``share`` of the rows or more: at most TRACKED, from a sketch that tasks fill and Spark merges."""
    hashed = df.where(reduce(operator.and_, [k.isNotNull() for k in keys])).select(F.xxhash64(*keys).alias("h"))
    most = min(TRACKED, int(1 / share) + 1)
    row = hashed.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {most}, {4 * TRACKED})").alias("top")).first()
    return sorted(t["item"] for t in row["top"] or [] if t["count"] >= share * row["n"])


def dealt(left: DataFrame, right: DataFrame, left_keys: list[Column], right_keys: list[Column], salts: int, share: float, name: str = "__salt") -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt column to join on besides the keys: the rows of the left's and right's frequent keys are dealt over the salts on the
    side that has more of them, and copied to each salt on the other. All other rows have salt 0.

    The salt of a row follows from its values and its partition, so a task run again deals alike. Keys frequent on both sides are dealt on the left.
    """
    mine, theirs = frequent_hashes(left, left_keys, share), frequent_hashes(right, right_keys, share)
    theirs = [h for h in theirs if h not in set(mine)]
    hot = lambda keys, hashes: F.coalesce(F.xxhash64(*keys).isin(hashes), F.lit(False)) if hashes else F.lit(False)

    def salted(df: DataFrame, keys: list[Column], deal: list[int], copy: list[int]) -> DataFrame:
        own = F.pmod(F.xxhash64(*keys, *[F.col(f"`{c}`") for c, t in df.dtypes if "variant" not in t and "map" not in t], F.spark_partition_id()), F.lit(salts)).cast("int")
        every = F.sequence(F.lit(0), F.lit(salts - 1))
        return df.withColumn(name, F.explode(F.when(hot(keys, copy), every).otherwise(F.array(F.when(hot(keys, deal), own).otherwise(F.lit(0))))))

    return salted(left, left_keys, mine, theirs), salted(right, right_keys, theirs, mine)
