"""Sharding by weighted rendezvous hashing; DataFrame functions only.

Every (key, shard) pair has a pseudo-random number u in (0, 1) from its MD5; the record goes to the shard with the largest
weight / -ln(u). A new shard only adds one more contender, so a record either stays or moves into the new shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def draw(key: Column, shard: Column) -> Column:
    """Number in (0, 1) of a key and a shard: the first 52 bits of an MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), shard.cast("string"))), 1, 13), 16, 10)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def winner(key: Column, weights: Sequence[float]) -> Column:
    """Struct (score, shard) of the best shard; shards of weight 0 or less get nothing, equal scores go to the smaller shard."""
    rivals = [(i, float(w)) for i, w in enumerate(weights) if w > 0]
    if not rivals:
        raise ValueError("at least one shard needs a positive weight")
    given = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in rivals])
    best = F.array_max(F.transform(given, lambda r: F.struct((r["w"] / -F.log(draw(key, r["i"]))).alias("score"), (-r["i"]).alias("i"))))
    return F.struct(best["score"].alias("score"), (-best["i"]).alias("shard"))


def assign(df: DataFrame, key: Column, weights: Sequence[float], grown_weight: float = 1.0) -> DataFrame:
    """Add ``shard``, and ``grown_shard``: the shard if one more of ``grown_weight`` stood at the end.

    A null key is a key of its own (all null keys share a shard); equal keys always share a shard. Columns of these names
    are replaced, others stay. An empty input gives an empty result.
    """
    n = len(weights)
    old = winner(key, weights)
    df = df.withColumn("__shard_best", old)
    new = F.lit(float(grown_weight)) / -F.log(draw(key, F.lit(n)))
    return df.withColumns(
        {
            "shard": F.col("__shard_best.shard").cast("int"),
            "grown_shard": F.when(F.lit(grown_weight > 0) & (new > F.col("__shard_best.score")), F.lit(n)).otherwise(F.col("__shard_best.shard")).cast("int"),
        }
    ).drop("__shard_best")


def slots(df: DataFrame, key: Column, ties: Sequence[Column], buckets: int = BUCKETS) -> DataFrame:
    """Add ``slot``: places 0, 1, 2, ... within each shard, in order of the key's hash.

    The order is by (hash, key, ties); rows equal in all of them may swap. Each shard is ordered in ``buckets`` ranges of
    the hash, so no task holds a shard; the ranges' starts come from their counts. The result does not depend on ``buckets``.
    """
    word = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    bits = (buckets - 1).bit_length()
    # the bucket is the hash's first bits, so ranges follow the order of the hash
    bucket = F.shiftright(F.conv(F.substring(word, 1, 8), 16, 10).cast("long"), 32 - bits).cast("int")
    df = df.withColumns({"__slot_hash": word, "__slot_bucket": bucket})
    starts = (
        df.groupBy(F.col("shard").alias("__slot_shard"), F.col("__slot_bucket").alias("__slot_in"))
        .agg(F.count("*").alias("__slot_n"))
        .withColumn("__slot_start", F.sum("__slot_n").over(Window.partitionBy("__slot_shard").orderBy("__slot_in")) - F.col("__slot_n"))
        .drop("__slot_n")
    )
    inside = Window.partitionBy("shard", "__slot_bucket").orderBy("__slot_hash", key, *ties)
    placed = df.withColumn("__slot_at", F.row_number().over(inside) - 1)
    joined = placed.join(starts, (F.col("shard") == F.col("__slot_shard")) & (F.col("__slot_bucket") == F.col("__slot_in")))
    return joined.withColumn("slot", (F.col("__slot_start") + F.col("__slot_at")).cast("long")).drop("__slot_hash", "__slot_bucket", "__slot_shard", "__slot_in", "__slot_start", "__slot_at")
