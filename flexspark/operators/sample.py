"""Samples that are uniform, exact in size and the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flexspark.plans.paths import top


def seeded_sample(df: DataFrame, num: int, seed: int, key_cols: list[str] | None = None) -> DataFrame:
    """The ``num`` rows with the smallest MD5 of ``seed:key``, whatever the partitions; all rows, if they are fewer.

    The key is the text of the key columns, joined by commas (null: empty), else the whole row as JSON. Tasks send the hashes of their own ``num``
    first rows only; rows are then fetched by hash. Rows of one hash are the same key: as many of them are taken as there is room for.
    """
    key = F.concat_ws(",", *[F.coalesce(top(c).cast("string"), F.lit("")) for c in key_cols]) if key_cols else F.to_json(F.struct(*[top(c) for c in df.columns]))
    hashed = df.withColumn("__hash", F.md5(F.concat(F.lit(f"{seed}:"), key)))
    picked = hashed.select("__hash").orderBy("__hash").limit(num).groupBy("__hash").agg(F.count("*").alias("__room"))
    met = hashed.join(picked, "__hash")
    few = Window.partitionBy("__hash").orderBy(F.lit(0))
    return met.withColumn("__n", F.row_number().over(few)).where(F.col("__n") <= F.col("__room")).select(*[top(c) for c in df.columns])
