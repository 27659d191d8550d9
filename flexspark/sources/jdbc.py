"""JDBC options for reading and writing through Spark's own source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# What a parallel read needs, all four together.
SPLIT_OPTIONS = ["partitionColumn", "lowerBound", "upperBound", "numPartitions"]


def jdbc_options(options: dict) -> dict[str, str]:
    """Spark options from a connection dict (``url``, ``user``, ``password``, ``dbtable`` or ``query``, ...)."""
    if not options.get("url"):
        raise ValueError("a jdbc connection needs a url")
    if bool(options.get("dbtable")) == bool(options.get("query")):
        raise ValueError("give exactly one of dbtable and query")
    given = [k for k in SPLIT_OPTIONS if options.get(k) is not None]
    if given and len(given) != len(SPLIT_OPTIONS):
        raise ValueError(f"a parallel read needs all of {SPLIT_OPTIONS}")
    return {k: str(v) for k, v in options.items() if v is not None and k != "vendor"}


def read_jdbc(spark: SparkSession, options: dict) -> DataFrame:
    """Parallel when the four split options are given, else one task."""
    return spark.read.format("jdbc").options(**jdbc_options(options)).load()


def write_jdbc(df: DataFrame, connection: dict, dbtable: str, mode: str = "append", **options) -> None:
    """Every partition writes over its own connection; ``numPartitions`` bounds how many at a time."""
    merged = jdbc_options({**{k: v for k, v in connection.items() if k != "query"}, **options, "dbtable": dbtable})
    df.write.format("jdbc").options(**merged).mode(mode).save()
