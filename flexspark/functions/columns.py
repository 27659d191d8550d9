"""Column functions for arrays and structs, and ingestion-time columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flexspark.plans.paths import top

# Granularities from coarse to fine; each one adds the column of its own part and all before it.
INGEST_PARTS = ["year", "month", "day", "hour", "minute"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_array_element(source, replacement, index: int) -> Column:
    """Array with the element at ``index`` (from 0) replaced; out of range leaves the array as it is."""
    new = _col(replacement)
    return F.transform(_col(source), lambda x, i: F.when(i == F.lit(index), new).otherwise(x))


def named_struct(*cols) -> Column:
    """Struct from alternating names and values, given one by one or as one list."""
    if len(cols) == 1 and isinstance(cols[0], (list, tuple, set)):
        cols = tuple(cols[0])
    if len(cols) % 2:
        raise ValueError("named_struct needs name, value pairs")
    return F.named_struct(*[F.lit(c) if i % 2 == 0 and isinstance(c, str) else _col(c) for i, c in enumerate(cols)])


def explode_with_index(col) -> Column:
    """Rows of an array with their position, as columns ``index`` and ``val``."""
    return F.posexplode(_col(col)).alias("index", "val")


def expand_items(df: DataFrame, column: str = "items") -> DataFrame:
    """One row per struct of an array column, its fields as the columns."""
    return df.select(F.inline(top(column)))


def add_ingestion_time_columns(df: DataFrame, granularity: str = "minute", ts: str | Column | None = None) -> DataFrame:
    """Add ``ingest_year`` down to ``ingest_<granularity>``; works on batches and streams.

    The time is the current timestamp, fixed once per query, unless a ``ts`` column is given.
    """
    if granularity.lower() not in INGEST_PARTS:
        raise ValueError(f"granularity must be one of {INGEST_PARTS}, not {granularity!r}")
    at = F.current_timestamp() if ts is None else _col(ts)
    read = {"year": F.year, "month": F.month, "day": F.day, "hour": F.hour, "minute": F.minute}
    parts = INGEST_PARTS[: INGEST_PARTS.index(granularity.lower()) + 1]
    return df.select("*", *[read[p](at).alias(f"ingest_{p}") for p in parts])
