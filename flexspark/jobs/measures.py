"""Measures of columns whose states merge: each part of a table is read once, rules on the whole need the states only."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.plans.paths import top

DISTINCT_BITS = 12  # 4,096 registers: distinct counts to about 1.6 %
QUANTILE_K = 200  # ranks to about 1.7 %
STATE = "column string, n long, nulls long, low double, high double, low_text string, high_text string, distinct_state binary, quantile_state binary"


def measure(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """State of every column (see STATE): rows, nulls, extremes, and sketches of distinct values and, for numbers, of quantiles.

    One pass with partial aggregation; a column's state takes a few kilobytes whatever the rows. Numbers have ``low`` and ``high``, other plain
    types theirs as text. NaN counts as null for the extremes and quantiles only. Nested columns are measured through their JSON.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    columns = list(fields) if columns is None else list(columns)
    aggs, entries = [F.count("*").alias("n")], []
    for i, c in enumerate(columns):
        number = isinstance(fields[c], T.NumericType)
        value = F.to_json(top(c)) if isinstance(fields[c], (T.StructType, T.ArrayType, T.MapType, T.VariantType)) else top(c)
        real = F.nanvl(value.cast("double"), F.lit(None)) if number else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if number else value.cast("string")
        known = F.when(value.isNotNull(), F.xxhash64(value))
        parts = {
            "nulls": F.count_if(value.isNull()), "low": F.min(real), "high": F.max(real), "low_text": F.min(text), "high_text": F.max(text),
            "distinct_state": F.hll_sketch_agg(known, DISTINCT_BITS),
            "quantile_state": F.kll_sketch_agg_double(real, QUANTILE_K) if number else F.lit(None).cast("binary"),
        }
        aggs += [a.alias(f"{k}{i}") for k, a in parts.items() if not (k == "quantile_state" and not number)]
        held = [F.col(f"{k}{i}") if number or k != "quantile_state" else parts[k] for k in parts]
        entries.append(F.struct(F.lit(c).alias("column"), F.col("n"), *[h.alias(k) for h, k in zip(held, parts)]))
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def merge_measures(*states: DataFrame) -> DataFrame:
    """One state a column, of all rows that the given states saw."""
    every = reduce(DataFrame.unionByName, states)
    merged = every.groupBy("column").agg(
        *[F.sum(c).alias(c) for c in ("n", "nulls")],
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"),
        F.hll_union_agg("distinct_state").alias("distinct_state"), F.kll_merge_agg_double("quantile_state").alias("quantile_state"), F.count("quantile_state").alias("numbers"),
    )
    return merged.withColumn("quantile_state", F.when(F.col("numbers") > 0, F.col("quantile_state"))).drop("numbers")


def _quantile(share: float) -> Column:
    state = F.col("quantile_state")
    filled = F.kll_sketch_get_n_double(state) > 0
    return F.when(state.isNotNull() & filled, F.kll_sketch_get_quantile_double(state, F.lit(float(share))))


def report(states: DataFrame, shares: Iterable[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Figures of states: ``column, n, nulls, low, high, low_text, high_text, distinct_values`` (estimate), ``quantiles`` (by share; null without numbers)."""
    return states.select(
        "column", "n", "nulls", "low", "high", "low_text", "high_text", F.hll_sketch_estimate("distinct_state").alias("distinct_values"),
        F.array(*[_quantile(s) for s in shares]).alias("quantiles"),
    )


def check_measures(states: DataFrame, rules: list[dict]) -> DataFrame:
    """``rule, column, value, passed`` of rules on states; nothing but the states is read.

    Rules: ``{"rule": "rows"|"null_share"|"low"|"high"|"distinct"|"quantile", "column": ..., "min": ..., "max": ...}``, a quantile with its ``share``.
    A value that isn't there (no numbers, no rows) passes no rule; a column without a state has no row.
    """
    value = {
        "rows": F.col("n").cast("double"), "null_share": F.when(F.col("n") > 0, F.col("nulls") / F.col("n")), "low": F.col("low"), "high": F.col("high"),
        "distinct": F.hll_sketch_estimate("distinct_state").cast("double"),
    }
    out: list[DataFrame] = []
    for r in rules:
        if r["rule"] not in value and r["rule"] != "quantile":
            raise ValueError(f"unknown rule {r['rule']!r}")
        v = _quantile(r["share"]) if r["rule"] == "quantile" else value[r["rule"]]
        inside = v.isNotNull()
        inside &= v >= F.lit(r["min"]) if r.get("min") is not None else F.lit(True)
        inside &= v <= F.lit(r["max"]) if r.get("max") is not None else F.lit(True)
        out.append(states.where(F.col("column") == r["column"]).select(F.lit(r["rule"]).alias("rule"), "column", v.alias("value"), F.coalesce(inside, F.lit(False)).alias("passed")))
    return reduce(DataFrame.unionByName, out)


def lies_between(values: Column, x: float | None, low: float, high: float) -> Column:
    """Aggregate: whether x lies between the exact quantiles of two shares (linear between ranks, as ``percentile`` has them); null without x or values.

    How many values stand before x, and those next to it, decide that. So counts and extremes are merged, and no task holds the values.
    """
    v, x = values.cast("double"), F.lit(x).cast("double")
    n = F.count(v)

    def reached(share: float, before: Column, left: Column, right: Column, x_first: bool) -> Column:
        place = F.lit(share) * (n - 1)
        lo, hi = F.floor(place), F.ceil(place)
        between = (hi - place) * left + (place - lo) * right
        return F.when(hi < before, F.lit(not x_first)).when(lo >= before, F.lit(x_first)).otherwise(x <= between if x_first else between <= x)

    above = reached(low, F.count_if(v <= x), F.max(F.when(v <= x, v)), F.min(F.when(v > x, v)), False)
    below = reached(high, F.count_if(v < x), F.max(F.when(v < x, v)), F.min(F.when(v >= x, v)), True)
    return F.when(x.isNotNull() & (n > 0), above & below)


def _keys(columns: list[str]) -> Column:
    return F.struct(*[top(c).alias(f"__k{i}") for i, c in enumerate(columns)]).alias("__keys")


def repeated_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose values of these columns together occur more than once; rows with a null among them never do.

    Keys are counted as one struct and shuffled once more for the join, which then stands above its own two shuffles, where adaptive execution
    can split a hot key.
    """
    counted = df.groupBy(_keys(columns)).count().where("count > 1").select("__keys.*")
    same = reduce(lambda a, b: a & b, [top(c) == F.col(f"__k{i}") for i, c in enumerate(columns)])
    return df.join(counted, same, "left_semi")


def unmatched_rows(df: DataFrame, columns: list[str], other: DataFrame, other_columns: list[str]) -> DataFrame:
    """The rows whose values of these columns ``other`` lacks; rows with a null among them refer to nothing and are no failures."""
    known = other.select(_keys(other_columns)).distinct().select("__keys.*")
    same = reduce(lambda a, b: a & b, [top(c) == F.col(f"__k{i}") for i, c in enumerate(columns)])
    return df.where(reduce(lambda a, b: a & b, [top(c).isNotNull() for c in columns])).join(known, same, "left_anti")
