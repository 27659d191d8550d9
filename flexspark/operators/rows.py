"""Split rows, join, merge, union, aggregate."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.operators.hot import dealt
from flexspark.plans.discover import choice_paths
from flexspark.plans.paths import as_list, top, value_at
from flexspark.plans.types import Choice, contains, merge_types, to_spark

# Comparison signs of a row split.
COMPARE = {
    ">": operator.gt,
    "<": operator.lt,
    ">=": operator.ge,
    "<=": operator.le,
    "=": operator.eq,
    "==": operator.eq,
    "!=": operator.ne,
}


def split_rows(df: DataFrame, comparisons: dict[str, dict[str, object]]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every ``{path: {sign: value}}`` comparison, and all the others (nulls included)."""
    tests = []
    for path, by_sign in comparisons.items():
        col = value_at(df.schema, path)
        for sign, value in by_sign.items():
            if sign not in COMPARE:
                raise ValueError(f"unknown comparison {sign!r}")
            whole = isinstance(value, int) and not isinstance(value, bool)
            tests.append(COMPARE[sign](col, F.lit(value).cast("long") if whole else F.lit(value)))
    if not tests:
        raise ValueError("no comparison given")
    inside = reduce(operator.and_, tests)
    return df.where(inside), df.where(~F.coalesce(inside, F.lit(False)))


def join_on(left: DataFrame, right: DataFrame, left_paths, right_paths, how: str = "inner", salts: int = 0, share: float = 0.01) -> DataFrame:
    """Equality join on path lists. Both sides keep all columns; clashing right names get ``right_``.

    With ``salts``, keys that hold ``share`` of the rows of either side are dealt over so many tasks (:func:`~flexspark.operators.hot.dealt`), which
    also holds where the result is grouped on the key or both sides are hot; two small passes over the keys find them. Inner joins only.
    """
    if salts and how != "inner":
        raise ValueError("only inner joins are dealt over salts")
    left_paths, right_paths = as_list(left_paths), as_list(right_paths)
    if not left_paths or len(left_paths) != len(right_paths):
        raise ValueError("both sides need the same number of join paths")
    for side, paths in ((left, left_paths), (right, right_paths)):
        for p in paths:
            _comparable(side.select(value_at(side.schema, p)), "join on")
    right_keys = [(f"__key{i}", value_at(right.schema, p)) for i, p in enumerate(right_paths)]
    taken = {c.lower() for c in left.columns}
    names = {}
    for c in right.columns:
        new = c
        while new.lower() in taken:
            new = f"right_{new}"
        taken.add(new.lower())
        names[c] = new
    renamed = right.select(*[top(c).alias(n) for c, n in names.items()], *[k.alias(n) for n, k in right_keys])
    keys = [value_at(left.schema, p) for p in left_paths]
    condition = reduce(operator.and_, [k == top(n) for k, (n, _) in zip(keys, right_keys)])
    if salts > 1:
        # hashes of a key agree where its types do
        kinds = [left.select(k.alias("k")).schema["k"].dataType for k in keys]
        cast = [top(n).cast(t) for (n, _), t in zip(right_keys, kinds)]
        left, renamed = dealt(left, renamed, keys, cast, salts, share)
        renamed = renamed.withColumnRenamed("__salt", "__right_salt")
        condition &= top("__salt") == top("__right_salt")
    return left.join(renamed, condition, how).drop(*[n for n, _ in right_keys], "__salt", "__right_salt")


def merge_rows(source: DataFrame, staged: DataFrame, keys) -> DataFrame:
    """Staged rows replace the source rows of their keys; source rows without a match stay, duplicates included.

    Only the distinct staged keys travel to the anti join, and source rows with a null key always stay.
    """
    return union_rows(_by_keys(source, staged, as_list(keys), "left_anti"), staged)


def _by_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join against the distinct keys of the right side.

    Copies of a key are combined before they travel. They are combined as one struct, so the keys are shuffled once
    more for the join itself: with a join directly above its own two shuffles adaptive execution can split the
    partition of a hot key on the left, which it cannot when an aggregation sits in between.
    """
    for side in (left, right):
        _comparable(side.select(*keys), "match on")
    distinct = right.select(F.struct(*[top(k) for k in keys]).alias("__keys")).distinct().select("__keys.*")
    return left.join(distinct, keys, how).select(*[top(c) for c in left.columns])


def union_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both by column name. Missing columns become null; conflicting ones become choices.

    VARIANT stores integers without a width, so columns that differ only in integer width are widened. Names are compared as
    ``spark.sql.caseSensitive`` says; the left's spelling stays.
    """
    if left.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() != "true":
        spelt = {c.lower(): c for c in left.columns}
        right = right.select(*[top(c).alias(spelt.get(c.lower(), c)) for c in right.columns])
    theirs = {f.name: f for f in right.schema.fields}
    ours = {f.name for f in left.schema.fields}
    merged: list[tuple[str, T.DataType]] = []
    for f in left.schema.fields:
        both = f.name in theirs
        merged.append((f.name, _meet(f.dataType, theirs[f.name].dataType) if both else f.dataType))
    merged += [(f.name, f.dataType) for f in right.schema.fields if f.name not in ours]
    sides = [_shape(side, merged) for side in (left, right)]
    out = sides[0].unionByName(sides[1])
    for name, dtype in merged:
        if contains(to_spark(dtype), T.VariantType):
            known = not any(contains(s.schema[name].dataType, T.VariantType) for s in (left, right) if name in s.columns)
            out = out.withMetadata(name, {"choices": choice_paths(dtype)} if known else {})
    return out


_WIDTHS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def _meet(a: T.DataType, b: T.DataType) -> T.DataType:
    if isinstance(a, T.VariantType) or isinstance(b, T.VariantType):
        return T.VariantType()
    dtype = merge_types(a, b)
    return _widen(dtype)


def _widen(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, Choice):
        ranks = {type(o): i for i, o in enumerate([w() for w in _WIDTHS])}
        whole = [o for o in dtype.options.values() if type(o) in ranks]
        rest = [o for o in dtype.options.values() if type(o) not in ranks]
        if whole:
            rest.append(max(whole, key=lambda o: ranks[type(o)]) if not rest else T.LongType())
        return rest[0] if len(rest) == 1 else Choice(rest)
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _widen(f.dataType), True, f.metadata) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_widen(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, _widen(dtype.valueType))
    return dtype


def _shape(df: DataFrame, merged: list[tuple[str, T.DataType]]) -> DataFrame:
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name, dtype in merged:
        target = to_spark(dtype)
        if name not in have:
            out.append(F.lit(None).cast(target).alias(name))
        else:
            out.append(_into(top(name), have[name], target).alias(name))
    return df.select(*out)


def _into(col: Column, dtype: T.DataType, target: T.DataType) -> Column:
    """Column of one side in the merged type: fields added, conflicting values wrapped as VARIANT."""
    if dtype == target:
        return col
    if isinstance(target, T.VariantType):
        if isinstance(dtype, T.VariantType):
            return col
        nested = isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))
        return F.to_variant_object(col) if nested else col.cast(target)
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast(target)
    if isinstance(target, T.StructType):
        have = {f.name: f.dataType for f in dtype.fields}
        fields = [
            (_into(col.getField(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType):
        return F.transform(col, lambda x: _into(x, dtype.elementType, target.elementType))
    if isinstance(target, T.MapType):
        return F.transform_values(col, lambda k, v: _into(v, dtype.valueType, target.valueType))
    return col.cast(target)


def _comparable(df: DataFrame, doing: str) -> None:
    for f in df.schema.fields:
        if contains(f.dataType, T.VariantType):
            raise ValueError(f"cannot {doing} {f.name!r}: it holds a choice, resolve it first")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows."""
    _comparable(df, "compare")
    return df.distinct()


def subtract_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left that the right does not hold; copies are combined before they travel."""
    _comparable(left, "compare")
    return left.distinct().subtract(right.distinct())


def semi_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Left rows that have a match, matched on shared column names."""
    return _by_keys(left, right, as_list(keys), "left_semi")


def count_distinct_tuples(df: DataFrame, cols: Iterable[str], name: str = "distinct_tuples") -> DataFrame:
    """Number of distinct tuples; a tuple of nulls counts as one."""
    return df.agg(F.count_distinct(F.struct(*[value_at(df.schema, c) for c in cols])).alias(name))


def group_max(df: DataFrame, keys, value: str, name: str) -> DataFrame:
    """Largest value per key, combined map-side."""
    cols = [value_at(df.schema, k).alias(k.split(".")[-1]) for k in as_list(keys)]
    return df.groupBy(*cols).agg(F.max(value_at(df.schema, value)).alias(name))


def latest_per_key(df: DataFrame, key: str, time: str, as_of=None) -> DataFrame:
    """Rows holding the latest time of their key, as of a time; all ties stay. Rows without key or time have none.

    One scan and one shuffle: Spark limits the ranks below the exchange, so every task sends only its own latest rows of a
    key, also of a hot one.
    """
    k, t = value_at(df.schema, key), value_at(df.schema, time)
    held = k.isNotNull() & t.isNotNull()
    rows = df.where(held if as_of is None else held & (t <= F.lit(as_of)))
    ranked = rows.withColumn("__rank", F.rank().over(Window.partitionBy(k).orderBy(t.desc())))
    return ranked.where("__rank = 1").drop("__rank")
