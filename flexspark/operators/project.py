"""Projection: keep, drop, rename, split and map fields by path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.plans.discover import extract
from flexspark.plans.nested import drop_paths, edit_fields, keep_paths
from flexspark.plans.paths import as_list, crosses_array, find_field, join_path, resolve, split_path, top, value_at
from flexspark.plans.types import contains, parse_type


def select_fields(df: DataFrame, paths: str | Iterable[str]) -> DataFrame:
    """Keep the listed nodes; nested ones keep their place in the nesting."""
    return keep_paths(df, as_list(paths))


def drop_fields(df: DataFrame, paths: str | Iterable[str]) -> DataFrame:
    """Drop the listed nodes."""
    return drop_paths(df, as_list(paths))


def split_fields(df: DataFrame, paths: str | Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """The listed nodes in the first frame, everything else in the second."""
    return select_fields(df, paths), drop_fields(df, paths)


def rename_field(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a node, or move it: both names are full paths, missing parents of the new one are created.

    A node that has the new name already is replaced.
    """
    names, _ = resolve(df.schema, old)
    target = split_path(new)
    if names[:-1] == target[:-1]:
        if len(names) == 1:
            clash = find_field(df.schema, target[0])
            others = [c for c in df.columns if c == names[0] or clash is None or c != clash.name]
            return df.select(*[top(c).alias(target[0]) if c == names[0] else top(c) for c in others])
        replaced = {new: lambda col, f: []}
        return edit_fields(df, {**replaced, old: lambda col, f: [(target[-1], col)]}, missing_ok=True)
    if crosses_array(df.schema, names):
        raise ValueError(f"cannot move {old!r} out of an array")
    value = value_at(df.schema, old)
    kept = edit_fields(df.withColumn("__moved", value), {old: lambda col, f: []})
    moved = top("__moved")
    out, placed = [], False
    for f in kept.schema.fields:
        if f.name == "__moved":
            continue
        if f.name == target[0]:
            out.append(_put(top(f.name), f.dataType, target[1:], moved).alias(f.name))
            placed = True
        else:
            out.append(top(f.name))
    if not placed:
        out.append(_wrap(target[1:], moved).alias(target[0]))
    return kept.select(*out)


def _wrap(names: tuple[str, ...], value: Column) -> Column:
    return F.struct(_wrap(names[1:], value).alias(names[0])) if names else value


def _put(col: Column, dtype: T.DataType, names: tuple[str, ...], value: Column) -> Column:
    """Struct with one more (or one replaced) node at ``names``."""
    if not names:
        return value
    if not isinstance(dtype, T.StructType):
        raise ValueError(f"{dtype.simpleString()} cannot hold a field {names[0]!r}")
    fields = [col.getField(f.name).alias(f.name) for f in dtype.fields if f.name != names[0]]
    inside = find_field(dtype, names[0], True)
    new = _put(col.getField(names[0]), inside.dataType, names[1:], value) if inside else _wrap(names[1:], value)
    return F.struct(*fields, new.alias(names[0]))


def apply_mapping(df: DataFrame, mappings: Iterable[tuple], case_sensitive: bool = False) -> DataFrame:
    """Select, cast and rename by tuples; fields without a mapping are dropped.

    ``(source, target)``, ``(source, target, target type)`` or ``(source, source type, target, target type)``.
    Paths are dotted; dotted targets build structs. Values that do not fit the target type become null.
    """
    tree: dict = {}
    for mapping in mappings:
        source, source_type, target, target_type = _four(mapping)
        col = _mapped(df.schema, source, source_type, target_type, case_sensitive)
        node = tree
        *parents, leaf = split_path(target)
        for name in parents:
            node = node.setdefault(name, {})
            if not isinstance(node, dict):
                raise ValueError(f"target {target!r} lies below another target")
        node[leaf] = col
    return df.select(*[_build(node).alias(name) for name, node in tree.items()])


def _four(mapping) -> tuple:
    if not isinstance(mapping, tuple):
        raise TypeError(f"a mapping is a tuple, not {type(mapping).__name__}")
    if len(mapping) == 2:
        return mapping[0], None, mapping[1], None
    if len(mapping) == 3:
        return mapping[0], None, mapping[1], mapping[2]
    if len(mapping) == 4:
        return mapping
    raise ValueError(f"a mapping has 2, 3 or 4 parts, not {len(mapping)}")


def _mapped(schema: T.StructType, source: str, source_type, target_type, case_sensitive: bool) -> Column:
    names, dtype = resolve(schema, source, case_sensitive)
    col = value_at(schema, source, case_sensitive)
    wanted = [parse_type(t) for t in (source_type, target_type) if t is not None]
    if crosses_array(schema, names):
        return F.transform(col, lambda x: _retype(x, dtype, wanted)) if wanted else col
    return _retype(col, dtype, wanted)


def _retype(col: Column, dtype: T.DataType, wanted: list[T.DataType]) -> Column:
    if isinstance(dtype, T.VariantType):
        return extract(col, "$", wanted[-1]) if wanted else col
    for to in wanted:
        if to != dtype:
            col, dtype = _fit(col, dtype, to), to
    return col


def _fit(col: Column, dtype: T.DataType, to: T.DataType) -> Column:
    """Null instead of an error where the value does not fit."""
    if contains(dtype, T.TimestampNTZType) and isinstance(to, T.LongType):
        return F.unix_seconds(col.cast("timestamp"))
    return col.try_cast(to)


def _build(node) -> Column:
    if isinstance(node, dict):
        return F.struct(*[_build(sub).alias(name) for name, sub in node.items()])
    return node


def expand_struct(df: DataFrame, column: str) -> DataFrame:
    """Fields of a struct column as the columns of the frame."""
    return df.select(F.col(f"{join_path((column,))}.*"))


def order_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fixed column order; columns the frame lacks are an error."""
    return df.select(*[top(n) for n in names])
