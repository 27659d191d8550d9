"""Rewrite chosen nodes of a nested schema with plain Column expressions.

One walk serves drop, keep, rename, cast, resolve and unbox: an *edit* maps a node to the columns that replace
it (none: dropped, several: expanded). Structs on the way are rebuilt from the leaves that stay, which lets
Spark read only those leaves from Parquet or ORC; arrays of structs are rebuilt with ``transform``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.plans.paths import join_path, resolve, split_path, top

Edit = Callable[[Column, T.StructField], list[tuple[str, Column]]]


def path_tree(paths: Iterable[tuple[str, ...]]) -> dict:
    """Nested dict of names; a leaf is ``None``. A parent named alone wins over its children."""
    tree: dict = {}
    for names in paths:
        node = tree
        for i, name in enumerate(names):
            last = i == len(names) - 1
            if name in node and node[name] is None:
                break
            if last:
                node[name] = None
            else:
                node = node.setdefault(name, {})
    return tree


def edit_fields(df: DataFrame, edits: dict[str, Edit], missing_ok: bool = False) -> DataFrame:
    """Apply edits, keyed by path, in one projection."""
    tree: dict = {}
    for path, edit in edits.items():
        try:
            names, _ = resolve(df.schema, path)
        except ValueError:
            if missing_ok:
                continue
            raise
        node = tree
        for name in names[:-1]:
            node = node.setdefault(name, {})
            if callable(node):
                raise ValueError(f"{path!r} lies inside another edited field")
        node[names[-1]] = edit
    out: list[Column] = []
    for f in df.schema.fields:
        out += [
            c if f.name not in tree else c.alias(name, metadata=_kept_metadata(f, tree[f.name]))
            for name, c in _edit_one(top(f.name), f, tree)
        ]
    return df.select(*out)


def _kept_metadata(field: T.StructField, edited) -> dict:
    """Column metadata after an edit: entries about edited nodes are dropped, they no longer hold."""
    metadata = dict(field.metadata or {})
    choices = metadata.pop("choices", None)
    if choices:
        gone = list(_edited(edited, ()))
        left = {k: v for k, v in choices.items() if not any(g == "" or k == g or k.startswith(g + ".") for g in gone)}
        if left:
            metadata["choices"] = left
    return metadata


def _edited(node, at: tuple[str, ...]):
    if callable(node):
        yield join_path(at)
    else:
        for name, sub in node.items():
            yield from _edited(sub, at + (name,))


def _edit_one(col: Column, field: T.StructField, tree: dict) -> list[tuple[str, Column]]:
    if field.name not in tree:
        return [(field.name, col)]
    node = tree[field.name]
    if callable(node):
        return node(col, field)
    rebuilt = _rebuild(col, field.dataType, lambda c, f: _edit_one(c, f, node))
    return [] if rebuilt is None else [(field.name, rebuilt)]


def _rebuild(col: Column, dtype: T.DataType, visit: Edit) -> Column | None:
    """Struct or array of structs put together again from what ``visit`` returns per field."""
    if isinstance(dtype, T.StructType):
        kept = [c.alias(name) for f in dtype.fields for name, c in visit(col.getField(f.name), f)]
        return F.when(col.isNotNull(), F.struct(*kept)) if kept else None
    if isinstance(dtype, T.ArrayType):
        if _rebuild(F.lit(None), dtype.elementType, visit) is None:
            return None
        return F.transform(col, lambda x: _rebuild(x, dtype.elementType, visit))
    raise ValueError(f"{dtype.simpleString()} has no named fields")


def drop_paths(df: DataFrame, paths: Iterable[str]) -> DataFrame:
    """Drop nodes; unknown paths are ignored. A struct left without fields goes too."""
    return edit_fields(df, {p: lambda col, f: [] for p in _outermost(paths)}, missing_ok=True)


def _outermost(paths: Iterable[str]) -> list[str]:
    cut = {split_path(p): p for p in paths}
    return [p for names, p in cut.items() if not any(names[:i] in cut for i in range(1, len(names)))]


def keep_paths(df: DataFrame, paths: Iterable[str]) -> DataFrame:
    """Keep only the listed nodes, in the listed order, at their place in the nesting."""
    tree = path_tree(resolve(df.schema, p)[0] for p in paths)
    fields = {f.name: f for f in df.schema.fields}
    out = []
    for name, node in tree.items():
        col = top(name)
        if node is not None:
            col = _keep(col, fields[name].dataType, node).alias(name, metadata=fields[name].metadata)
        out.append(col)
    return df.select(*out)


def _keep(col: Column, dtype: T.DataType, tree: dict) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _keep(x, dtype.elementType, tree))
    types = {f.name: f.dataType for f in dtype.fields}
    kept = []
    for name, node in tree.items():
        child = col.getField(name)
        kept.append((child if node is None else _keep(child, types[name], node)).alias(name))
    return F.when(col.isNotNull(), F.struct(*kept))


def nodes(schema: T.StructType, at: tuple[str, ...] = ()) -> Iterable[tuple[tuple[str, ...], T.DataType]]:
    """Every named node below a schema, parents first; steps into arrays, not into maps."""
    for f in schema.fields:
        yield at + (f.name,), f.dataType
        inner = f.dataType
        while isinstance(inner, T.ArrayType):
            inner = inner.elementType
        if isinstance(inner, T.StructType):
            yield from nodes(inner, at + (f.name,))
