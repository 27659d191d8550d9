"""Dotted paths to columns and nested fields.

``a.b.c`` walks structs; an array of structs on the way is stepped into, with or without a trailing ``[]``
(``lines.qty`` and ``lines[].qty`` are the same node). A name that itself holds a dot goes in backticks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SEGMENT = re.compile(r"\s*(?:`((?:[^`]|``)+)`|([^.`]+?))((?:\[\])*)\s*(?:\.|$)")


def as_list(value) -> list:
    """A single string counts as a one-element list."""
    return [value] if isinstance(value, str) else list(value)


def split_path(path: str) -> tuple[str, ...]:
    """Cut a path into names; array marks are dropped because the schema already tells where arrays are."""
    return tuple(name for name, _ in segments(path))


def segments(path: str) -> list[tuple[str, int]]:
    """(name, number of array marks) of each part of a path."""
    found, at = [], 0
    while at < len(path):
        m = _SEGMENT.match(path, at)
        if not m:
            raise ValueError(f"not a field path: {path!r}")
        name = m.group(1).replace("``", "`") if m.group(1) is not None else m.group(2)
        found.append((name, len(m.group(3)) // 2))
        at = m.end()
    if not found or path.endswith("."):
        raise ValueError(f"not a field path: {path!r}")
    return found


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def join_path(names: Iterable[str]) -> str:
    """Inverse of :func:`split_path`: quote only the names that need it."""
    return ".".join(n if re.fullmatch(r"\w+", n) else quote(n) for n in names)


def top(name: str) -> Column:
    """Column for a top-level name, whatever characters it holds."""
    return F.col(quote(name))


def find_field(struct: T.StructType, name: str, case_sensitive: bool = False) -> T.StructField | None:
    """Exact name first, then a case-insensitive match unless ``case_sensitive``."""
    for f in struct.fields:
        if f.name == name:
            return f
    if not case_sensitive:
        for f in struct.fields:
            if f.name.lower() == name.lower():
                return f
    return None


def element_of(dtype: T.DataType) -> tuple[T.DataType, int]:
    """Strip array layers: the innermost element type and how many layers were removed."""
    depth = 0
    while isinstance(dtype, T.ArrayType):
        dtype, depth = dtype.elementType, depth + 1
    return dtype, depth


def resolve(schema: T.StructType, path: str, case_sensitive: bool = False) -> tuple[tuple[str, ...], T.DataType]:
    """Spell a path as the schema spells it and return the node's type. Raises ``ValueError`` when absent."""
    names, node = [], schema
    for part in split_path(path):
        node, _ = element_of(node)
        found = find_field(node, part, case_sensitive) if isinstance(node, T.StructType) else None
        if found is None:
            raise ValueError(f"no field {path!r} in {schema.simpleString()[:500]}")
        names.append(found.name)
        node = found.dataType
    return tuple(names), node


def crosses_array(schema: T.StructType, names: tuple[str, ...]) -> bool:
    """True when some proper ancestor of the node is an array."""
    node = schema
    for part in names[:-1]:
        node = find_field(element_of(node)[0], part, True).dataType
        if isinstance(node, T.ArrayType):
            return True
    return False


def value_at(schema: T.StructType, path: str, case_sensitive: bool = False) -> Column:
    """Column reading one node. Below an array of structs this is the array of the nodes."""
    names, _ = resolve(schema, path, case_sensitive)
    node, col, depth = schema, None, 0
    for part in names:
        node = find_field(element_of(node)[0], part, True).dataType
        col = top(part) if col is None else col.getField(part)
        if depth and isinstance(node, T.ArrayType):
            col = F.flatten(col)
        inner, layers = element_of(node)
        for _ in range(layers - 1 if isinstance(inner, T.StructType) else 0):
            col = F.flatten(col)
        depth += layers
    return col
