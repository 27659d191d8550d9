"""Schema discovery over VARIANT columns: every path with every type seen there.

``schema_of_variant`` describes one value inside the JVM. Each round reduces the data to the distinct
descriptions (combined map-side, so hot shapes cost nothing), takes those apart in Python tasks, and brings
only distinct (path, type) pairs to the driver: as many as the schema has nodes, whatever the data size. Objects
whose keys are data, not field names, would make a node of each key: name them in ``as_map``, and all their values
are one node.

Inside one array ``schema_of_variant`` folds element types together (mixed kinds to VARIANT, integers and
decimals to one decimal). Where that may have hidden a conflict the next round describes the elements one by
one, still without exploding rows: ``array_distinct(transform(elements, schema_of_variant))``.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.plans.nested import nodes
from flexspark.plans.paths import join_path, quote, segments, top, value_at
from flexspark.plans.types import Choice, contains, schema_to_json, to_spark, type_name

# Scalar names in schema_of_variant output.
_SCALARS = {
    "BIGINT": T.LongType(),
    "BINARY": T.BinaryType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "VOID": T.NullType(),
}
_FOLDED = {"VARIANT", "DOUBLE"}
_ITEM, _VALUE = "[]", "{}"
_TOKEN = re.compile(r"OBJECT<|ARRAY<|>|, |: |`(?:[^`]|``)*`|[^<>,:`(]+(?:\([^)]*\))?")

Step = tuple[str, ...]
_PAIRS = pa.schema([("i", pa.int32()), ("path", pa.string()), ("kind", pa.string())])


def describe(col: Column) -> Column:
    """Type description of a variant with decimal precisions levelled to DOUBLE: they differ per value in JSON."""
    return F.regexp_replace(F.schema_of_variant(col), r"(^|: |<)DECIMAL\([0-9]+,[0-9]+\)", "$1DOUBLE")


def _take_apart(text: str) -> list[tuple[Step, str]]:
    """(path, kind) for every node of one description; a field step starts with '.', an element step is '[]'."""
    found: list[tuple[Step, str]] = []
    stack: list[tuple[Step, str]] = []
    at: Step = ()
    name = None
    for token in _TOKEN.findall(text):
        if token in ("OBJECT<", "ARRAY<"):
            found.append((at, token[:-1]))
            stack.append((at, token))
            name = None
            if token == "ARRAY<":
                at = at + (_ITEM,)
        elif token == ">":
            at, _ = stack.pop()
        elif token == ", ":
            at = stack[-1][0]
        elif token == ": ":
            at = stack[-1][0] + ("." + name,)
            name = None
        elif stack and stack[-1] == (at, "OBJECT<") and name is None:
            name = token[1:-1].replace("``", "`") if token.startswith("`") else token
        else:
            found.append((at, token))
    return found


def _pairs(maps: list[set[Step]]):
    """Function from Arrow batches of (root, description) to distinct (root, path, kind) rows; ``maps``: each root's paths of maps."""

    def run(batches):
        for batch in batches:
            rows = {
                (i, json.dumps(_merged(path, maps[i])), kind)
                for i, s in zip(batch.column("i").to_pylist(), batch.column("s").to_pylist())
                for path, kind in _take_apart(s)
            }
            yield pa.RecordBatch.from_pylist([{"i": i, "path": p, "kind": k} for i, p, k in sorted(rows)], _PAIRS)

    return run


def _merged(path: Step, maps: set[Step]) -> Step:
    """Path with one step for all keys of a map."""
    out: Step = ()
    for step in path:
        out = out + (_VALUE if out in maps and step != _ITEM else step,)
    return out


def _steps(path: str) -> Step:
    """Steps of a path inside variant values; ``[]`` enters array elements, ``{}`` a map's values."""
    return tuple(s for name, arrays in segments(path) for s in [*_split_suffix(name), *[_ITEM] * arrays])


def _split_suffix(name: str) -> list[str]:
    bare = name.rstrip("{}") if name.endswith(_VALUE) else name
    return ["." + bare, *[_VALUE] * ((len(name) - len(bare)) // 2)]


def variant_paths(df: DataFrame) -> list[str]:
    """Paths of all VARIANT columns and nested VARIANT fields."""
    return [
        join_path(names)
        for names, dtype in nodes(df.schema)
        if isinstance(dtype, T.VariantType) or _variant_items(dtype)
    ]


def _variant_items(dtype: T.DataType) -> bool:
    layers = 0
    while isinstance(dtype, T.ArrayType):
        dtype, layers = dtype.elementType, layers + 1
    return layers > 0 and isinstance(dtype, T.VariantType)


def discover(df: DataFrame, paths: list[str] | None = None, as_map: Iterable[str] = ()) -> dict[str, T.DataType]:
    """Type of every given VARIANT path, as a Spark type or :class:`Choice`.

    Objects at the ``as_map`` paths, which lead from a variant's root (``a.b``, ``lines[].c``, ``m{}.d``), become maps.
    """
    maps = {_steps(p) for p in as_map}
    paths = variant_paths(df) if paths is None else paths
    if not paths:
        return {}
    seen: dict[tuple[int, Step], set[str]] = defaultdict(set)
    todo: list[tuple[int, Step]] = [(i, ()) for i in range(len(paths))]
    while todo:
        described = [_descriptions(df, paths[i], steps) for i, steps in todo]
        rows = (
            df.select(F.inline(F.concat(*[_tagged(d, n) for n, d in enumerate(described)])))
            .where("s is not null")
            .distinct()
            .mapInArrow(_pairs([{m[len(s):] for m in maps if m[: len(s)] == s} for _, s in todo]), "i int, path string, kind string")
            .distinct()
            .collect()
        )
        todo = _record(seen, todo, [(r.i, tuple(json.loads(r.path)), r.kind) for r in rows])
    below: dict[tuple[int, Step], set[str]] = defaultdict(set)
    for i, at in seen:
        for n in range(len(at)):
            below[i, at[:n]].add(at[n])
    return {p: _assemble(seen, below, maps, i, ()) for i, p in enumerate(paths)}


def _tagged(descriptions: Column, n: int) -> Column:
    tagged = F.transform(descriptions, lambda s: F.struct(F.lit(n).alias("i"), s.alias("s")))
    return F.coalesce(tagged, F.array().cast("array<struct<i:int,s:string>>"))


def _record(seen, todo, rows) -> list[tuple[int, Step]]:
    """File the pairs of one round; return the arrays whose elements must be described one by one."""
    again: set[tuple[int, Step]] = set()
    kinds: dict[int, dict[Step, set[str]]] = defaultdict(lambda: defaultdict(set))
    for n, path, kind in rows:
        kinds[n][path].add(kind)
    for n, by_path in kinds.items():
        root, base = todo[n]
        folded = {
            path[: path.index(_ITEM)]
            for path, found in by_path.items()
            if _ITEM in path and found & _FOLDED
        }
        for path, found in by_path.items():
            if _ITEM in path and path[: path.index(_ITEM)] in folded:
                continue
            seen[root, base + path] |= found
        again |= {(root, base + path + (_ITEM,)) for path in folded}
    return sorted(again)


def _descriptions(df: DataFrame, path: str, steps: Step) -> Column:
    """Array of distinct descriptions of the values at ``steps`` below a VARIANT path, per row."""
    col = value_at(df.schema, path)
    dtype = df.select(col.alias("c")).schema["c"].dataType
    many = isinstance(dtype, T.ArrayType)
    while many and isinstance(dtype.elementType, T.ArrayType):
        col, dtype = F.flatten(col), dtype.elementType
    leg: list[str] = []
    for step in steps:
        if step not in (_ITEM, _VALUE):
            leg.append(step[1:])
            continue
        items, leg = _items_at(json_path(leg), step), []
        col, many = (F.flatten(F.transform(col, items)) if many else items(col)), True
    if not many:
        return F.array(describe(col))
    return F.array_distinct(F.transform(col, describe))


def _items_at(where: str, step: str):
    """Function from a variant to the elements, or a map's values, at a path in it; empty when there are none."""
    got = (lambda e: F.try_variant_get(e, where, "array<variant>")) if step == _ITEM else (lambda e: F.map_values(F.try_variant_get(e, where, "map<string,variant>")))
    return lambda e: F.coalesce(got(e), F.array().cast("array<variant>"))


def json_path(names: list[str]) -> str:
    """Variant path for a list of keys."""
    out = "$"
    for name in names:
        if re.fullmatch(r"[A-Za-z_]\w*", name):
            out += "." + name
        elif "'" not in name:
            out += f"['{name}']"
        elif '"' not in name:
            out += f'["{name}"]'
        else:
            raise ValueError(f"a key may not hold both kinds of quotes: {name!r}")
    return out


def _assemble(seen, below, maps: set[Step], root: int, at: Step) -> T.DataType:
    """Type at a path from the kinds recorded there; ``below`` has the next steps of each path."""
    inner = lambda step: _assemble(seen, below, maps, root, at + (step,))
    options: dict[str, T.DataType] = {}
    for kind in seen.get((root, at), ()):
        if kind == "OBJECT" and at in maps:
            dtype = T.MapType(T.StringType(), inner(_VALUE))
        elif kind == "OBJECT":
            dtype = T.StructType([T.StructField(s[1:], inner(s)) for s in sorted(below.get((root, at), ())) if s not in (_ITEM, _VALUE)])
        elif kind == "ARRAY":
            dtype = T.ArrayType(inner(_ITEM))
        else:
            dtype = T.DoubleType() if kind.startswith("DECIMAL") else _SCALARS[kind]
        options[type_name(dtype)] = dtype
    options.pop("null", None)
    if not options:
        return T.NullType()
    found = [options[n] for n in sorted(options)]
    return found[0] if len(found) == 1 else Choice(found)


# ----------------------------------------------------------------------------------------------- typed form

def choice_paths(dtype: T.DataType, at: tuple[str, ...] = ()) -> dict[str, list[str]]:
    """Choices below a type: path (empty for the node itself) to every alternative as schema JSON."""
    if isinstance(dtype, Choice):
        return {join_path(at): [schema_to_json(o) for o in dtype.options.values()]}
    if isinstance(dtype, T.ArrayType):
        return choice_paths(dtype.elementType, at)
    if isinstance(dtype, T.MapType):
        return choice_paths(dtype.valueType, at)
    out = {}
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            out.update(choice_paths(f.dataType, at + (f.name,)))
    return out


def from_variant(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Typed columns in place of one VARIANT column of objects; choices stay VARIANT, noted in column metadata."""
    out = []
    for name in df.columns:
        if name != column:
            out.append(top(name))
            continue
        for f in schema.fields:
            value = extract(top(column), json_path([f.name]), f.dataType)
            choices = choice_paths(f.dataType)
            metadata = {**(f.metadata or {}), **({"choices": choices} if choices else {})}
            out.append(value.alias(f.name, metadata=metadata))
    return df.select(*out)


def extract(variant: Column, where: str, dtype: T.DataType) -> Column:
    """Value at a variant path as a typed column; null where the value has another shape."""
    if isinstance(dtype, T.NullType):
        return F.lit(None)
    target = to_spark(dtype)
    return _restore_void(F.try_variant_get(variant, where, _no_void(target).simpleString()), target)


def _no_void(dtype: T.DataType) -> T.DataType:
    """VARIANT in place of void, which cannot be read out of a variant."""
    if isinstance(dtype, T.NullType):
        return T.VariantType()
    if isinstance(dtype, T.StructType):
        return _Quoted([T.StructField(f.name, _no_void(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_no_void(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, _no_void(dtype.valueType))
    return dtype


class _Quoted(T.StructType):
    """Struct whose DDL quotes every name, so names with blanks or dots survive."""

    def simpleString(self) -> str:
        return "struct<" + ",".join(f"{quote(f.name)}:{f.dataType.simpleString()}" for f in self.fields) + ">"


def _restore_void(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.NullType):
        return F.lit(None)
    if not contains(dtype, T.NullType):
        return col
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _restore_void(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda k, v: _restore_void(v, dtype.valueType))
    return F.when(
        col.isNotNull(),
        F.struct(*[_restore_void(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]),
    )


def frame_schema(df: DataFrame) -> T.StructType:
    """Schema of a frame with every VARIANT replaced by what it holds; one pass per nesting level of arrays."""
    found = discover(df)

    def fill(dtype: T.DataType, at: tuple[str, ...]) -> T.DataType:
        if isinstance(dtype, T.VariantType):
            return found[join_path(at)]
        if isinstance(dtype, T.ArrayType):
            return T.ArrayType(fill(dtype.elementType, at))
        if isinstance(dtype, T.StructType):
            return T.StructType([T.StructField(f.name, fill(f.dataType, at + (f.name,)), True, f.metadata) for f in dtype.fields])
        return dtype

    return fill(df.schema, ())
