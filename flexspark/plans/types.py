"""Type names, choice types, schema merging and the JSON form of a schema.

A *choice* is a place in the data where several types were seen. In a DataFrame it is a ``VARIANT``
column; in a schema it is :class:`Choice`, which lists the alternatives by type name.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import types as T

# Names used in mappings, specs and schema JSON, with the Spark type each one stands for.
ATOMIC_TYPES = {
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "byte": T.ByteType(),
    "date": T.DateType(),
    "decimal": T.DecimalType(10, 2),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "null": T.NullType(),
    "short": T.ShortType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "unknown": T.NullType(),
}

_NAMES = {
    T.BinaryType: "binary",
    T.BooleanType: "boolean",
    T.ByteType: "byte",
    T.DateType: "date",
    T.DecimalType: "decimal",
    T.DoubleType: "double",
    T.FloatType: "float",
    T.IntegerType: "int",
    T.LongType: "long",
    T.NullType: "null",
    T.ShortType: "short",
    T.StringType: "string",
    T.TimestampType: "timestamp",
    T.TimestampNTZType: "timestamp_ntz",
    T.ArrayType: "array",
    T.MapType: "map",
    T.StructType: "struct",
    T.VariantType: "choice",
}


class Choice(T.DataType):
    """Several alternative types in one place, at most one per type name."""

    def __init__(self, options: Iterable[T.DataType]):
        self.options: dict[str, T.DataType] = {}
        for option in options:
            name = type_name(option)
            if name in self.options:
                raise ValueError(f"duplicate alternative {name} in a choice")
            self.options[name] = option

    def simpleString(self) -> str:
        return "choice<" + ",".join(self.options[n].simpleString() for n in sorted(self.options)) + ">"

    def __repr__(self) -> str:
        return self.simpleString()

    def __eq__(self, other) -> bool:
        return isinstance(other, Choice) and self.options == other.options

    def __hash__(self) -> int:
        return hash(tuple(sorted(self.options)))


def type_name(dtype: T.DataType) -> str:
    if isinstance(dtype, Choice):
        return "choice"
    for cls, name in _NAMES.items():
        if isinstance(dtype, cls):
            return name
    return dtype.typeName()


def parse_type(text: str | T.DataType) -> T.DataType:
    """Type from a short name (``long``, ``decimal`` = decimal(10,2)) or any Spark DDL type string."""
    if isinstance(text, T.DataType):
        return text
    known = ATOMIC_TYPES.get(text.strip().lower())
    return known if known is not None else T.DataType.fromDDL(text)


def merge_types(left: T.DataType, right: T.DataType) -> T.DataType:
    """Smallest schema that covers both sides. Pure: neither input is changed.

    Null gives way to anything. Different kinds, also two integer widths, become a :class:`Choice`; the same
    kind merges inside (struct fields keep the left order, new right fields follow) and otherwise keeps the left.
    """
    if isinstance(left, T.NullType):
        return right
    if isinstance(right, T.NullType):
        return left
    if isinstance(left, Choice) or type_name(left) != type_name(right):
        merged = dict(left.options) if isinstance(left, Choice) else {type_name(left): left}
        for name, option in (right.options if isinstance(right, Choice) else {type_name(right): right}).items():
            merged[name] = merge_types(merged[name], option) if name in merged else option
        return Choice(merged.values())
    if isinstance(left, T.StructType):
        theirs = {f.name: f for f in right.fields}
        ours = {f.name for f in left.fields}
        shared = [_merge_fields(f, theirs[f.name]) if f.name in theirs else f for f in left.fields]
        return T.StructType(shared + [f for f in right.fields if f.name not in ours])
    if isinstance(left, T.ArrayType):
        return T.ArrayType(merge_types(left.elementType, right.elementType))
    if isinstance(left, T.MapType):
        return T.MapType(left.keyType, merge_types(left.valueType, right.valueType))
    return left


def _merge_fields(left: T.StructField, right: T.StructField) -> T.StructField:
    metadata = dict(left.metadata or {})
    options = (right.metadata or {}).get("enum")
    if "enum" in metadata and options:
        metadata["enum"] = metadata["enum"] + [o for o in options if o not in metadata["enum"]]
    if metadata.get("set") and (right.metadata or {}).get("set"):
        return T.StructField(left.name, left.dataType, True, metadata)
    return T.StructField(left.name, merge_types(left.dataType, right.dataType), True, metadata)


def to_spark(dtype: T.DataType) -> T.DataType:
    """Storage form: every choice becomes VARIANT."""
    if isinstance(dtype, Choice):
        return T.VariantType()
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, to_spark(f.dataType), True, f.metadata) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(to_spark(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, to_spark(dtype.valueType))
    return dtype


def contains(dtype: T.DataType, cls: type) -> bool:
    if isinstance(dtype, cls):
        return True
    if isinstance(dtype, T.StructType):
        return any(contains(f.dataType, cls) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return contains(dtype.elementType, cls)
    if isinstance(dtype, T.MapType):
        return contains(dtype.valueType, cls)
    return False


# --------------------------------------------------------------------------------------------- JSON form

def schema_to_json(dtype: T.DataType) -> str:
    """Schema as JSON: ``{"dataType": ..., "properties": {...}, ...}`` per node."""
    return json.dumps(_node(dtype, {}))


def _node(dtype: T.DataType, properties: dict) -> dict:
    rest = {k: v for k, v in properties.items() if k not in ("enum", "set")}
    out = {"dataType": type_name(dtype), "properties": rest}
    if isinstance(dtype, T.StructType):
        out["fields"] = [
            {"name": f.name, "container": _node(f.dataType, f.metadata or {}), "properties": {}} for f in dtype.fields
        ]
    elif isinstance(dtype, Choice):
        out["choices"] = [_node(o, {}) for o in dtype.options.values()]
    elif isinstance(dtype, T.ArrayType):
        out["dataType"] = "set" if properties.get("set") else "array"
        out["elementType"] = _node(dtype.elementType, {})
    elif isinstance(dtype, T.MapType):
        out["valueType"] = _node(dtype.valueType, {})
    elif isinstance(dtype, T.DecimalType):
        out["precision"], out["scale"] = dtype.precision, dtype.scale
    elif isinstance(dtype, T.StringType) and "enum" in properties:
        out["dataType"], out["options"] = "enum", list(properties["enum"])
    return out


def schema_from_json(text: str) -> T.DataType:
    return _from_node(json.loads(text))[0]


def _from_node(node: dict) -> tuple[T.DataType, dict]:
    kind, properties = node["dataType"], dict(node.get("properties") or {})
    if kind == "struct":
        fields = []
        for f in node["fields"]:
            dtype, metadata = _from_node(f["container"])
            fields.append(T.StructField(f["name"], dtype, True, {**(f.get("properties") or {}), **metadata}))
        return T.StructType(fields), properties
    if kind == "choice":
        return Choice(_from_node(o)[0] for o in node["choices"]), properties
    if kind in ("array", "set"):
        extra = {"set": True} if kind == "set" else {}
        return T.ArrayType(_from_node(node["elementType"])[0]), {**properties, **extra}
    if kind == "map":
        return T.MapType(T.StringType(), _from_node(node["valueType"])[0]), properties
    if kind == "decimal":
        return T.DecimalType(node.get("precision", 10), node.get("scale", 2)), properties
    if kind == "enum":
        return T.StringType(), {**properties, "enum": list(node["options"])}
    return parse_type(kind), properties
