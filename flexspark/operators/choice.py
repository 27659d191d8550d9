"""Resolve choices (VARIANT nodes holding several types) and drop fields that hold nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.plans.discover import choice_paths, discover, extract, variant_paths
from flexspark.plans.nested import drop_paths, edit_fields, nodes
from flexspark.plans.paths import crosses_array, join_path, resolve, split_path, top, value_at
from flexspark.plans.types import Choice, parse_type, schema_from_json, to_spark, type_name

# The actions of a resolve spec; the first two take a type after a colon.
ACTIONS = ["cast", "project", "make_struct", "make_cols", "match_catalog"]


class ResolveOption(NamedTuple):
    """How to resolve one path on the way to a plain DataFrame: ``KeepAsStruct``, ``Project`` or ``Cast``."""

    path: str
    action: str
    target: str | T.DataType | None = None


def alternatives(df: DataFrame, path: str) -> list[T.DataType]:
    """Types seen at a VARIANT path: from column metadata when discovery left them there, else by one pass."""
    names, _ = resolve(df.schema, path)
    known = (df.schema[names[0]].metadata or {}).get("choices", {}).get(join_path(names[1:]))
    if known is not None:
        return [schema_from_json(k) for k in known]
    found = discover(df, [join_path(names)])[join_path(names)]
    options = found.options.values() if isinstance(found, Choice) else [found]
    return [o for o in options if not isinstance(o, T.NullType)]


def is_kind(kind: Column, dtype: T.DataType, others: Iterable[T.DataType] = ()) -> Column:
    """True where ``schema_of_variant`` names this type; ``others`` are the alternatives it is told apart from."""
    names = {type_name(o) for o in others}
    if isinstance(dtype, T.StructType):
        return kind.startswith("OBJECT<")
    if isinstance(dtype, T.ArrayType):
        return kind.startswith("ARRAY<")
    if isinstance(dtype, T.DecimalType):
        return kind.startswith("DECIMAL(")
    if isinstance(dtype, T.DoubleType) and "decimal" not in names:
        return (kind == "DOUBLE") | kind.startswith("DECIMAL(")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return kind == "BIGINT"
    return kind == type_name(dtype).upper()


def _cast(col: Column, dtype: T.DataType, target: T.DataType) -> Column:
    """Value converted to the target, null where that fails. Objects and arrays turned to text become JSON."""
    if not isinstance(dtype, T.VariantType):
        return col.try_cast(target)
    if isinstance(target, T.StringType):
        nested = F.schema_of_variant(col).rlike("^(OBJECT|ARRAY)<")
        return F.when(nested, F.to_json(col)).otherwise(F.try_variant_get(col, "$", "string"))
    return extract(col, "$", target)


def _at_variant(col: Column, dtype: T.DataType, f: Callable[[Column, T.DataType], Column]) -> Column:
    """Apply to the value, or to every element when the node is an array of choices."""
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _at_variant(x, dtype.elementType, f))
    return f(col, dtype)


def _inner(dtype: T.DataType) -> T.DataType:
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return dtype


def resolve_choice(
    df: DataFrame,
    specs: Iterable[tuple[str, str]] | None = None,
    choice: str = "",
    catalog_schema: T.StructType | None = None,
) -> DataFrame:
    """Resolve by specs ``(path, action)``, or every choice by one default action; exactly one of the two.

    ``cast:T`` converts, ``project:T`` keeps only values of type T, ``make_struct`` gives a struct with one field
    per type, ``make_cols`` one column ``<name>_<type>`` per type, ``match_catalog`` takes the types of a table.
    """
    specs = [tuple(s) for s in specs] if specs else []
    if bool(specs) == bool(choice):
        raise ValueError("give either specs or a default choice")
    if choice.lower() == "match_catalog":
        if catalog_schema is None:
            raise ValueError("match_catalog needs the database and table to match")
        return match_schema(df, catalog_schema)
    if choice:
        specs = [(p, choice) for p in variant_paths(df)]
    edits, notes, described = {}, {}, {}
    for path, action in specs:
        edits[path] = _edit(df, path, action, notes, described)
    if not edits:
        return df
    if not described:
        return _note(edit_fields(df, edits), notes)
    # Describing a value costs as much as reading it. The one-element explode does it once per row, where the same
    # expression inside several conditions would be evaluated for each of them.
    kinds = F.struct(*[F.schema_of_variant(value_at(df.schema, p)).alias(n) for p, n in described.items()])
    widened = df.select("*", F.explode(F.array(kinds)).alias(_KINDS))
    return _note(edit_fields(widened, edits).drop(_KINDS), notes)


_KINDS = "__kinds"


def _edit(df: DataFrame, path: str, action: str, notes: dict, described: dict[str, str]):
    verb, _, target = action.partition(":")
    verb = verb.strip().lower()
    if verb not in ACTIONS[:4] or bool(target) != (verb in ACTIONS[:2]):
        raise ValueError(f"unknown resolve action {action!r}")
    names, dtype = resolve(df.schema, path)
    if verb == "cast":
        to = parse_type(target)
        return lambda c, f: [(f.name, _at_variant(c, f.dataType, lambda x, t: _cast(x, t, to)))]
    if verb == "project":
        to = parse_type(target)
        return lambda c, f: [(f.name, _at_variant(c, f.dataType, lambda x, t: _project(x, t, to)))]
    if not isinstance(_inner(dtype), T.VariantType):
        return lambda c, f: [(f.name, c)]
    options = alternatives(df, path)
    kind = None
    if isinstance(dtype, T.VariantType) and not crosses_array(df.schema, names):
        described[path] = f"k{len(described)}"
        kind = top(_KINDS).getField(described[path])
    if verb == "make_cols":
        for o in options:
            spot = names[:-1] + (f"{names[-1]}_{type_name(o)}",)
            _remember(notes, spot, o)
        return lambda c, f: [
            (f"{f.name}_{type_name(o)}", _at_variant(c, f.dataType, _only(o, options, kind))) for o in options
        ]
    for o in options:
        _remember(notes, names + (type_name(o),), o)
    return lambda c, f: [(f.name, _at_variant(c, f.dataType, lambda x, t: _one_field_each(x, options, kind)))]


def _project(col: Column, dtype: T.DataType, target: T.DataType) -> Column:
    if not isinstance(dtype, T.VariantType):
        return col if dtype == target else col.try_cast(target)
    return F.when(is_kind(F.schema_of_variant(col), target), extract(col, "$", target))


def _only(option: T.DataType, options: list[T.DataType], kind: Column | None):
    return lambda x, t: F.when(
        is_kind(F.schema_of_variant(x) if kind is None else kind, option, options), extract(x, "$", option)
    )


def _one_field_each(col: Column, options: list[T.DataType], kind: Column | None) -> Column:
    fields = [_only(o, options, kind)(col, None).alias(type_name(o)) for o in options]
    return F.when(col.isNotNull(), F.struct(*fields)) if fields else F.lit(None)


def _remember(notes: dict, names: tuple[str, ...], option: T.DataType) -> None:
    """Keep what is known about choices nested inside one alternative."""
    for sub, kinds in choice_paths(option).items():
        full = names[1:] + (split_path(sub) if sub else ())
        notes.setdefault(names[0], {})[join_path(full)] = kinds


def _note(df: DataFrame, notes: dict[str, dict[str, list[str]]]) -> DataFrame:
    for name, more in notes.items():
        metadata = dict(df.schema[name].metadata or {})
        metadata["choices"] = {**metadata.get("choices", {}), **more}
        df = df.withMetadata(name, metadata)
    return df


def match_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring every column that the schema names to the type given there; other columns stay."""
    targets = {f.name.lower(): f.dataType for f in schema.fields}
    out = []
    for f in df.schema.fields:
        target = targets.get(f.name.lower())
        if target is None or f.dataType == target:
            out.append(top(f.name))
        else:
            out.append(_cast(top(f.name), f.dataType, target).alias(f.name))
    return df.select(*out)


def to_plain(df: DataFrame, options: Iterable[ResolveOption] = ()) -> DataFrame:
    """DataFrame without choices: by the given options, what is left over as structs with one field per type."""
    specs = []
    for o in options:
        action = o.action.lower()
        if action == "keepasstruct":
            specs.append((o.path, "make_struct"))
        elif action in ("project", "cast"):
            if o.target is None:
                raise ValueError(f"{o.action} needs a target type")
            specs.append((o.path, f"{action}:{parse_type(o.target).simpleString()}"))
        else:
            raise ValueError(f"unknown resolve action {o.action!r}")
    if specs:
        df = resolve_choice(df, specs)
    while left := variant_paths(df):
        df = resolve_choice(df, [(p, "make_struct") for p in left])
    return df


def typed_alternatives(df: DataFrame, path: str) -> list[T.DataType]:
    """Storage types of the alternatives at a path."""
    return [to_spark(o) for o in alternatives(df, path)]


def drop_null_fields(df: DataFrame) -> DataFrame:
    """Drop fields whose type is null, in structs and arrays of structs too; arrays of null stay."""
    return drop_paths(df, [join_path(names) for names, dtype in nodes(df.schema) if isinstance(dtype, T.NullType)])
