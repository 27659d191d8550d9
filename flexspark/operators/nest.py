"""Flatten nested data, pivot arrays into their own tables, nest rows, open boxed text."""

from __future__ import annotations

import csv
import io
import json
import operator
from collections.abc import Iterable
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.operators.records import keep
from flexspark.plans.discover import choice_paths, discover, extract
from flexspark.plans.nested import edit_fields
from flexspark.plans.paths import as_list, crosses_array, join_path, resolve, top, value_at
from flexspark.plans.types import contains
from flexspark.sources.scratch import stage

KEY = "__row_key"
FILE_ROW = "_metadata"  # as key_cols: the place of a row in its Parquet file


# ------------------------------------------------------------------------------------ unnest, relationalize

def unnest(df: DataFrame, key_cols: str | Iterable[str] | None = None, staging_path: str | None = None) -> DataFrame:
    """Nested structs as top-level columns named by their path; every array becomes the key of its rows.

    The key is taken from ``key_cols`` when the rows have one; otherwise rows are numbered, which needs one
    written copy (below ``staging_path``, else the session's shared folder) so that the numbers never change. Rows of Parquet
    files need neither: ``key_cols=FILE_ROW`` takes their file and place in it.
    """
    arrays = any(isinstance(t, (T.ArrayType, T.MapType)) for _, t in _leaves(df.schema))
    if not arrays:
        return df.select(*[c.alias(n) for n, c, _ in _flat(df.schema, None)])
    keyed = _with_key(df, key_cols, staging_path)
    return _table(keyed, _inner_schema(keyed), None, top(KEY))


def relationalize(
    df: DataFrame,
    root: str = "roottable",
    staging_path: str | None = None,
    key_cols: str | Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """Root table plus one table per array, joined by ``root.<array> = child.id``.

    Children have ``id``, ``index`` and ``val`` or ``val.<field>``; a null array gives a null key, an empty one a
    key without rows. Maps count as arrays of (key, value). Every table is a narrow projection of the keyed
    frame: no shuffle and no collected group, however long one array is. With ``staging_path`` the keyed frame is written there
    once, so that many tables do not read and parse the source as often. ``key_cols=FILE_ROW`` is for frames read from Parquet files whose
    rows were selected and filtered only, neither joined nor exploded: their file and place is the key, and nothing runs before an action.
    """
    if key_cols is None and staging_path is None:
        raise RuntimeError("relationalize needs key_cols or a staging_path")
    keyed = _with_key(df, key_cols, staging_path)
    if key_cols is not None and staging_path is not None:
        keyed = stage(keyed, "keyed", staging_path)
    tables = {root: _table(keyed, _inner_schema(keyed), None, top(KEY))}
    _pivot(tables, keyed, _inner_schema(keyed), None, top(KEY), root)
    return tables


def _with_key(df: DataFrame, key_cols, staging_path) -> DataFrame:
    """Frame with a key no two rows share. Key columns that repeat or hold nulls get the row's number in a staged copy besides."""
    if key_cols == FILE_ROW:
        return _with_file_row(df)
    if key_cols is None:
        return stage(df.withColumn(KEY, F.monotonically_increasing_id()), "keyed", staging_path)
    cols = [value_at(df.schema, c).alias(f"k{i}") for i, c in enumerate(as_list(key_cols))]
    counted = df.select(*cols).groupBy(*[f"k{i}" for i in range(len(cols))]).agg(F.count("*").alias("n"))
    missing = reduce(operator.or_, [F.col(f"k{i}").isNull() for i in range(len(cols))])
    if counted.where((F.col("n") > 1) | missing).isEmpty():
        return df.withColumn(KEY, cols[0] if len(cols) == 1 else F.to_json(F.struct(*cols)))
    numbered = F.to_json(F.struct(*cols, F.monotonically_increasing_id().alias("row")))
    return stage(df.withColumn(KEY, numbered), "keyed", staging_path)


def _with_file_row(df: DataFrame) -> DataFrame:
    if FILE_ROW in df.columns:
        raise ValueError(f"a column named {FILE_ROW} hides the files' rows")
    try:
        return df.withColumn(KEY, F.concat_ws(":", F.md5(F.col(f"{FILE_ROW}.file_path")), F.col(f"{FILE_ROW}.row_index")))
    except AnalysisException as e:
        raise ValueError("key_cols=FILE_ROW needs a frame read from Parquet files") from e


def _inner_schema(keyed: DataFrame) -> T.StructType:
    return T.StructType([f for f in keyed.schema.fields if f.name != KEY])


def _leaves(schema: T.StructType, at: tuple[str, ...] = ()):
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, at + (f.name,))
        else:
            yield at + (f.name,), f.dataType


def _flat(schema: T.StructType, base: Column | None):
    """(dotted name, column, type) of every leaf, structs opened."""
    for names, dtype in _leaves(schema):
        col = base
        for n in names:
            col = top(n) if col is None else col.getField(n)
        yield ".".join(names), col, dtype


def _table(df: DataFrame, schema: T.StructType, base: Column | None, key: Column, prefix: str = "", lead=()) -> DataFrame:
    out = list(lead)
    for name, col, dtype in _flat(schema, base):
        array = isinstance(dtype, (T.ArrayType, T.MapType))
        out.append((F.when(col.isNotNull(), key) if array else col).alias(prefix + name))
    return df.select(*out)


def _pivot(tables: dict, df: DataFrame, schema: T.StructType, base: Column | None, key: Column, name: str) -> None:
    for path, col, dtype in _flat(schema, base):
        if not isinstance(dtype, (T.ArrayType, T.MapType)):
            continue
        rows = F.map_entries(col) if isinstance(dtype, T.MapType) else col
        child = df.select(key.alias("id"), F.posexplode(rows).alias("index", "val"))
        inner = child.schema["val"].dataType
        child_key = F.concat_ws(".", top("id").cast("string"), top("index").cast("string"))
        table, lead = f"{name}_{path}", [top("id"), top("index")]
        if isinstance(inner, T.StructType):
            tables[table] = _table(child, inner, top("val"), child_key, "val.", lead)
            _pivot(tables, child, inner, top("val"), child_key, f"{table}.val")
        else:
            one = T.StructType([T.StructField("val", inner)])
            tables[table] = _table(child, one, None, child_key, "", lead)
            _pivot(tables, child, one, None, child_key, table)


# ----------------------------------------------------------------------------------------------- nest rows

def nest_rows(df: DataFrame, keys: str | Iterable[str], parts: int, items: str = "items", part: str = "part") -> DataFrame:
    """Whole rows collected into arrays of structs: one row (keys, part, items) for each part of a key that holds rows.

    ``parts`` is how many parts every key has: with 1 a key is one row; more keep a large key out of one task and one record.
    A row's part comes from the hash of all its columns that can be hashed, so it does not depend on the partitioning; equal rows
    share a part. Without keys the parts are of all rows. Readers that expand ``items`` need not look at ``part``.
    """
    if parts < 1:
        raise ValueError("parts must be 1 or more")
    keys = as_list(keys)
    hashed = [top(f.name) for f in df.schema.fields if not (contains(f.dataType, T.MapType) or contains(f.dataType, T.VariantType))]
    number = F.pmod(F.xxhash64(*hashed), F.lit(parts)).cast("int") if hashed and parts > 1 else F.lit(0)
    row = F.struct(*[top(c) for c in df.columns])
    salted = df.select(*[top(k).alias(f"__k{i}") for i, k in enumerate(keys)], number.alias("__part"), row.alias("__row"))
    by = [f"__k{i}" for i in range(len(keys))]
    listed = salted.groupBy(*by, "__part").agg(F.collect_list("__row").alias("__rows"))
    return listed.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.col("__part").alias(part), F.col("__rows").alias(items))


def parts_for(df: DataFrame, rows: int) -> int:
    """How many parts of ``nest_rows`` keep every part at about ``rows`` rows or fewer, even if all rows have one key. Counts the rows."""
    return df.count() // rows + 1


# -------------------------------------------------------------------------------------------------- unbox

def unbox(
    df: DataFrame,
    path: str,
    format: str,
    schema: T.DataType | str | None = None,
    separator: str = ",",
    escaper: str = "\\",
    skip_first: bool = False,
    with_header: bool = False,
    persist: bool = False,
    staging_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Parse the text at a path in place; rows whose text does not parse come back in the second frame.

    ``json`` with a schema gives it, without one VARIANT. ``csv`` gives a list with every record of the text: structs with a schema (by
    position, a header line is left out), else VARIANT objects keyed by the header line or by ``_c0, _c1, ...``; the latter is one
    Python call per text. ``schema`` may be Spark schema JSON, DDL or a type. A row with text inside an array that does
    not parse stays, with null there, and is reported too. ``persist`` or ``staging_path`` keep the parsed rows, so
    that the two frames are of one run. The parsed value goes through a one-element ``explode``: the
    filters on it then stay above it instead of parsing every text a second time.
    """
    format = format.lower()
    if format not in ("json", "csv"):
        raise ValueError(f"cannot unbox {format!r}: json and csv are supported here")
    names, dtype = resolve(df.schema, path)
    if not isinstance(dtype, T.StringType):
        raise ValueError(f"{path!r} is {dtype.simpleString()}, not text")
    schema = _schema_of(schema)

    def parse(text: Column) -> Column:
        if format == "json":
            return F.try_parse_json(text) if schema is None else _from_json(text, schema)
        if schema is None:
            return F.try_parse_json(csv_records(separator, escaper, skip_first, with_header)(text))
        options = {"sep": separator, "escape": escaper, "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": _BAD}
        ddl = _with_bad(schema).simpleString()
        lines = F.when(text.contains('"'), _unquoted_lines(text)).otherwise(F.split(text, "\r?\n"))
        if skip_first or with_header:
            lines = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
        return F.transform(F.filter(lines, lambda x: F.length(x) > 0), lambda x: F.from_csv(x, ddl, options))

    message = F.lit(f"cannot read {join_path(names)} as {format}").alias("error_message")
    record = F.to_json(F.struct(*[top(c) for c in df.columns])).alias("record")
    if crosses_array(df.schema, names):
        df = keep(df, persist, staging_path)
        opened = edit_fields(df, {path: lambda col, f: [(f.name, parse(col))]})
        good = edit_fields(opened, {path: lambda col, f: [(f.name, _without_bad(col, f.dataType))]})
        kind = df.select(F.lit("").alias("t")).select(parse(top("t")).alias("p")).schema["p"].dataType
        texts = value_at(df.schema, path)
        while isinstance(df.select(texts.alias("c")).schema["c"].dataType.elementType, T.ArrayType):
            texts = F.flatten(texts)
        return good, df.where(F.exists(texts, lambda t: t.isNotNull() & _unparsed(parse(t), kind))).select(message, record)
    text = value_at(df.schema, path)
    parsed = keep(df.select("*", F.explode(F.array(parse(text))).alias(_PARSED)), persist, staging_path)
    dtype = parsed.schema[_PARSED].dataType
    bad = text.isNotNull() & _unparsed(top(_PARSED), dtype)
    value = _without_bad(top(_PARSED), dtype)
    good = edit_fields(parsed.where(~bad), {path: lambda col, f: [(f.name, value)]}).drop(_PARSED)
    return good, parsed.where(bad).select(message, record)


def _unquoted_lines(text: Column) -> Column:
    """Lines of CSV text; a line break between double quotes does not end one. Every second part between quotes is quoted."""
    mark, own = "\u001e1", "\u001e0"  # the text's own mark characters are followed by 0 meanwhile
    parts = F.split(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\u001e"), F.lit(own)), '"')
    marked = F.transform(parts, lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit("\n"), F.lit(mark))).otherwise(p))
    return F.transform(F.split(F.array_join(marked, '"'), mark), lambda line: F.replace(line, F.lit(own), F.lit("\u001e")))


_PARSED = "__parsed"
_BAD = "__unparsed"


def _schema_of(schema) -> T.DataType | None:
    if schema is None or isinstance(schema, T.DataType):
        return schema
    if schema.lstrip().startswith("{"):
        return T.StructType.fromJson(json.loads(schema))
    return T.DataType.fromDDL(schema)


def _with_bad(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])


def _from_json(text: Column, schema: T.DataType) -> Column:
    if not isinstance(schema, T.StructType):
        return F.from_json(text, schema)
    return F.from_json(text, _with_bad(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})


def _unparsed(value: Column, dtype: T.DataType) -> Column:
    bad = value.isNull()
    if isinstance(dtype, T.StructType) and _BAD in dtype.names:
        bad = bad | value.getField(_BAD).isNotNull()
    elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType) and _BAD in dtype.elementType.names:
        bad = bad | F.exists(value, lambda x: x.getField(_BAD).isNotNull())
    return F.coalesce(bad, F.lit(True))


def _without_bad(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType) and _BAD in dtype.names:
        return col.dropFields(_BAD)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType) and _BAD in dtype.elementType.names:
        return F.transform(col, lambda x: x.dropFields(_BAD))
    return col


def csv_records(separator: str, escaper: str, skip_first: bool, with_header: bool):
    """Pandas UDF from CSV text to a JSON list of records, for text without a schema."""

    @F.pandas_udf(T.StringType())
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(one, na_action="ignore")

    def one(text: str) -> str | None:
        try:
            rows = list(csv.reader(io.StringIO(text), delimiter=separator, escapechar=escaper, strict=True))
        except csv.Error:
            return None
        names = rows[0] if with_header and rows else None
        body = rows[1:] if with_header or skip_first else rows
        return json.dumps([dict(zip(names or [f"_c{i}" for i in range(len(r))], r)) for r in body])

    return read


def open_variant(df: DataFrame, path: str, as_map: Iterable[str] = ()) -> DataFrame:
    """Give an unboxed VARIANT its discovered type, in place; objects at the ``as_map`` paths in it become maps."""
    found = discover(df, [path], as_map)[path]
    names, _ = resolve(df.schema, path)
    typed = edit_fields(df, {path: lambda col, f: [(f.name, extract(col, "$", found))]})
    choices = {join_path(names[1:] + ((sub,) if sub else ())): kinds for sub, kinds in choice_paths(found).items()}
    if not choices:
        return typed
    metadata = dict(typed.schema[names[0]].metadata or {})
    return typed.withMetadata(names[0], {**metadata, "choices": {**metadata.get("choices", {}), **choices}})


# --------------------------------------------------------------------------------------------- type tags

# Type tags that wrap every value in tagged JSON, one per wrapper object.
TAGS = ["S", "N", "BOOL", "NULL", "B", "L", "M", "SS", "NS", "BS"]
_NUMBER = T.DecimalType(38, 18)


def unnest_tagged_json(df: DataFrame) -> DataFrame:
    """Remove the type-tag wrappers (``{"N": "5"}`` becomes 5). A place with several tags becomes a choice."""
    return df.select(*[_untag(top(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _untag(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _untag(x, dtype.elementType))
    if not isinstance(dtype, T.StructType):
        return col
    if not dtype.fields or not all(f.name in TAGS for f in dtype.fields):
        return F.when(
            col.isNotNull(),
            F.struct(*[_untag(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]),
        ) if dtype.fields else col
    values = [_tag_value(col.getField(f.name), f) for f in dtype.fields if f.name != "NULL"]
    if not values:
        return F.lit(None)
    if len(values) == 1:
        return values[0]
    return F.coalesce(*[_as_variant(v, f) for v, f in zip(values, [f for f in dtype.fields if f.name != "NULL"])])


def _tag_value(col: Column, field: T.StructField) -> Column:
    if field.name == "N":
        return col.try_cast(_NUMBER)
    if field.name == "NS":
        return F.transform(col, lambda x: x.try_cast(_NUMBER))
    if field.name == "B":
        return F.unbase64(col) if isinstance(field.dataType, T.StringType) else col
    if field.name == "BS":
        text = isinstance(field.dataType.elementType, T.StringType)
        return F.transform(col, lambda x: F.unbase64(x)) if text else col
    if field.name == "M":
        inner = field.dataType
        if isinstance(inner, T.StructType):
            return F.when(
                col.isNotNull(),
                F.struct(*[_untag(col.getField(f.name), f.dataType).alias(f.name) for f in inner.fields]),
            ) if inner.fields else col
        return F.transform_values(col, lambda k, v: _untag(v, inner.valueType))
    return _untag(col, field.dataType) if field.name == "L" else col


def _as_variant(col: Column, field: T.StructField) -> Column:
    return F.to_variant_object(col) if field.name in ("M", "L") else col.cast(T.VariantType())
