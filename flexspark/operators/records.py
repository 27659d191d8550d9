"""User functions over records, run on Arrow batches inside Spark tasks, with per-record error capture.

A record is a dict with attribute access. One pass yields good and failed rows side by side; the two results are
filters of that pass. Spark would run the function again for each of them, so when both are used, pass
``persist=True`` (memory and disk) or ``staging_path`` (one written copy; also right for functions that are not
deterministic).
"""

from __future__ import annotations

import datetime
import decimal
import json
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flexspark.plans.discover import discover, from_variant
from flexspark.plans.paths import top
from flexspark.plans.types import contains
from flexspark.sources.scratch import stage

EMPTY_RESULT = "the function gave no record"
_OUT_ROWS = 5_000


class Record(dict):
    """Fields by key or attribute: ``r["a"]`` and ``r.a`` are the same place, also for writing. A field that is missing is a KeyError either way."""

    __getattr__ = dict.__getitem__
    __setattr__ = dict.__setitem__
    __delattr__ = dict.__delitem__


def _record(value: Any, dtype: T.DataType) -> Any:
    """Arrow value as the Python value a user function sees."""
    if value is None:
        return None
    if isinstance(dtype, T.StructType):
        return Record((f.name, _record(value[f.name], f.dataType)) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return [_record(v, dtype.elementType) for v in value]
    if isinstance(dtype, T.MapType):
        return Record((k, _record(v, dtype.valueType)) for k, v in (value.items() if isinstance(value, dict) else value))
    if isinstance(dtype, T.VariantType):
        return T.VariantVal(value["value"], value["metadata"]).toPython()
    return value


def _records(batch: pa.RecordBatch, schema: T.StructType) -> Iterator[Record]:
    for row in batch.to_pylist(maps_as_pydicts="lossy"):
        yield _record(row, schema)


def _plain(value: Any) -> Any:
    """Value of a user record in JSON terms."""
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat(" ") if isinstance(value, datetime.datetime) else value.isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).decode("utf-8", "replace")
    if hasattr(value, "item"):
        return value.item()
    return str(value)


def _declared(schema: T.StructType | str | None) -> T.StructType | None:
    return T.DataType.fromDDL(schema) if isinstance(schema, str) else schema


def _check_output(schema: T.StructType) -> None:
    if contains(schema, T.VariantType):
        raise ValueError("declare plain types, or give no schema to get choices")


def _null_struct(fields: pa.Schema, n: int) -> pa.StructArray:
    return pa.nulls(n, pa.struct(list(fields)))


# --------------------------------------------------------------------------------------------------- filter

def filter_records(df: DataFrame, keep: Callable[[Record], bool]) -> DataFrame:
    """Rows a Python predicate keeps, plus a column ``__error``.

    KeyError, ValueError and TypeError mean "no"; any other exception keeps the row as an error.
    """
    schema = df.schema
    out = T.StructType([*schema.fields, T.StructField("__error", T.StringType())])

    def run(batches):
        for batch in batches:
            rows, errors = [], []
            for i, record in enumerate(_records(batch, schema)):
                try:
                    if keep(record):
                        rows.append(i)
                        errors.append(None)
                except (KeyError, ValueError, TypeError):
                    pass
                except Exception as e:
                    rows.append(i)
                    errors.append(str(e))
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(errors, pa.string())], out.names)

    return df.mapInArrow(run, out)


# ------------------------------------------------------------------------------------------------------ map

def map_records(df: DataFrame, f: Callable[[Record], dict], schema: T.StructType | str | None) -> DataFrame:
    """One row per input record: ``out`` (the result), or ``error`` with the untouched input in ``record``.

    With a schema ``out`` is a struct of it; without one it is the result as JSON text.
    """
    given = df.schema
    target = _declared(schema)
    if target is not None:
        _check_output(target)
    result = T.StringType() if target is None else target
    out = T.StructType(
        [T.StructField("out", result), T.StructField("error", T.StringType()), T.StructField("record", given)]
    )
    arrow = None if target is None else to_arrow_schema(target)

    def run(batches):
        for batch in batches:
            results, errors = [], []
            for record in _records(batch, given):
                try:
                    made = f(record)
                    results.append(made or None)
                    errors.append(None if made else EMPTY_RESULT)
                except Exception as e:
                    results.append(None)
                    errors.append(str(e))
            made = _encode(results, errors, arrow)
            failed = pa.array([i if e is not None else None for i, e in enumerate(errors)], pa.int64())
            rows = pa.StructArray.from_arrays(batch.columns, fields=list(batch.schema)).take(failed)
            yield pa.RecordBatch.from_arrays([made, pa.array(errors, pa.string()), rows], out.names)

    return df.mapInArrow(run, out)


def _encode(results: list, errors: list, arrow: pa.Schema | None) -> pa.Array:
    """Results as one Arrow column; a result that does not fit the schema turns into an error."""
    if arrow is None:
        texts = []
        for i, r in enumerate(results):
            try:
                texts.append(None if r is None else json.dumps(r, default=_plain))
            except (TypeError, ValueError) as e:
                texts.append(None)
                errors[i] = str(e)
        return pa.array(texts, pa.string())
    kind = pa.struct(list(arrow))
    try:
        return pa.array(results, kind)
    except (pa.ArrowInvalid, pa.ArrowTypeError, TypeError, ValueError, OverflowError):
        for i, r in enumerate(results):
            try:
                pa.array([r], kind)
            except (pa.ArrowInvalid, pa.ArrowTypeError, TypeError, ValueError, OverflowError) as e:
                results[i], errors[i] = None, str(e)
        return pa.array(results, kind)


def keep(both: DataFrame, persist: bool = False, staging_path: str | None = None) -> DataFrame:
    """Mapped rows held for several uses: persisted, or written once below ``staging_path``."""
    if staging_path is not None:
        return stage(both, "mapped", staging_path)
    return both.persist(StorageLevel.MEMORY_AND_DISK) if persist else both


def split_mapped(both: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good results and error rows of :func:`map_records`."""
    failed = both.where("error is not null")
    errors = failed.select(F.col("error").alias("error_message"), F.to_json("record").alias("record"))
    good = both.where("error is null")
    if isinstance(both.schema["out"].dataType, T.StructType):
        return good.select("out.*"), errors
    return good.select(F.parse_json("out").alias("v")), errors


def open_json_records(good: DataFrame) -> DataFrame:
    """Typed columns for the JSON results of a function without a schema."""
    found = discover(good, ["v"])["v"]
    return from_variant(good, "v", found) if isinstance(found, T.StructType) else good


# ------------------------------------------------------------------------------------------- map partitions

def map_partitions(
    df: DataFrame, f: Callable[[int, Iterator[Record]], Iterable[dict]], schema: T.StructType | str
) -> DataFrame:
    """Run ``f(partition number, records)`` once per partition; it yields dicts that fit the schema."""
    given, target = df.schema, _declared(schema)
    _check_output(target)
    arrow = to_arrow_schema(target)

    def run(batches):
        source = (r for b in batches for r in _records(b, given))
        rows: list[dict] = []
        for made in f(TaskContext.get().partitionId(), source):
            rows.append(made)
            if len(rows) == _OUT_ROWS:
                yield pa.RecordBatch.from_pylist(rows, arrow)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return df.mapInArrow(run, target)


def errors_of(df: DataFrame) -> DataFrame:
    """Error rows of :func:`filter_records`."""
    columns = [top(c) for c in df.columns if c != "__error"]
    return df.where("__error is not null").select(
        F.col("__error").alias("error_message"), F.to_json(F.struct(*columns)).alias("record")
    )
