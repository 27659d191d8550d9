"""Sinks: files, catalog tables, JDBC, whole frame sets, and samples written mid-pipeline."""

from __future__ import annotations

import datetime
import posixpath
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.frame import FlexFrame, FrameSet
from flexspark.operators.choice import drop_null_fields
from flexspark.operators.sample import seeded_sample
from flexspark.plans.paths import top
from flexspark.plans.types import contains, parse_type
from flexspark.sources.jdbc import write_jdbc
from flexspark.sources.read import CSV_OPTIONS, table_name_of

# Fixed value: time stamp put before the extension of an output name.
STAMP = "%Y-%m-%d-%H_%M"


def stamped(path: str, now: datetime.datetime | None = None) -> str:
    """``dir/name.ext`` as ``dir/name_YYYY-mm-dd-HH_MM.ext``."""
    base, extension = posixpath.splitext(path)
    return f"{base}_{(now or datetime.datetime.now()).strftime(STAMP)}{extension}"


def storable(df: DataFrame, format: str) -> DataFrame:
    """Columns a format can hold: choices as JSON text for ORC and CSV, nested values too for CSV, no null-typed ones."""
    df = drop_null_fields(df)
    out: list[Column] = []
    for f in df.schema.fields:
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        text = (format == "csv" and (nested or isinstance(f.dataType, T.VariantType))) or (
            format == "orc" and contains(f.dataType, T.VariantType)
        )
        out.append(F.to_json(top(f.name)).alias(f.name) if text else top(f.name))
    return df.select(*out)


def divert(df: DataFrame, required: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose required fields are present and fit their type, those fields cast; and the rest as error rows."""
    casts = {c: top(c).try_cast(parse_type(t)) for c, t in required.items()}
    fits = reduce(and_, [c.isNotNull() for c in casts.values()])
    good = df.where(fits).select(*[casts[c].alias(c) if c in casts else top(c) for c in df.columns])
    message = F.concat_ws(", ", *[F.when(c.isNull(), F.lit(f"{n} is not {required[n]}")) for n, c in casts.items()])
    bad = df.where(~fits).select(message.alias("error_message"), F.to_json(F.struct(*[top(c) for c in df.columns])).alias("record"))
    return good, bad


class FlexWriter:
    """Sinks for FlexFrames and FrameSets. Writes append unless ``mode`` says otherwise, and return the rows they refused."""

    def from_options(self, frame, connection_type: str, connection_options: dict | None = None,
                     format: str | None = None, format_options: dict | None = None):
        """Write files or a JDBC table.

        The format decides; without one the connection type is the format. Options: ``path``, ``mode``, ``partitionBy``
        (list), ``stamp_path``, ``required`` ({field: type}, misfits are refused); others go to the Spark writer. A set
        writes each member under its own name.
        """
        options = dict(connection_options or {})
        if connection_type.lower() == "jdbc":
            return self._each(frame, options, lambda f, o: self._jdbc(f, o), "dbtable")
        if connection_type.lower() == "file" and not format:
            raise ValueError("a file sink needs a format")
        kind = (format or connection_type).lower()
        return self._each(frame, options, lambda f, o: self._files(f, o, kind, dict(format_options or {})), "path")

    def from_jdbc_conf(self, frame, connection: dict, connection_options: dict | None = None):
        """Write to a JDBC connection given as a dict (``url``, ``user``, ``password``)."""
        return self.from_options(frame, "jdbc", {**connection, **(connection_options or {})})

    def from_catalog(self, frame, database: str | None = None, table_name: str | None = None, name_space: str | None = None,
                     additional_options: dict | None = None) -> FlexFrame:
        """Append to a catalog table, columns matched by name; a table that isn't there is created, at ``path`` if given.

        New columns are added to the table (``schema_change="fail"``: raise), values are cast to its types where they fit, and rows that don't
        fit come back as the errors, like those of ``required``.
        """
        options = dict(additional_options or {})
        table = table_name_of(database, table_name, name_space)
        return self._one(frame, options, lambda df: _to_table(df, table, options))

    def _each(self, frame, options: dict, write: Callable, key: str):
        if isinstance(frame, FrameSet):
            base = options.get(key)
            out = {}
            for name, member in frame.items():
                where = name if key == "dbtable" else posixpath.join(base, name)
                out[name] = write(member, {**options, key: where})
            return FrameSet(out)
        return write(frame, options)

    def _one(self, frame, options: dict, write: Callable[[DataFrame], DataFrame | None]) -> FlexFrame:
        if not isinstance(frame, FlexFrame):
            raise TypeError(f"can write a FlexFrame or FrameSet, not {type(frame).__name__}")
        frame.assert_error_threshold()
        df, bad = frame.df, None
        required = options.pop("required", None)
        if required:
            df, bad = divert(df, required)
        refused = [b for b in (bad, write(df)) if b is not None]
        empty = frame.df.sparkSession.createDataFrame([], "error_message string, record string")
        return FlexFrame(reduce(DataFrame.unionByName, refused) if refused else empty, f"{frame.name}_errors")

    def _files(self, frame, options: dict, kind: str, format_options: dict) -> FlexFrame:
        options = dict(options)
        path = options.pop("path")
        if options.pop("stamp_path", False):
            path = stamped(path)
        mode, by = options.pop("mode", "append"), options.pop("partitionBy", options.pop("partitionKeys", []))

        def write(df: DataFrame) -> None:
            extra = {CSV_OPTIONS.get(k, k): str(v).lower() if isinstance(v, bool) else str(v)
                     for k, v in {**options, **format_options}.items() if k != "required"}
            _partitioned(storable(df, kind).write.format(kind).options(**extra).mode(mode), by).save(path)

        return self._one(frame, options, write)

    def _jdbc(self, frame, options: dict) -> FlexFrame:
        options = dict(options)
        table, mode = options.pop("dbtable"), options.pop("mode", "append")
        required = {"required": options.pop("required")} if "required" in options else {}
        return self._one(frame, required, lambda df: write_jdbc(storable(df, "csv"), options, table, mode))


def _partitioned(writer: DataFrameWriter, by) -> DataFrameWriter:
    return writer.partitionBy(*by) if by else writer


def _same(spark: SparkSession) -> Callable[[str], str]:
    """How column names are compared in this session."""
    return (lambda n: n) if spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true" else str.lower


def fitted(df: DataFrame, wanted: T.StructType) -> tuple[DataFrame, DataFrame | None]:
    """The rows cast to a table's columns, in their order, and those that don't fit as error rows (None where every row must fit).

    A value fits if it is cast without loss: text must parse, numbers and times must come back unchanged. Columns missing in ``df`` are null;
    columns of ``df`` that the table lacks are left out. Nested values must have the table's type.
    """
    same = _same(df.sparkSession)
    have = {same(f.name): f for f in df.schema.fields}
    out, fits, problems = [], [], []
    for f in wanted.fields:
        mine = have.get(same(f.name))
        if mine is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = top(mine.name)
        if mine.dataType == f.dataType or isinstance(mine.dataType, T.NullType):
            out.append(value.cast(f.dataType).alias(f.name))
            continue
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) and not isinstance(mine.dataType, T.VariantType):
            raise ValueError(f"column {f.name}: {mine.dataType.simpleString()} is not the table's {f.dataType.simpleString()}")
        nested = isinstance(mine.dataType, (T.StructType, T.ArrayType, T.MapType))
        cast = F.to_json(value).try_cast(f.dataType) if nested else value.try_cast(f.dataType)
        out.append(cast.alias(f.name))
        fine = cast.isNotNull()
        if not nested and not isinstance(mine.dataType, (T.StringType, T.VariantType)) and not isinstance(f.dataType, T.StringType):
            fine &= cast.try_cast(mine.dataType).eqNullSafe(value)
        fits.append(value.isNull() | fine)
        problems.append(F.when(~fits[-1], F.lit(f"{f.name} is not {f.dataType.simpleString()}")))
    if not fits:
        return df.select(*out), None
    ok = reduce(and_, fits)
    bad = df.where(~ok).select(F.concat_ws(", ", *problems).alias("error_message"), F.to_json(F.struct(*[top(c) for c in df.columns])).alias("record"))
    return df.where(ok).select(*out), bad


def _to_table(df: DataFrame, table: str, options: dict) -> DataFrame | None:
    """Write to a catalog table, created where it isn't there; returns the rows it refused.

    ``schema_change``: columns that the table lacks are added to it (``add``, the default) or raise (``fail``); they are never dropped. Columns
    without a type are. Rows whose values don't fit the table's types are refused (:func:`fitted`).
    """
    spark, change = df.sparkSession, options.get("schema_change", "add")
    if change not in ("add", "fail"):
        raise ValueError(f"schema_change is add or fail, not {change!r}")
    if not spark.catalog.tableExists(table):
        writer = df.write.format(options.get("format", "parquet")).mode(options.get("mode", "append"))
        if options.get("path"):
            writer = writer.option("path", options["path"])
        _partitioned(writer, options.get("partitionBy", [])).saveAsTable(table)
        return None
    same, df = _same(spark), drop_null_fields(df)
    known = {same(c) for c in spark.table(table).columns}
    new = [f for f in df.schema.fields if same(f.name) not in known]
    if new and change == "fail":
        raise ValueError(f"{table} has no column {', '.join(f.name for f in new)}")
    if new:
        listed = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    good, bad = fitted(df, spark.table(table).schema)
    good.write.mode(options.get("mode", "append")).insertInto(table)
    return bad


def write_data_frame(df: DataFrame, database: str | None = None, table_name: str | None = None, name_space: str | None = None, **options) -> DataFrame | None:
    """Append a plain DataFrame to a catalog table, as :meth:`FlexWriter.from_catalog` does; returns the rows refused, None where all must fit."""
    return _to_table(df, table_name_of(database, table_name, name_space), options)


def write_sample(df: DataFrame, path: str, options: dict) -> None:
    """Sample as JSON: ``topk`` first rows (no order promised; with ``seed`` and without ``prob`` drawn by it), thinned by ``prob``."""
    if "topk" in options and "seed" in options and "prob" not in options:
        df = seeded_sample(df, int(options["topk"]), int(options["seed"]), options.get("key"))
    elif "topk" in options:
        df = df.limit(int(options["topk"]))
    if "prob" in options:
        df = df.sample(float(options["prob"]), seed=options.get("seed"))
    storable(df, "json").write.mode("append").json(path)
