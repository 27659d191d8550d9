"""Sources: files, catalog tables, JDBC, streams and samples."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable
from functools import reduce
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.frame import FlexFrame, Step
from flexspark.operators.sample import seeded_sample
from flexspark.plans.discover import discover, from_variant
from flexspark.plans.paths import as_list
from flexspark.plans.types import Choice, merge_types, type_name
from flexspark.sources.ledger import JobRun
from flexspark.sources.scratch import stage

# Codecs that need a named format, and CSV options under their names here and in Spark.
NAMED_FORMAT_CODECS = ["lzo"]
CSV_OPTIONS = {
    "separator": "sep",
    "quoteChar": "quote",
    "escaper": "escape",
    "withHeader": "header",
    "multiLine": "multiLine",
}


def table_name_of(database: str | None, table: str | None, name_space: str | None = None) -> str:
    """Quoted table name; ``name_space`` is another word for ``database`` and exactly one must be given."""
    if bool(database) == bool(name_space):
        raise ValueError("give exactly one of database and name_space")
    if not table:
        raise ValueError("table_name is missing")
    return f"`{database or name_space}`.`{table}`"


def frame_name(options: dict) -> str:
    """Last folder or file of the first path, without its extension; ``frame`` with a number where there is none."""
    first = next(iter(_paths(options)), "")
    last = PurePosixPath(first.rstrip("/*")).name.partition(".")[0]
    return last or f"frame{next(_UNNAMED)}"


_UNNAMED = itertools.count(1)


def partition_hint(df: DataFrame, minimum: int | None = None, target: int | None = None) -> DataFrame:
    """Fewer partitions than the minimum: repartition to the target. More than the target: coalesce to it."""
    if minimum is None and target is None:
        return df
    minimum, target = minimum or target, target or minimum
    have = df.rdd.getNumPartitions()
    if have < minimum:
        return df.repartition(target)
    return df.coalesce(target) if have > target else df


class FlexReader:
    """Batch sources that give FlexFrames."""

    def __init__(self, spark: SparkSession, min_partitions: int | None = None, target_partitions: int | None = None, run: JobRun | None = None):
        """With a ``run``, reads that name a ``transformation_ctx`` give what its bookmark leaves."""
        self.spark, self.run = spark, run
        self.min_partitions, self.target_partitions = min_partitions, target_partitions

    def from_options(
        self,
        connection_type: str,
        connection_options: dict | None = None,
        format: str | None = None,
        format_options: dict | None = None,
        push_down_predicate: str = "",
        name: str | None = None,
        schema: T.StructType | str | None = None,
        min_partitions: int | None = None,
        target_partitions: int | None = None,
        transformation_ctx: str = "",
        staging_path: str | None = None,
    ) -> FlexFrame:
        """Read by connection, format and options. The predicate is a plain filter, so Spark prunes by it.

        JSON goes through :meth:`json`, which keeps bad records as errors; with a schema and a Spark parser ``mode`` in the
        format options it goes to Spark's typed reader, which is about twice as fast and keeps none.
        With a ``staging_path`` JSON is parsed in one pass, see :meth:`json`.
        Files that the bookmark of the reader's run holds back are not read, nor do their types count; if none is due the frame is empty,
        with the columns of all files.
        """
        options, format_options = dict(connection_options or {}), dict(format_options or {})
        name = name or frame_name(options)
        if self.run is not None and transformation_ctx and _paths(options):
            roots, files = _paths(options), self.run.due(transformation_ctx, _paths(options))
            base = {"basePath": roots[0]} if len(roots) == 1 and not re.search(r"[*?{\[]", roots[0]) else {}
            plain = FlexReader(self.spark, self.min_partitions, self.target_partitions)
            rest = (format, format_options, push_down_predicate, name, schema, min_partitions, target_partitions, "", staging_path)
            if files:
                return plain.from_options(connection_type, {**base, **options, "paths": files}, *rest)
            frame = plain.from_options(connection_type, options, *rest)
            return FlexFrame(frame.df.where(F.lit(False)), frame.name)
        as_map = as_list(format_options.pop("asMap", ()))
        format = format.lower() if format else None
        codec = str(options.pop("compressionType", "") or "").lower()
        if codec in NAMED_FORMAT_CODECS and format is None:
            raise ValueError(f"compressionType {codec} needs a format")
        if connection_type.lower() == "jdbc":
            from flexspark.sources.jdbc import read_jdbc

            frame = FlexFrame(read_jdbc(self.spark, options), name)
        elif format == "json" and (schema is None or "mode" not in format_options):
            frame = self.json(_paths(options), name, _reader_options(options, format_options), schema, predicate=push_down_predicate, as_map=as_map, staging_path=staging_path)
        else:
            kind = format or connection_type.lower()
            reader = self.spark.read.format(kind).options(**_reader_options(options, format_options))
            if schema is not None:
                reader = reader.schema(schema)
            paths = _paths(options)
            frame = FlexFrame(reader.load(paths) if paths else reader.load(), name)
        if push_down_predicate:
            frame = FlexFrame(frame.df.where(push_down_predicate), name, frame.steps)
        df = partition_hint(frame.df, min_partitions or self.min_partitions, target_partitions or self.target_partitions)
        return FlexFrame(df, name, frame.steps)

    def json(self, paths: list[str], name: str = "", options: dict | None = None, schema: T.StructType | str | None = None,
             discover_types: bool = True, predicate: str = "", as_map: Iterable[str] = (), staging_path: str | None = None) -> FlexFrame:
        """JSON records and partition columns, the records' types given or discovered. Top-level arrays count as their elements.

        Text that does not parse, and values that are no objects, become error records; values that do not fit a given
        type are null. Each text is parsed once, by the scan. The parts of ``predicate`` that need partition columns only are applied
        first, so that other folders are neither discovered nor read; the rest is left to the caller. Objects at the ``as_map`` paths,
        whose keys are data, are discovered as maps (format option ``asMap`` of :meth:`from_options`). With a ``staging_path`` the parsed
        records are written there at once, so that types, rows, errors and limits come from one pass over the source.
        """
        raw = (
            self.spark.read.options(**{**(options or {}), "singleVariantColumn": "v", "columnNameOfCorruptRecord": _CORRUPT})
            .schema(f"v variant, {_CORRUPT} string")
            .json(paths)
        )
        partitions = [c for c in raw.columns if c not in ("v", _CORRUPT)]
        for part in _conjuncts(predicate) if partitions else ():
            if _fits(raw.select(*partitions), part):
                raw = raw.where(part)
        if staging_path is not None:
            raw = stage(raw, "json", staging_path)
        found = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
        given = found is not None or not discover_types
        if not given:
            found = discover(raw, ["v"], as_map)["v"]
        records, objects = _objects(raw, found, given)
        is_object = F.try_variant_get("v", "$", "struct<>").isNotNull()
        errors = records.where(~is_object).select(
            F.lit("not a JSON object").alias("error_message"), F.coalesce(_CORRUPT, F.to_json("v")).alias("record")
        )
        good = records.where(is_object).select("v", *partitions)
        typed = good if objects is None else from_variant(good, "v", objects)
        return FlexFrame(typed, name, [Step("read_json", errors=errors)])

    def from_catalog(
        self,
        database: str | None = None,
        table_name: str | None = None,
        push_down_predicate: str = "",
        name_space: str | None = None,
        name: str | None = None,
        transformation_ctx: str = "",
    ) -> FlexFrame:
        """Catalog table; a predicate on partition columns prunes partitions. With the bookmark of the reader's run, the rows of the files due."""
        df = self.spark.table(table_name_of(database, table_name, name_space))
        if self.run is not None and transformation_ctx:
            have = df.inputFiles()
            due = self.run.due(transformation_ctx, have) if have else []
            file = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
            df = df.where(file.isin([re.sub("^file:/+", "file:/", p) for p in due]) if due else F.lit(False))
        if push_down_predicate:
            df = df.where(push_down_predicate)
        return FlexFrame(partition_hint(df, self.min_partitions, self.target_partitions), name or table_name)

    def from_rows(self, data, name: str = "", schema=None, sample_ratio: float | None = None) -> FlexFrame:
        """Local rows or an RDD, with an optional schema or sampling ratio for inference."""
        if schema is not None:
            return FlexFrame(self.spark.createDataFrame(data, schema), name)
        return FlexFrame(self.spark.createDataFrame(data, samplingRatio=sample_ratio), name)

    from_rdd = from_rows

    def sample_from_catalog(self, database: str, table_name: str, num: int, sample_options: dict | None = None, **kwargs) -> FlexFrame:
        return self._sampled(self.from_catalog(database, table_name, **kwargs), num, sample_options or {})

    def sample_from_options(self, connection_type: str, connection_options: dict, num: int, sample_options: dict | None = None, **kwargs) -> FlexFrame:
        return self._sampled(self.from_options(connection_type, connection_options, **kwargs), num, sample_options or {})

    def _sampled(self, frame: FlexFrame, num: int, options: dict) -> FlexFrame:
        """At most ``num`` rows: the first ones, thinned at random before by ``fraction`` (with ``seed``). A ``seed`` alone draws exactly ``num``
        rows uniformly, the same on every run, by the ``key`` columns if given.
        """
        df = frame.df
        if "seed" in options and "fraction" not in options:
            return FlexFrame(seeded_sample(df, num, int(options["seed"]), options.get("key")), frame.name, frame.steps)
        if "fraction" in options:
            df = df.sample(float(options["fraction"]), seed=options.get("seed"))
        return FlexFrame(df.limit(num), frame.name, frame.steps)

    def catalog_schema(self, database: str, table_name: str) -> T.StructType:
        return self.spark.table(table_name_of(database, table_name)).schema


_CORRUPT = "_corrupt_record"


def _objects(raw: DataFrame, found: T.DataType | None, given: bool) -> tuple[DataFrame, T.StructType | None]:
    """Records of a raw read and their type, from the type of the root; arrays at the root are opened, always where the type is ``given``."""
    options = {} if found is None else _options(found)
    objects = None if found is None else options.get("struct", T.StructType([]))
    if given or "array" in options:
        items = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
        raw = raw.select(*[c for c in raw.columns if c != "v"], F.explode(items).alias("v"))
    if "array" in options:
        objects = merge_types(objects, _options(options["array"].elementType).get("struct", T.NullType()))
    return raw, objects


def _conjuncts(predicate: str) -> list[str]:
    """Parts of a predicate joined by AND outside quotes and brackets; with BETWEEN or CASE in it, the predicate as it is."""
    if not predicate or re.search(r"\b(between|case)\b", predicate, re.I):
        return [predicate] if predicate else []
    parts, depth, last = [], 0, 0
    for m in re.finditer(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|[()]|\band\b", predicate, re.I):
        depth += {"(": 1, ")": -1}.get(m[0], 0)
        if m[0].lower() == "and" and depth == 0:
            parts.append(predicate[last : m.start()])
            last = m.end()
    return [*parts, predicate[last:]]


def _fits(df: DataFrame, predicate: str) -> bool:
    """Whether a predicate needs no other columns than these."""
    try:
        return df.where(predicate).schema is not None
    except AnalysisException:
        return False


def _options(dtype: T.DataType) -> dict[str, T.DataType]:
    if isinstance(dtype, Choice):
        return dtype.options
    return {} if isinstance(dtype, T.NullType) else {type_name(dtype): dtype}


def _paths(options: dict) -> list[str]:
    paths = options.get("paths") or options.get("path") or []
    return [paths] if isinstance(paths, str) else list(paths)


def _reader_options(options: dict, format_options: dict) -> dict:
    out = {}
    for k, v in {**options, **format_options}.items():
        if k in ("paths", "path"):
            continue
        if k == "recurse":
            k = "recursiveFileLookup"
        k = CSV_OPTIONS.get(k, k)
        out[k] = str(v).lower() if isinstance(v, bool) else str(v)
    return out


class FlexDataFrameReader:
    """Sources that give plain, possibly streaming, DataFrames."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def from_catalog(self, database: str | None = None, table_name: str | None = None, name_space: str | None = None,
                     stream: bool = True, **options) -> DataFrame:
        """Stream of the rows of a catalog table, or with ``stream=False`` the table."""
        table = table_name_of(database, table_name, name_space)
        return self.spark.readStream.options(**options).table(table) if stream else self.spark.table(table)

    def from_options(self, connection_type: str, connection_options: dict | None = None, format: str | None = None,
                     format_options: dict | None = None, schema: T.StructType | str | None = None) -> DataFrame:
        """Stream of files in a format, when there are paths (several are united), else of the connection type (``rate``, ``kafka``, ...)."""
        options = dict(connection_options or {})
        paths = _paths(options)
        kind = format.lower() if format and paths else connection_type
        reader = self.spark.readStream.format(kind).options(**_reader_options(options, dict(format_options or {})))
        if schema is not None:
            reader = reader.schema(schema)
        if len(paths) <= 1:
            return reader.load(paths[0]) if paths else reader.load()
        return reduce(DataFrame.unionByName, [reader.load(p) for p in paths])
