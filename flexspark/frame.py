"""FlexFrame: a DataFrame with a name, error rows per step and error limits. FrameSet: named frames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.functions.columns import add_ingestion_time_columns
from flexspark.operators import choice as _choice
from flexspark.operators import nest as _nest
from flexspark.operators import project as _project
from flexspark.operators import records as _records
from flexspark.operators import rows as _rows
from flexspark.plans.discover import extract, frame_schema, from_variant

ERROR_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("stage", T.StringType()),
        T.StructField("info", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("record", T.StringType()),
    ]
)


class ErrorThresholdExceeded(RuntimeError):
    """More error records than a step or the steps so far may have."""


class Step(NamedTuple):
    """What one operator left behind: error rows (``error_message``, ``record``), limits (0 for none), what it persisted.

    A step is itself, not its values: frames that share an ancestor share its steps, and each counts once.
    """

    stage: str
    info: str = ""
    errors: DataFrame | None = None
    stage_threshold: int = 0
    total_threshold: int = 0
    cached: DataFrame | None = None


def _limited(step: Step, transformation_ctx: str = "", info: str | None = "", stage_threshold: int = 0, total_threshold: int = 0,
             stageThreshold: int = 0, totalThreshold: int = 0) -> Step:
    """Step with the options every operator takes; a ``transformation_ctx`` replaces its label."""
    return step._replace(
        stage=transformation_ctx or step.stage,
        info=info or "",
        stage_threshold=stage_threshold or stageThreshold,
        total_threshold=total_threshold or totalThreshold,
    )


class FlexFrame:
    """An ordinary DataFrame (``.df``) that carries a name and the error rows of the steps that made it.

    Every operator takes ``transformation_ctx`` (label of the step), ``info``, ``stage_threshold`` and ``total_threshold``.
    Nothing runs before an action; limits are checked by :meth:`assert_error_threshold` and before every write.
    """

    def __init__(self, df: DataFrame, name: str = "", steps: Iterable[Step] = ()):
        self.df = df
        self.name = name
        self.steps = tuple({id(s): s for s in steps}.values())
        self._schema: T.StructType | None = None

    @classmethod
    def fromDF(cls, df: DataFrame, name: str = "") -> FlexFrame:
        return cls(df, name)

    def toDF(self, options: Iterable[_choice.ResolveOption] = ()) -> DataFrame:
        """Plain DataFrame: choices resolved by the options, the rest as structs with one field per type."""
        return _choice.to_plain(self.df, options)

    def _next(self, stage: str, df: DataFrame, errors: DataFrame | None = None, name: str | None = None,
              others: Iterable[Step] = (), **limits) -> FlexFrame:
        step = _limited(Step(stage, errors=errors), **limits)
        return FlexFrame(df, self.name if name is None else name, [*self.steps, *others, step])

    # ------------------------------------------------------------------------------------------ schema

    def schema(self) -> T.StructType:
        """Schema with choices spelled out; computed once, by one pass when the frame holds choices."""
        if self._schema is None:
            self._schema = frame_schema(self.df)
        return self._schema

    def with_frame_schema(self, schema: T.StructType | str) -> FlexFrame:
        """Supply the schema instead of discovering it."""
        schema = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
        fields = self.df.schema.fields
        if len(fields) == 1 and isinstance(fields[0].dataType, T.VariantType) and schema.names != [fields[0].name]:
            return FlexFrame(from_variant(self.df, fields[0].name, schema), self.name, self.steps)
        have = {f.name: f.dataType for f in fields}
        if any(isinstance(t, T.VariantType) for t in have.values()):
            cols = [
                extract(F.col(f"`{f.name}`"), "$", f.dataType).alias(f.name)
                if isinstance(have.get(f.name), T.VariantType) else F.col(f"`{f.name}`")
                for f in schema.fields if f.name in have
            ]
            return FlexFrame(self.df.select(*cols).to(schema), self.name, self.steps)
        return FlexFrame(self.df.to(schema), self.name, self.steps)

    def printSchema(self) -> None:
        self.df.printSchema()

    def show(self, n: int = 20) -> None:
        self.df.show(n)

    def count(self) -> int:
        return self.df.count()

    def is_empty(self) -> bool:
        return self.df.isEmpty()

    # -------------------------------------------------------------------------------------- projection

    def select_fields(self, paths, **limits) -> FlexFrame:
        return self._next("select_fields", _project.select_fields(self.df, paths), **limits)

    def drop_fields(self, paths, **limits) -> FlexFrame:
        return self._next("drop_fields", _project.drop_fields(self.df, paths), **limits)

    def rename_field(self, old: str, new: str, **limits) -> FlexFrame:
        return self._next("rename_field", _project.rename_field(self.df, old, new), **limits)

    def split_fields(self, paths, name1: str | None = None, name2: str | None = None, **limits) -> FrameSet:
        first, rest = _project.split_fields(self.df, paths)
        name1, name2 = name1 or f"{self.name}1", name2 or f"{self.name}2"
        return FrameSet([self._next("split_fields", first, name=name1, **limits), self._next("split_fields", rest, name=name2, **limits)])

    def apply_mapping(self, mappings, case_sensitive: bool = False, **limits) -> FlexFrame:
        return self._next("apply_mapping", _project.apply_mapping(self.df, mappings, case_sensitive), **limits)

    map_fields = apply_mapping

    def unnest(self, key_cols=None, staging_path: str | None = None, **limits) -> FlexFrame:
        return self._next("unnest", _nest.unnest(self.df, key_cols, staging_path), **limits)

    def relationalize(self, root_table_name: str = "roottable", staging_path: str | None = None, key_cols=None, **limits) -> FrameSet:
        tables = _nest.relationalize(self.df, root_table_name, staging_path, key_cols)
        return FrameSet([self._next("relationalize", t, name=n, **limits) for n, t in tables.items()])

    def unbox(self, path: str, format: str, schema=None, separator: str = ",", escaper: str = "\\", skip_first: bool = False,
              with_header: bool = False, persist: bool = False, staging_path: str | None = None, **limits) -> FlexFrame:
        good, errors = _nest.unbox(self.df, path, format, schema, separator, escaper, skip_first, with_header, persist, staging_path)
        return self._next("unbox", good, errors, **limits)

    def open_variant(self, path: str, as_map: Iterable[str] = (), **limits) -> FlexFrame:
        return self._next("open_variant", _nest.open_variant(self.df, path, as_map), **limits)

    def unnest_tagged_json(self, **limits) -> FlexFrame:
        return self._next("unnest_tagged_json", _nest.unnest_tagged_json(self.df), **limits)

    def nest(self, keys=(), parts: int = 1, items: str = "items", part: str = "part", **limits) -> FlexFrame:
        return self._next("nest", _nest.nest_rows(self.df, keys, parts, items, part), **limits)

    def add_ingestion_time_columns(self, granularity: str = "minute", ts=None, **limits) -> FlexFrame:
        return self._next("add_ingestion_time_columns", add_ingestion_time_columns(self.df, granularity, ts), **limits)

    # ----------------------------------------------------------------------------------------- choices

    def resolve_choice(self, specs=None, choice: str = "", database: str | None = None, table_name: str | None = None, **limits) -> FlexFrame:
        wanted = None
        if choice.lower() == "match_catalog":
            if not (database and table_name):
                raise ValueError("match_catalog needs database and table_name")
            wanted = self.df.sparkSession.table(f"`{database}`.`{table_name}`").schema
        return self._next("resolve_choice", _choice.resolve_choice(self.df, specs, choice, wanted), **limits)

    resolveChoice = resolve_choice

    def drop_null_fields(self, **limits) -> FlexFrame:
        return self._next("drop_null_fields", _choice.drop_null_fields(self.df), **limits)

    # -------------------------------------------------------------------------------------------- rows

    def filter(self, f: Column | str | Callable, persist: bool = True, staging_path: str | None = None, **limits) -> FlexFrame:
        """Column or SQL text: a plain filter. A Python predicate runs per record, with error capture.

        The predicate's rows are persisted, so that kept rows, errors and limits are of one run; ``staging_path`` writes them instead,
        ``persist=False`` runs it for every use.
        """
        if isinstance(f, (Column, str)):
            return self._next("filter", self.df.where(f), **limits)
        both = _records.keep(_records.filter_records(self.df, f), persist, staging_path)
        frame = self._next("filter", both.where("__error is null").drop("__error"), _records.errors_of(both), **limits)
        return frame._holding(both) if persist and staging_path is None else frame

    def split_rows(self, comparisons: dict, name1: str = "frame1", name2: str = "frame2", **limits) -> FrameSet:
        inside, rest = _rows.split_rows(self.df, comparisons)
        return FrameSet([self._next("split_rows", inside, name=name1, **limits), self._next("split_rows", rest, name=name2, **limits)])

    def map(self, f: Callable, schema=None, persist: bool = True, staging_path: str | None = None, **limits) -> FlexFrame:
        """Function per record. Without a schema the results are staged as JSON and their schema discovered.

        JSON has no dates, decimals or bytes: in results without a schema those are text. Results are persisted like
        those of :meth:`filter`.
        """
        both = _records.map_records(self.df, f, schema)
        if schema is None and staging_path is None:
            from flexspark.sources.scratch import scratch_root

            staging_path = scratch_root(self.df.sparkSession)
        both = _records.keep(both, persist, staging_path)
        good, errors = _records.split_mapped(both)
        frame = self._next("map", good if schema is not None else _records.open_json_records(good), errors, **limits)
        return frame._holding(both) if persist and staging_path is None else frame

    def _holding(self, cached: DataFrame) -> FlexFrame:
        """This frame with its last step owning what was persisted for it."""
        return FlexFrame(self.df, self.name, [*self.steps[:-1], self.steps[-1]._replace(cached=cached)])

    def unpersist(self) -> FlexFrame:
        """Release what the steps up to this frame persisted."""
        for step in self.steps:
            if step.cached is not None:
                step.cached.unpersist()
        return self

    def map_partitions(self, f: Callable, schema, **limits) -> FlexFrame:
        return self._next("map_partitions", _records.map_partitions(self.df, lambda _, rows: f(rows), schema), **limits)

    mapPartitions = map_partitions

    def map_partitions_with_index(self, f: Callable, schema, **limits) -> FlexFrame:
        return self._next("map_partitions_with_index", _records.map_partitions(self.df, f, schema), **limits)

    mapPartitionsWithIndex = map_partitions_with_index

    def join(self, paths1, paths2, other: FlexFrame, salts: int = 0, **limits) -> FlexFrame:
        """Inner equality join; with ``salts``, frequent keys of either side are dealt over so many tasks."""
        joined = _rows.join_on(self.df, other.df, paths1, paths2, salts=salts)
        return self._next("join", joined, name=self.name + other.name, others=other.steps, **limits)

    def merge(self, staged: FlexFrame, primary_keys, **limits) -> FlexFrame:
        return self._next("merge", _rows.merge_rows(self.df, staged.df, primary_keys), others=staged.steps, **limits)

    def union(self, other: FlexFrame, **limits) -> FlexFrame:
        return self._next("union", _rows.union_rows(self.df, other.df), others=other.steps, **limits)

    def distinct(self, **limits) -> FlexFrame:
        return self._next("distinct", _rows.distinct_rows(self.df), **limits)

    def spigot(self, path: str, options: dict | None = None, **limits) -> FlexFrame:
        """Write a sample (``topk`` first rows, ``prob`` share of them) as JSON now; the frame passes through.

        With a ``seed`` and without ``prob``, the ``topk`` rows are drawn uniformly, by ``key`` columns if given, and the same on every run.
        """
        from flexspark.sources.write import write_sample

        write_sample(self.df, path, options or {})
        return self._next("spigot", self.df, **limits)

    def write(self, connection_type: str, connection_options: dict | None = None, format: str | None = None,
              format_options: dict | None = None) -> FlexFrame:
        from flexspark.sources.write import FlexWriter

        return FlexWriter().from_options(self, connection_type, connection_options, format, format_options)

    # ------------------------------------------------------------------------------------ partitioning

    def repartition(self, n: int, **limits) -> FlexFrame:
        return self._next("repartition", self.df.repartition(n), **limits)

    def coalesce(self, n: int, shuffle: bool = False, **limits) -> FlexFrame:
        return self._next("coalesce", self.df.repartition(n) if shuffle else self.df.coalesce(n), **limits)

    def getNumPartitions(self) -> int:
        return self.df.rdd.getNumPartitions()

    # ------------------------------------------------------------------------------------------ errors

    def _error_rows(self, steps: Iterable[tuple[int, Step]]) -> DataFrame:
        parts = [
            s.errors.select(
                F.lit(i).alias("step"), F.lit(s.stage).alias("stage"), F.lit(s.info).alias("info"), "error_message", "record"
            )
            for i, s in steps
            if s.errors is not None
        ]
        if not parts:
            return self.df.sparkSession.createDataFrame([], ERROR_SCHEMA)
        return reduce(DataFrame.unionAll, parts)

    def errors(self) -> FlexFrame:
        """Error records of all steps up to this frame."""
        return FlexFrame(self._error_rows(enumerate(self.steps)), self.name)

    errorsAsFrame = errors

    def errors_count(self) -> int:
        return self._error_rows(enumerate(self.steps)).count()

    errorsCount = errors_count

    def stage_errors_count(self) -> int:
        """Errors of the last step only."""
        last = [(i, s) for i, s in enumerate(self.steps)][-1:]
        return self._error_rows(last).count()

    stageErrorsCount = stage_errors_count

    def assert_error_threshold(self) -> None:
        """Raise when a step has more errors than its limit, or the steps so far more than the total limit."""
        if not any(s.stage_threshold or s.total_threshold for s in self.steps):
            return
        counts = {r["step"]: r["count"] for r in self._error_rows(enumerate(self.steps)).groupBy("step").count().collect()}
        total = 0
        for i, s in enumerate(self.steps):
            here = counts.get(i, 0)
            total += here
            if 0 < s.stage_threshold < here:
                raise ErrorThresholdExceeded(f"{s.stage} {s.info}: {here} errors, {s.stage_threshold} allowed")
            if 0 < s.total_threshold < total:
                raise ErrorThresholdExceeded(f"{s.stage} {s.info}: {total} errors so far, {s.total_threshold} allowed")

    assertErrorThreshold = assert_error_threshold


class FrameSet(Mapping):
    """Frames by name."""

    def __init__(self, frames: Iterable[FlexFrame] | Mapping[str, FlexFrame]):
        pairs = frames.items() if isinstance(frames, Mapping) else ((f.name, f) for f in _members(frames, "frames"))
        self._by_name: dict[str, FlexFrame] = dict(pairs)

    def __getitem__(self, name: str) -> FlexFrame:
        return self._by_name[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._by_name)

    def __len__(self) -> int:
        return len(self._by_name)

    def select(self, name: str) -> FlexFrame:
        """Frame by name; an unknown name gives an empty frame without columns."""
        nothing = lambda: FlexFrame(SparkSession.active().createDataFrame([], T.StructType([])), name)
        return self.get(name) or nothing()

    def map(self, f: Callable[[FlexFrame, str], FlexFrame], ctx: str = "") -> FrameSet:
        """Apply ``f(frame, "ctx:name")`` to every frame; names stay."""
        return FrameSet({name: _members(f(frame, f"{ctx}:{name}"), "result", single=True)[0] for name, frame in self.items()})

    def flatmap(self, f: Callable[[FlexFrame, str], FlexFrame | FrameSet], ctx: str = "") -> FrameSet:
        """Apply ``f``, which may return several frames; the result is keyed by their names, later ones win."""
        return FrameSet([made for name, frame in self.items() for made in _members(f(frame, f"{ctx}:{name}"), "result")])

    def apply(self, op: Callable, frame_name: str = "frame", **kwargs) -> FrameSet:
        """Run one operator over every frame, passed under ``frame_name``."""
        return self.flatmap(lambda frame, ctx: op(**{frame_name: frame}, **kwargs))


def _members(made, what: str, single: bool = False) -> list[FlexFrame]:
    """The frames in a frame, a set (under its names) or a list; anything else is a TypeError."""
    if isinstance(made, FlexFrame):
        return [made]
    if isinstance(made, FrameSet) and not single:
        return [FlexFrame(f.df, name, f.steps) for name, f in made.items()]
    if isinstance(made, (list, tuple)) and not single and all(isinstance(f, FlexFrame) for f in made):
        return list(made)
    raise TypeError(f"{what}: expected {'a FlexFrame' if single else 'FlexFrames'}, got {type(made).__name__}")
