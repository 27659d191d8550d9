"""Incremental reads: what a job has processed is remembered per reading place."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a bookmark may do.
MODES = ["enable", "pause", "disable"]


class Bookmarks:
    """Bookmarks of one job below a shared folder.

    ``enable`` hands over what is new since the last run and moves the bookmark once that is processed. ``pause`` hands
    over the files modified after ``start`` and up to ``end`` and leaves the bookmark. ``disable`` hands over everything.
    """

    def __init__(self, root: str, job: str, mode: str = "enable", start=None, end=None):
        if mode not in MODES:
            raise ValueError(f"a bookmark mode is one of {MODES}, not {mode!r}")
        given = [start is not None, end is not None]
        if mode == "pause" and not all(given):
            raise ValueError("a paused bookmark needs start and end")
        if mode != "pause" and any(given):
            raise ValueError("only a paused bookmark takes start and end")
        self.root, self.job, self.mode, self.start, self.end = root.rstrip("/"), job, mode, start, end

    def location(self, transformation_ctx: str) -> str:
        """Checkpoint folder of one reading place."""
        if not transformation_ctx:
            raise ValueError("a bookmark needs a transformation_ctx")
        return f"{self.root}/{folder_name(self.job)}/{folder_name(transformation_ctx)}"

    def read(
        self,
        spark: SparkSession,
        transformation_ctx: str,
        path: str,
        format: str,
        schema: T.StructType | str,
        process: Callable[[DataFrame], None],
        **options,
    ) -> None:
        """Call ``process`` with the rows due, as one batch unless options such as ``maxFilesPerTrigger`` cut it."""
        if self.mode == "enable":
            read_incremental(spark, path, format, schema, process, self.location(transformation_ctx), **options)
            return
        df = spark.read.format(format).schema(schema).options(**options).load(path)
        process(df if self.mode == "disable" else modified_between(df, self.start, self.end))


def folder_name(name: str) -> str:
    """Folder name for any text; a digest keeps apart names that differ only in what a folder name cannot hold."""
    clean = re.sub(r"[^A-Za-z0-9_.-]", "_", name)
    return clean if clean == name else f"{clean}-{hashlib.sha256(name.encode()).hexdigest()[:12]}"


def modified_between(df: DataFrame, start, end) -> DataFrame:
    """Rows of a file read whose files were modified after ``start`` and up to ``end``; whole files are skipped."""
    at = F.col("_metadata.file_modification_time")
    return df.where((at > F.lit(start)) & (at <= F.lit(end)))


def read_incremental(
    spark: SparkSession,
    path: str,
    format: str,
    schema: T.StructType | str,
    process: Callable[[DataFrame], None],
    bookmark: str,
    **options,
) -> None:
    """Hand the rows that are new since the last run to ``process``.

    The bookmark is a streaming checkpoint folder. It advances only after ``process`` returned, so a failed run is
    repeated.
    """
    stream = spark.readStream.format(format).schema(schema).options(**options).load(path)
    query = (
        stream.writeStream.foreachBatch(lambda df, _: process(df))
        .option("checkpointLocation", bookmark)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
