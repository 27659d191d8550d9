"""Delete old files of a path or a table. Nothing is deleted unless ``dry_run=False``."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.plans.paths import top
from flexspark.sources.listing import bare, list_files, opened, partition_value
from flexspark.sources.read import table_name_of
from flexspark.sources.scratch import new_dir, stage

# Fixed value: hours a file is kept by default.
RETENTION_HOURS = 168
_RESULT = "path string, modified timestamp, ok boolean, message string"


def _cutoff(hours: float, now: datetime.datetime | None):
    at = F.lit(now) if now is not None else F.current_timestamp()
    return at - F.make_interval(secs=F.lit(float(hours) * 3600.0))


def purge_path(
    spark: SparkSession,
    path: str,
    retention_hours: float = RETENTION_HOURS,
    dry_run: bool = True,
    manifest_path: str | None = None,
    now: datetime.datetime | None = None,
) -> DataFrame:
    """Files below a path, at any depth, older than the retention: one row per file with what happened to it.

    Only names and times are read, folder by folder in tasks. Deleting happens once, in tasks; the result is kept in a written table, and with
    ``manifest_path`` also as CSV in ``Success.csv`` and ``Failed.csv``.
    """
    old = list_files(spark, path).select("path", "modified").where(F.col("modified") < _cutoff(retention_hours, now))
    return _delete(old, path, dry_run, manifest_path)


def _delete(old: DataFrame, root: str, dry_run: bool, manifest_path: str | None) -> DataFrame:
    if dry_run:
        return old.select("path", "modified", F.lit(None).cast("boolean").alias("ok"), F.lit("dry run").alias("message"))
    spark = old.sparkSession
    kept = new_dir(spark, "purged")
    old.mapInPandas(_delete_files(root), _RESULT).write.parquet(kept)
    result = spark.read.parquet(kept)
    if manifest_path:
        base = manifest_path.rstrip("/")
        result.where("ok").write.mode("append").option("header", "true").csv(f"{base}/Success.csv")
        result.where("not ok").write.mode("append").option("header", "true").csv(f"{base}/Failed.csv")
    return result


def _delete_files(root: str):
    inside = bare(root).rstrip("/") + "/"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok, messages = [], []
            for uri in pdf["path"]:
                try:
                    if not bare(uri).startswith(inside):
                        raise ValueError("outside the purged path")
                    system, name = opened(uri)
                    system.delete_file(name)
                    ok.append(True)
                    messages.append("")
                except FileNotFoundError:
                    ok.append(True)
                    messages.append("already gone")
                except Exception as e:
                    ok.append(False)
                    messages.append(str(e))
            yield pdf.assign(ok=ok, message=messages)[["path", "modified", "ok", "message"]]

    return run


def purge_table(
    spark: SparkSession,
    database: str,
    table_name: str,
    partition_predicate: str = "",
    retention_hours: float = RETENTION_HOURS,
    dry_run: bool = True,
    manifest_path: str | None = None,
    now: datetime.datetime | None = None,
) -> DataFrame:
    """Old files of a table, or of the partitions a predicate picks. Partitions left without files are dropped.

    Files are listed below the table's location, in tasks, with the partition values in their paths; no row is read.
    """
    table = table_name_of(database, table_name)
    root = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    by = {c.name: c.dataType for c in spark.catalog.listColumns(table) if c.isPartition}
    values = [partition_value(c, T.DataType.fromDDL(t)) for c, t in by.items()]
    files = list_files(spark, root).select("path", "modified", *values)
    if partition_predicate:
        files = files.where(partition_predicate)
    if dry_run or not values:
        old = files.where(F.col("modified") < _cutoff(retention_hours, now))
        result = _delete(old.select("path", "modified"), root, dry_run, manifest_path)
    else:
        files = stage(files, "listed")
        old = files.where(F.col("modified") < _cutoff(retention_hours, now))
        result = _delete(old.select("path", "modified"), root, dry_run, manifest_path)
        _drop_emptied(spark, table, files, result, list(by))
    if not dry_run:
        spark.catalog.refreshTable(table)
    return result


def _drop_emptied(spark: SparkSession, table: str, files: DataFrame, result: DataFrame, by: list[str]) -> None:
    """Drop the partitions whose listed files are all deleted, some at a time: as many as there are partitions."""
    gone = result.where("ok").select("path", F.lit(1).alias("deleted"))
    counts = files.join(gone, "path", "left").groupBy(*[top(c) for c in by]).agg(F.count("*").alias("n"), F.count("deleted").alias("d"))
    specs: list[str] = []
    for row in counts.where("n = d").select(*[top(c).cast("string").alias(c) for c in by]).toLocalIterator():
        specs.append("PARTITION (" + ", ".join(f"`{c}` = {_literal(row[c])}" for c in by) + ")")
        if len(specs) == 100:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")
            specs = []
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs)}")


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
