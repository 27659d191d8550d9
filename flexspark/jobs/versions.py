"""Roll a table of versioned entities back to a point in time, back it up and restore it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flexspark.frame import FlexFrame, FrameSet
from flexspark.functions.columns import expand_items
from flexspark.operators.nest import nest_rows
from flexspark.operators.rows import latest_per_key, semi_join
from flexspark.plans.paths import top

# Kinds of entities in a backup and the names of the frames they restore to.
ENTITY_KINDS = ["database", "table", "tableVersion", "partition", "tableToDelete", "partitionToDelete"]


def rollback(
    versions: DataFrame,
    parts: DataFrame,
    as_of,
    name: str = "name",
    updated: str = "updateTime",
    part_of: str = "tableName",
    created: str = "creationTime",
) -> FrameSet:
    """What undoes every change after ``as_of``.

    ``restore``: the latest version of each name by then (ties kept). ``delete``: names without a version by then.
    ``delete_parts``: parts of versioned names created after it. The deletes need one row per name, combined map-side; whole
    versions are shuffled for the restore only.
    """
    restore = latest_per_key(versions, name, updated, as_of)
    seen = versions.groupBy(top(name)).agg(F.count_if(top(updated) <= F.lit(as_of)).alias("__by_then"))
    delete = seen.where((F.col("__by_then") == 0) | top(name).isNull()).select(top(name))
    later = parts.where(top(created) > F.lit(as_of))
    owners = versions.select(top(name).alias(part_of))
    delete_parts = semi_join(later, owners, part_of)
    made = {"restore": restore, "delete": delete, "delete_parts": delete_parts}
    return FrameSet([FlexFrame(df, kind) for kind, df in made.items()])


def backup(entities: DataFrame, parts: DataFrame, owner: str, database: str, owner_col: str = "owner",
           name: str = "name", part_of: str = "tableName", pieces: int = 1) -> DataFrame:
    """One owner's entities and their parts, nested into ``items``: rows of ``table, part, items, database, type``.

    Every list comes in at most ``pieces`` rows, told apart by ``part``; a restore reads them in any order. Both frames
    need the same columns.
    """
    mine = entities.where(top(owner_col) == F.lit(owner))
    theirs = semi_join(parts, mine.select(top(name).alias(part_of)), part_of)
    tables = nest_rows(mine, (), pieces).select(F.lit("empty").alias("table"), "part", "items")
    nested = nest_rows(theirs, part_of, pieces).select(top(part_of).cast("string").alias("table"), "part", "items")
    tag = F.lit(database).alias("database")
    return tables.select("*", tag, F.lit("table").alias("type")).union(nested.select("*", tag, F.lit("partition").alias("type")))


def write_backup(saved: DataFrame, path: str, by_type: bool = True) -> None:
    """Backup as JSON, one folder per kind of entity so that a restore reads only the kinds it uses."""
    writer = saved.write.mode("overwrite")
    (writer.partitionBy("type") if by_type else writer).json(path)


def restore(spark: SparkSession, path: str, schema) -> FrameSet:
    """Read a backup, of either layout, and give one frame per kind of entity, items expanded to rows."""
    return restore_frames(spark.read.schema(schema).json(path))


def restore_frames(saved: DataFrame) -> FrameSet:
    frames = {}
    for kind in ENTITY_KINDS:
        frames[kind] = FlexFrame(expand_items(saved.where(F.col("type") == kind).select("items")), kind)
    return FrameSet(frames)
