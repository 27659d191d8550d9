"""Where intermediate tables go: the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="flexspark-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder; a temporary one only in a session known to run in this process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", None) or ""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


def new_dir(spark: SparkSession, kind: str, under: str | None = None) -> str:
    """Unused folder below the shared one (or below ``under``)."""
    path = f"{(under or scratch_root(spark)).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def stage(df: DataFrame, kind: str = "stage", under: str | None = None) -> DataFrame:
    """Write once and read back: later uses see the same rows, and lost executors cost nothing to redo."""
    path = new_dir(df.sparkSession, kind, under)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Remove every folder this process made here; frames that read them can't be used any more. Returns how many there were."""
    gone = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return gone
