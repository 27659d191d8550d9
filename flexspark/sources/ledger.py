"""Job bookmarks in two phases: readers take the files that no committed run took; ``commit`` publishes a run's files, all sources at once.

Below ``root/job`` each run writes the files it took (``taken/ctx=…/run=…``). They count once the run's id stands in a file of ``commits``: such files are
numbered, each is created only if it isn't there, and one of them publishes everything the run took. A run that dies before it commits leaves nothing that
counts, so the next run takes the same files again; of two runs at once, the second to commit fails.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flexspark.sources.bookmarks import MODES, folder_name

FILES = "path string, modified timestamp, length long"


class CommitConflict(RuntimeError):
    """Another run of the job committed since this one began."""


class JobRun:
    """One run of a job, given to :class:`~flexspark.sources.read.FlexReader` as ``run``; its reads name a ``transformation_ctx``.

    ``enable``: a read gives the rows of files that are new or changed (by time or length) since the committed runs. ``pause``: of files modified after
    ``start`` and up to ``end``; nothing is remembered. ``disable``: of all files.
    """

    def __init__(self, spark: SparkSession, root: str, job: str, mode: str = "enable", start=None, end=None):
        if mode not in MODES:
            raise ValueError(f"a bookmark mode is one of {MODES}, not {mode!r}")
        if (mode == "pause") != (start is not None and end is not None) or (mode != "pause" and (start, end) != (None, None)):
            raise ValueError("a paused bookmark, and only that, has start and end")
        self.spark, self.mode, self.start, self.end = spark, mode, start, end
        self.base = f"{root.rstrip('/')}/{folder_name(job)}"
        self.id = uuid.uuid4().hex
        self._taken: dict[str, list[str]] = {}
        self._number = self._commits()

    def due(self, transformation_ctx: str, paths: list[str]) -> list[str]:
        """The files to read at one reading place; asked again in the same run, the same ones."""
        if not transformation_ctx:
            raise ValueError("a bookmark needs a transformation_ctx")
        if transformation_ctx in self._taken:
            return self._taken[transformation_ctx]
        found = listed(self.spark, paths)
        if self.mode == "enable":
            target = f"{self.base}/taken/ctx={folder_name(transformation_ctx)}/run={self.id}"
            known = self._known(transformation_ctx)
            new = found if known is None else found.join(known, ["path", "modified", "length"], "left_anti")
            new.write.parquet(target)
            found = self.spark.read.schema(FILES).parquet(target)
        elif self.mode == "pause":
            found = found.where((F.col("modified") > F.lit(self.start)) & (F.col("modified") <= F.lit(self.end)))
        # the names of the files of one read, as Spark's own readers hold them
        names = sorted(r["path"] for r in found.select("path").collect())
        self._taken[transformation_ctx] = names
        return names

    def commit(self) -> None:
        """Publish what this run took. Does nothing unless the mode is ``enable``; a run commits once."""
        if self.mode != "enable":
            return
        fs, path = self._fs(f"{self.base}/commits/{self._number:010d}")
        try:
            out = fs.create(path, False)
        except Exception as e:
            if fs.exists(path):
                raise CommitConflict(f"run {self._number} of the job is committed already") from e
            raise
        try:
            out.write(bytearray(f"{self.id}\n", "utf-8"))
        finally:
            out.close()

    def _fs(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _commits(self) -> int:
        """How many runs are committed: the number of the next one."""
        fs, path = self._fs(f"{self.base}/commits")
        if not fs.exists(path):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return max([int(n) + 1 for n in names if n.isdigit()], default=0)

    def _known(self, transformation_ctx: str) -> DataFrame | None:
        """Files that committed runs took at this place, as of the beginning of this run."""
        where = f"{self.base}/taken/ctx={folder_name(transformation_ctx)}"
        fs, path = self._fs(where)
        if not self._number or not fs.exists(path):
            return None
        taken = self.spark.read.schema(f"{FILES}, run string").parquet(where)
        runs = self.spark.read.text(f"{self.base}/commits").where(F.regexp_extract(F.col("_metadata.file_name"), "^[0-9]+$", 0).cast("int") < self._number)
        return taken.join(runs.select(F.trim("value").alias("run")), "run", "left_semi").drop("run").distinct()


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, modified, length) of all data files below the paths; no content is read."""
    one = lambda p: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p)
    every = reduce(DataFrame.unionByName, [one(p).select("path", F.col("modificationTime").alias("modified"), "length") for p in paths])
    return every.distinct() if len(paths) > 1 else every
