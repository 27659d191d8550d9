"""A table that takes every micro-batch once, also when the batch is repeated after it was written.

Each attempt at a batch writes its rows to a folder of its own (``rows/attempt-…``). They belong to the table once the batch's file in ``commits``, created only
if it isn't there, names that attempt. A batch that fails before this leaves rows nobody reads; one that fails later, before the stream's checkpoint
remembers it, is repeated and finds its file, so it writes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.sources.bookmarks import folder_name


class BatchSink:
    """The output of one streaming query, by name, below a shared folder. Batch numbers are the query's: a new checkpoint needs a new name."""

    def __init__(self, spark: SparkSession, root: str, query: str, schema: T.StructType):
        self.spark, self.base = spark, f"{root.rstrip('/')}/{folder_name(query)}"
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])

    def _fs(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def committed(self, batch_id: int) -> bool:
        """Whether the batch is in the table. A file without content comes from a run that died while it made it, and doesn't count."""
        fs, path = self._fs(f"commits/{batch_id:010d}")
        return fs.exists(path) and fs.getFileStatus(path).getLen() > 0

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        """Put the batch into the table, unless it is there: whether it was put. A batch of other columns than the table's raises."""
        if sorted(batch.columns) != sorted(self.schema.names):
            raise ValueError(f"the batch has the columns {batch.columns}, the table {self.schema.names}")
        if self.committed(batch_id):
            return False
        attempt = uuid.uuid4().hex
        batch.to(self.schema).write.parquet(f"{self.base}/rows/attempt-{attempt}")
        fs, path = self._fs(f"commits/{batch_id:010d}")
        try:
            out = fs.create(path, fs.exists(path) and not self.committed(batch_id))
        except Exception:
            if self.committed(batch_id):
                return False
            raise
        try:
            out.write(bytearray(f"{attempt}\n", "utf-8"))
        finally:
            out.close()
        return True

    def read(self) -> DataFrame:
        """The rows of all batches committed when this is called."""
        if not all(fs.exists(path) for fs, path in map(self._fs, ("commits", "rows"))):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(f"{self.base}/rows")
        attempt = F.regexp_extract(F.col("_metadata.file_path"), "/attempt-([0-9a-f]+)/[^/]*$", 1)
        known = self.spark.read.text(f"{self.base}/commits").select(F.trim("value").alias("attempt"))
        mark = F.struct(attempt.alias("attempt"), F.struct(*[F.col(f"`{c}`") for c in self.schema.names]).alias("row"))
        return rows.select(mark.alias("x")).select("x.attempt", "x.row").join(known, "attempt", "left_semi").select("row.*")
