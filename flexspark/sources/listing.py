"""Files below a folder, listed by tasks: the names of a large tree never meet on the driver."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.sources.scratch import stage

_ENTRIES = "path string, folder boolean, modified timestamp, length long"
# Fixed value: how a null partition value is spelt in a path.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def bare(uri: str) -> str:
    """Path of a URI without scheme and doubled slashes."""
    text = uri.split(":", 1)[1] if ":" in uri.split("/", 1)[0] else uri
    return "/" + text.lstrip("/")


def opened(uri: str):
    """The file system of a URI and its path there."""
    from pyarrow import fs

    scheme = uri.split(":", 1)[0] if ":" in uri.split("/", 1)[0] else "file"
    return (fs.LocalFileSystem(), bare(uri)) if scheme == "file" else fs.FileSystem.from_uri(uri)


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What stands in each folder, hidden names left out as Spark's readers do; a file stands for itself, a folder that went meanwhile for nothing."""
    from pyarrow import fs

    for pdf in batches:
        for uri in pdf["path"]:
            system, path = opened(uri)
            info = system.get_file_info(path)
            if info.type == fs.FileType.NotFound:
                continue
            if info.type == fs.FileType.File:
                found = [(uri, info)]
            else:
                found = [(f"{uri.rstrip('/')}/{i.base_name}", i) for i in system.get_file_info(fs.FileSelector(path)) if not (i.base_name.startswith(".") or i.base_name.startswith("_") and "=" not in i.base_name)]
            for at in range(0, len(found), 10_000):
                some = found[at : at + 10_000]
                yield pd.DataFrame({"path": [u for u, _ in some], "folder": [i.type == fs.FileType.Directory for _, i in some], "modified": pd.Series([i.mtime for _, i in some], dtype="datetime64[ns, UTC]"), "length": [i.size or 0 for _, i in some]})


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, modified, length) of all files below a folder, at any depth, or of the file itself.

    One round a level: its folders are rows, tasks list them, and what they find is written; the folders among it are the next round. Stores that only
    Spark can open are listed by Spark's own reader, on the driver.
    """
    try:
        opened(root)
    except (pa.ArrowException, OSError, NotImplementedError):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        return files.select("path", F.col("modificationTime").alias("modified"), "length")
    uri = root if ":" in root.split("/", 1)[0] else f"file:{bare(root)}"
    uri = f"file:{bare(uri)}" if uri.startswith("file:") else uri
    rounds, frontier = [], spark.createDataFrame([(uri.rstrip("/"),)], "path string")
    while True:
        found = stage(frontier.mapInPandas(_entries, _ENTRIES), "listing")
        rounds.append(found.where("not folder").select("path", "modified", "length"))
        folders = found.where("folder").select("path")
        if folders.isEmpty():
            return reduce(DataFrame.unionAll, rounds)
        frontier = folders.repartition("path")


def partition_value(name: str, kind: T.DataType) -> Column:
    """A partition column's value from the column ``path``."""
    text = F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
    plain = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(text != NULL_PARTITION, plain).cast(kind).alias(name)
