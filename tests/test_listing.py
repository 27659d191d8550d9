"""Listing in tasks against Spark's own listing."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.sources.listing import list_files, partition_value


def test_equals_sparks_listing(spark, folder):
    """A tree of mixed depth, with hidden and odd names, empty folders and partition folders."""
    names = ["a.txt", "b c.txt", "deep/er/and/deeper/x", "deep/y", "p=1/_q=2/z", "p=a%20b/w+1", ".hidden/no", "_temporary/no", "deep/_SUCCESS", "deep/.crc", "é/ü"]
    for n in names:
        os.makedirs(os.path.dirname(f"{folder}/tree/{n}"), exist_ok=True)
        with open(f"{folder}/tree/{n}", "w") as f:
            f.write(n)
    os.makedirs(f"{folder}/tree/empty/more")
    theirs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/tree").select("path", "length", F.unix_millis("modificationTime"))
    ours = list_files(spark, f"{folder}/tree").select("path", "length", F.unix_millis("modified"))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))
    assert ours.count() == 7
    assert list_files(spark, f"file://{folder}/tree/deep/y").select("path").collect() == [(f"file:{folder}/tree/deep/y",)]
    assert list_files(spark, f"{folder}/tree/empty").count() == 0 == list_files(spark, f"{folder}/nowhere").count()


def test_partition_values(spark):
    paths = [("file:/t/p=a%20b+c/q=7/f",), ("file:/t/p=__HIVE_DEFAULT_PARTITION__/q=-1/f",)]
    rows = spark.createDataFrame(paths, "path string").select(partition_value("p", T.StringType()), partition_value("q", T.IntegerType())).collect()
    assert sorted(map(tuple, rows), key=str) == [("a b+c", 7), (None, -1)]
