"""Two-phase bookmarks, schema-evolving appends, seeded samples, salted joins."""

import datetime
import hashlib
import time

import pytest
from pyspark.sql import functions as F

from flexspark import FlexFrame, FlexReader, FlexWriter
from flexspark.examples.storage import _table, database
from flexspark.operators.hot import frequent_hashes
from flexspark.operators.nest import _unquoted_lines
from flexspark.operators.rows import join_on, merge_rows, union_rows
from flexspark.operators.sample import seeded_sample
from flexspark.sources.ledger import CommitConflict, JobRun
from flexspark.sources.write import fitted


def ids(reader, path, ctx="a", **options):
    return sorted(r.id for r in reader.from_options("file", {"path": path, **options}, "parquet", transformation_ctx=ctx).df.collect())


def put(spark, path, *values):
    spark.createDataFrame([(v,) for v in values], "id long").coalesce(1).write.mode("append").parquet(path)


def test_runs_commit_all_or_nothing(spark, folder):
    path, root = f"{folder}/in", f"{folder}/ledger"
    put(spark, path, 1, 2)
    first = FlexReader(spark, run=JobRun(spark, root, "job"))
    assert ids(first, path) == [1, 2] and ids(first, path) == [1, 2] and ids(first, path, "other place") == [1, 2]
    second = JobRun(spark, root, "job")
    assert ids(FlexReader(spark, run=second), path) == [1, 2]
    late = JobRun(spark, root, "job")
    second.commit()
    with pytest.raises(CommitConflict):
        late.commit()
    put(spark, path, 3)
    third = JobRun(spark, root, "job")
    reader = FlexReader(spark, run=third)
    assert ids(reader, path) == [3]
    assert ids(reader, path, "other place") == [1, 2, 3]  # not read by the run that committed
    third.commit()
    fourth = FlexReader(spark, run=JobRun(spark, root, "job"))
    none = fourth.from_options("file", {"path": path}, "parquet", transformation_ctx="a").df
    assert none.columns == ["id"] and none.count() == 0
    assert ids(FlexReader(spark, run=JobRun(spark, root, "another job")), path) == [1, 2, 3]
    assert ids(FlexReader(spark, run=JobRun(spark, root, "job", "disable")), path) == [1, 2, 3]


def test_pause_and_modes(spark, folder):
    path = f"{folder}/in"
    put(spark, path, 1)
    time.sleep(1.1)
    middle = datetime.datetime.now(datetime.timezone.utc)
    time.sleep(1.1)
    put(spark, path, 2)
    day = datetime.timedelta(days=1)
    run = JobRun(spark, f"{folder}/ledger", "job", "pause", middle - day, middle)
    assert ids(FlexReader(spark, run=run), path) == [1]
    run.commit()
    assert ids(FlexReader(spark, run=JobRun(spark, f"{folder}/ledger", "job")), path) == [1, 2]
    for bad in (("nothing", None, None), ("pause", None, None), ("enable", middle, middle)):
        with pytest.raises(ValueError):
            JobRun(spark, folder, "job", *bad)


def test_partitions_json_and_tables(spark, folder):
    """Partition columns of the folders stay; JSON types come from the new files; a catalog table is read by its new files."""
    path, root = f"{folder}/in", f"{folder}/ledger"
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id long, p string")
    rows.write.partitionBy("p").parquet(path)
    run = JobRun(spark, root, "job")
    reader = FlexReader(spark, run=run)
    assert sorted(map(tuple, reader.from_options("file", {"path": path}, "parquet", transformation_ctx="p").df.collect())) == [(1, "x"), (2, "y")]
    spark.createDataFrame([("old",)], "v string").write.json(f"{folder}/json")
    assert reader.from_options("file", {"path": f"{folder}/json"}, "json", transformation_ctx="j").df.count() == 1
    db, table = database(spark), _table("bookmarked")
    rows.write.saveAsTable(f"{db}.{table}")
    assert reader.from_catalog(db, table, transformation_ctx="t").df.count() == 2
    run.commit()
    rows.where("id = 2").write.mode("append").partitionBy("p").parquet(path)
    spark.createDataFrame([(7,)], "v long").write.mode("append").json(f"{folder}/json")
    rows.where("id = 1").write.mode("append").saveAsTable(f"{db}.{table}")
    reader = FlexReader(spark, run=JobRun(spark, root, "job"))
    assert reader.from_options("file", {"path": path}, "parquet", transformation_ctx="p").df.collect() == [(2, "y")]
    assert dict(reader.from_options("file", {"path": f"{folder}/json"}, "json", transformation_ctx="j").df.dtypes) == {"v": "bigint"}
    assert reader.from_catalog(db, table, transformation_ctx="t").df.collect() == [(1, "x")]


def test_fitted_refuses_what_would_change(spark):
    rows = spark.createDataFrame([("1", 1.0, 5, "2024-01-01"), ("x", 2.5, 2**40, "no date"), (None, None, None, None)], "a string, B double, c long, d string")
    good, bad = fitted(rows, spark.createDataFrame([], "d date, b int, c int, a long, e string").schema)
    assert good.columns == ["d", "b", "c", "a", "e"]
    assert sorted(map(str, map(tuple, good.collect()))) == sorted(map(str, [(datetime.date(2024, 1, 1), 1, 5, 1, None), (None,) * 5]))
    refused = bad.collect()
    assert len(refused) == 1 and refused[0].error_message == "d is not date, b is not int, c is not int, a is not bigint"
    assert fitted(rows, rows.schema)[1] is None
    with pytest.raises(ValueError, match="column s"):
        fitted(rows.select(F.struct("a").alias("s")), spark.createDataFrame([], "s struct<a:int>").schema)


def test_append_evolves_or_raises(spark):
    db, table, writer = database(spark), _table("evolving"), FlexWriter()
    frame = lambda rows, schema: FlexFrame(spark.createDataFrame(rows, schema), "rows")
    writer.from_catalog(frame([(1, "p")], "id long, part string"), db, table, additional_options={"partitionBy": ["part"]})
    with pytest.raises(ValueError, match="more"):
        writer.from_catalog(frame([(2, "q", 1.5)], "id long, part string, more double"), db, table, additional_options={"schema_change": "fail"})
    errors = writer.from_catalog(frame([(1.5, "q", "3"), (float("nan"), "q", "2"), (0.5, "q", "x")], "more double, part string, ID string"), db, table)
    assert errors.name == "rows_errors" and [r.error_message for r in errors.df.collect()] == ["id is not bigint"]
    assert sorted(str(tuple(r)) for r in spark.table(f"{db}.{table}").select("id", "more", "part").collect()) == ["(1, None, 'p')", "(2, nan, 'q')", "(3, 1.5, 'q')"]


def test_seeded_samples(spark):
    rows = spark.createDataFrame([(i, i % 5) for i in range(500)] + [(3, 3)] * 40 + [(None, None)], "k long, v long")
    digest = lambda k: hashlib.md5(f"7:{'' if k is None else k}".encode()).hexdigest()
    want = sorted((digest(r.k), str(r.k)) for r in rows.collect())[:60]
    for parts in (1, 7):
        got = seeded_sample(rows.repartition(parts), 60, 7, ["k"]).collect()
        assert sorted((digest(r.k), str(r.k)) for r in got) == want
    assert seeded_sample(rows, 10_000, 7).count() == 541 and seeded_sample(rows, 0, 7).count() == 0
    assert seeded_sample(rows, 60, 7).collect() != seeded_sample(rows, 60, 8).collect()


@pytest.mark.parametrize("hot_left, hot_right", [(3000, 3), (3, 3000), (300, 300), (0, 0)])
def test_salted_join_equals_plain(spark, hot_left, hot_right):
    left = spark.createDataFrame([(1, i) for i in range(hot_left)] + [(i, -i) for i in range(2, 60)] + [(None, 0)], "k int, a long").repartition(6)
    right = spark.createDataFrame([(1, i) for i in range(hot_right)] + [(i, -i) for i in range(2, 60)] + [(None, 0)], "k long, b long").repartition(6)
    plain, salted = join_on(left, right, "k", "k"), join_on(left, right, "k", "k", salts=8)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    with pytest.raises(ValueError):
        join_on(left, right, "k", "k", "left", salts=8)


def test_salts_split_a_hot_key_that_is_grouped_after(spark):
    """A third of both sides' rows has one key; no joined partition holds more than three times the median."""
    big = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id").repartition(8)
    few = spark.range(60_000).select(F.when(F.col("id") % 20_000 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    assert frequent_hashes(big, [F.col("k")], 0.01) == [spark.range(1).select(F.xxhash64(F.lit(0).cast("long"))).first()[0]]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_on(big, few, "k", "k", salts=16)
        sizes = sorted(r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect())
        assert sum(sizes) == join_on(big, few, "k", "k").count() and sizes[-1] <= 3 * sizes[len(sizes) // 2]
        assert joined.groupBy("k").count().where("k = 0").first()["count"] == 60_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_names_that_differ_in_case_unite(spark):
    a, b = spark.createDataFrame([(1, "x")], "id long, v string"), spark.createDataFrame([("y", 2), ("z", 1)], "V string, ID long")
    assert sorted(map(tuple, union_rows(a, b).collect())) == [(1, "x"), (1, "z"), (2, "y")]
    assert union_rows(a, b).columns == ["id", "v"]
    assert sorted(map(tuple, merge_rows(a, b, "id").collect())) == [(1, "z"), (2, "y")]


def test_csv_lines(spark):
    """Line breaks between quotes stay, an open quote runs to the end, the mark character is text like other; time follows length."""
    texts = ["a,b\r\nc,d", 'a,"b\nc"\nd', 'x\n"open\nto the end', "", "one\n", "m\u001e1n\no\u001e", '"a""b\nc"\nd']
    want = [["a,b", "c,d"], ['a,"b\nc"', "d"], ["x", '"open\nto the end'], [""], ["one", ""], ["m\u001e1n", "o\u001e"], ['"a""b\nc"', "d"]]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", _unquoted_lines(F.col("t")).alias("l"))
    assert [r.l for r in sorted(rows.collect(), key=lambda r: r.i)] == want
    began = time.perf_counter()
    long = spark.range(1).select(F.repeat(F.lit('1,"x"\n'), 200_000).alias("t"))
    assert long.select(F.size(_unquoted_lines(F.col("t")))).first()[0] == 200_001
    assert time.perf_counter() - began < 10
