import datetime
import os
import time

import pytest
from pyspark.sql import functions as F

from flexspark.frame import ErrorThresholdExceeded, FlexFrame, FrameSet
from flexspark.sources.bookmarks import Bookmarks
from flexspark.sources.jdbc import jdbc_options
from flexspark.sources.purge import purge_path
from flexspark.sources.read import FlexDataFrameReader, FlexReader, frame_name, table_name_of
from flexspark.sources.write import FlexWriter, stamped, storable
from flexspark.streaming.batches import for_each_batch, sample_stream, window_ms
from flexspark.streaming.sink import BatchSink


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_names():
    assert table_name_of("d", "t") == "`d`.`t`" == table_name_of(None, "t", "d")
    for bad in ((None, "t"), ("d", None), ("d", "t", "d")):
        with pytest.raises(ValueError):
            table_name_of(*bad)
    assert frame_name({"paths": ["store://b/in/a", "store://b/in/b"]}) == "a"
    assert frame_name({"path": "/in/days/x.csv.gz"}) == "x" and frame_name({"paths": ["/in/days/*"]}) == "days"
    assert frame_name({}) != frame_name({})
    assert stamped("x/a.b.csv", datetime.datetime(2024, 1, 2, 3, 4)) == "x/a.b_2024-01-02-03_04.csv"


def test_lzo_needs_a_format(spark):
    with pytest.raises(ValueError):
        FlexReader(spark).from_options("file", {"paths": ["x"], "compressionType": "lzo"})


def test_json_with_bad_lines(spark, folder):
    with open(folder + "/a.json", "w") as f:
        f.write('{"a":1}\n\n{"a":"x","b":[1]}\nnot json\n7\nnull\n[{"a":2},{"a":true},"no"]\n')
    frame = FlexReader(spark).from_options("file", {"paths": [folder]}, "JSON")
    assert frame.count() == 4 and frame.schema()["a"].dataType.simpleString() == "choice<boolean,bigint,string>"
    assert sorted(r["record"] for r in frame.errors().df.collect()) == ['"no"', "7", "not json", "null"]
    raw = FlexReader(spark).json([folder], discover_types=False)
    assert raw.count() == 4 and raw.errors_count() == 4
    fixed = FlexReader(spark).from_options("file", {"paths": [folder]}, "json", schema="a string")
    assert rows(fixed.df) == [("1",), ("2",), ("true",), ("x",)] and fixed.errors_count() == 4


def test_json_partitions(spark, folder):
    spark.createDataFrame([(1, "x", 7), (2, "y", 8), (3, "x", 9)], "a int, p string, q int").write.partitionBy("p", "q").json(folder + "/t")
    read = FlexReader(spark)
    whole = read.from_options("file", {"paths": [folder + "/t"]}, "json")
    assert sorted(whole.df.columns) == ["a", "p", "q"] and whole.count() == 3
    with open(folder + "/t/p=y/q=8/bad.json", "w") as f:
        f.write('{"a":"not a number","z":1}\n')
    some = read.from_options("file", {"paths": [folder + "/t"]}, "json", push_down_predicate="p = 'x' AND (q > 7 or a = 1) and a < 3")
    assert rows(some.df.select("a", "p", "q")) == [(1, "x", 7)]
    assert "z" not in some.df.columns and some.schema()["a"].dataType.simpleString() == "bigint"


def test_streams_of_several_paths(spark, folder):
    for i in range(2):
        spark.createDataFrame([(i,)], "a int").write.parquet(f"{folder}/s{i}")
    stream = FlexDataFrameReader(spark).from_options("file", {"paths": [f"{folder}/s0", f"{folder}/s1"]}, "parquet", schema="a int")
    seen = []
    for_each_batch(stream, lambda b, i: seen.extend(r.a for r in b.collect()), "availableNow", folder + "/state")
    assert sorted(seen) == [0, 1]


def test_scratch(spark, folder):
    from flexspark.sources import scratch

    class Remote:
        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        scratch.scratch_root(Remote)
    made, scratch._MADE[:] = list(scratch._MADE), []
    path = scratch.new_dir(spark, "x", folder)
    spark.range(3).write.parquet(path)
    assert scratch.clear(spark) == 1 and not os.path.exists(path) and scratch.clear(spark) == 0
    scratch._MADE[:] = made
    typed = FlexReader(spark).from_options("file", {"paths": [folder]}, "json", {"mode": "DROPMALFORMED"}, schema="a string")
    assert typed.df.columns == ["a"] and typed.errors_count() == 0


def test_multi_line_json(spark, folder):
    with open(folder + "/a.json", "w") as f:
        f.write('[{"a":\n1},{"a":"x"}]')
    frame = FlexReader(spark).from_options("file", {"paths": [folder]}, "json", {"multiLine": True})
    assert frame.count() == 2 and frame.schema()["a"].dataType.simpleString() == "choice<bigint,string>"


def test_json_is_parsed_by_the_scan_only(spark, folder):
    with open(folder + "/a.json", "w") as f:
        f.write('{"a":1}\nbroken\n')
    frame = FlexReader(spark).from_options("file", {"paths": [folder]}, "json")
    plan = frame.df._jdf.queryExecution().executedPlan().toString()
    assert "SchemaOfVariant" not in plan and "parseJson" not in plan
    assert frame.count() == 1 and frame.errors().df.first()["record"] == "broken"


def test_choices_reach_every_format(spark, folder):
    df = spark.createDataFrame([(1, '"x"'), (2, '{"k":1}')], "id int, j string").select("id", F.parse_json("j").alias("v"), F.lit(None).alias("gone"), F.array("id").alias("l"))
    for kind in ("parquet", "json", "orc", "csv"):
        refused = FlexFrame(df, "n").write("file", {"path": f"{folder}/{kind}"}, kind)
        assert refused.name == "n_errors" and refused.count() == 0
        assert spark.read.format(kind).load(f"{folder}/{kind}").count() == 2
    assert storable(df, "csv").dtypes == [("id", "int"), ("v", "string"), ("l", "string")]
    assert storable(df, "orc").dtypes == [("id", "int"), ("v", "string"), ("l", "array<int>")]


def test_sink_checks(spark, folder):
    frame = FlexFrame(spark.createDataFrame([(1,), (2,)], "n int"), "f")
    with pytest.raises(TypeError):
        FlexWriter().from_options(frame.df, "file", {"path": folder}, "json")
    with pytest.raises(ValueError):
        frame.write("file", {"path": folder})

    def fail(r):
        raise RuntimeError("no")

    limited = frame.map(fail, "n int", stage_threshold=1)
    with pytest.raises(ErrorThresholdExceeded):
        limited.write("file", {"path": folder + "/never"}, "json")
    assert not os.path.exists(folder + "/never")


def test_required_fields_divert(spark, folder):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "n string, t string")
    refused = FlexFrame(df, "f").write("file", {"path": folder + "/o", "required": {"n": "int"}, "mode": "overwrite"}, "parquet")
    assert rows(spark.read.parquet(folder + "/o")) == [(1, "a")]
    assert sorted(r["record"] for r in refused.df.collect()) == ['{"n":"x","t":"b"}', '{"t":"c"}']


def test_sets_write_by_name(spark, folder):
    df = spark.createDataFrame([(1,)], "n int")
    FlexWriter().from_options(FrameSet([FlexFrame(df, "a"), FlexFrame(df, "b")]), "file", {"path": folder}, "json")
    assert {"a", "b"} <= set(os.listdir(folder))


def test_spigot(spark, folder):
    frame = FlexFrame(spark.range(100))
    assert frame.spigot(folder + "/s", {"topk": 7}).count() == 100
    assert spark.read.json(folder + "/s").count() == 7


def test_jdbc_options():
    base = {"url": "jdbc:x", "user": "u", "vendor": "v", "dbtable": "t"}
    assert jdbc_options(base) == {"url": "jdbc:x", "user": "u", "dbtable": "t"}
    split = {**base, "partitionColumn": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    assert jdbc_options(split)["numPartitions"] == "3"
    for bad in ({"dbtable": "t"}, {"url": "x"}, {**base, "query": "q"}, {**base, "partitionColumn": "id"}):
        with pytest.raises(ValueError):
            jdbc_options(bad)


def test_purge_keeps_new_files(spark, folder):
    data = folder + "/data"
    spark.range(10).repartition(2).write.parquet(data + "/deep")
    old = [f for f in os.listdir(data + "/deep") if f.endswith(".parquet")][0]
    long_ago = time.time() - 10 * 24 * 3600
    os.utime(f"{data}/deep/{old}", (long_ago, long_ago))
    assert purge_path(spark, data).count() == 1 and os.path.exists(f"{data}/deep/{old}")
    done = purge_path(spark, data, dry_run=False, manifest_path=folder + "/manifest")
    assert [r["ok"] for r in done.collect()] == [True]
    assert not os.path.exists(f"{data}/deep/{old}")
    assert len([f for f in os.listdir(data + "/deep") if f.endswith(".parquet")]) == 1
    listed = spark.read.option("header", "true").csv(folder + "/manifest/Success.csv")
    assert listed.first()["path"].endswith(old)


def test_window_sizes():
    assert window_ms("10 seconds") == 10_000 and window_ms(" 2 Minute ") == 120_000 and window_ms("1 hour") == 3_600_000
    for bad in (5, "10", "ten seconds", "1 day", "1 2 seconds"):
        with pytest.raises(ValueError):
            window_ms(bad)


@pytest.fixture
def stream(spark, folder):
    spark.range(40).repartition(4).write.parquet(folder + "/in")
    return FlexDataFrameReader(spark).from_options("file", {"path": folder + "/in"}, "parquet", {"maxFilesPerTrigger": 1}, "id bigint")


def test_for_each_batch_retries(stream, folder):
    calls, waits = [], []

    def process(df, i):
        calls.append(i)
        if len(calls) in (2, 3, 5):
            raise RuntimeError("again")
        df.count()

    metrics = for_each_batch(stream, process, "availableNow", folder + "/c", wait=waits.append)
    assert calls == [0, 1, 1, 1, 2, 2, 3] and waits == [1, 2, 1]
    assert [m["batch"] for m in metrics] == [0, 1, 2, 3] and sum(m["rows"] for m in metrics) == 40


def test_for_each_batch_gives_up(stream, folder):
    def process(df, i):
        raise RuntimeError("always")

    waits = []
    with pytest.raises(Exception, match="always"):
        for_each_batch(stream, process, "availableNow", folder + "/c", batch_max_retries=4, persist=False, wait=waits.append)
    assert waits == [1, 2, 5, 5]


def test_lost_checkpoint_metadata_is_never_retried(stream, folder):
    calls = []

    def process(df, i):
        calls.append(i)
        raise RuntimeError("CheckpointMetadataNotFound: gone")

    with pytest.raises(Exception, match="gone"):
        for_each_batch(stream, process, "availableNow", folder + "/c", wait=lambda s: calls.append("waited"))
    assert calls == [0]


def test_batch_metrics_are_live_and_bounded(stream, folder, monkeypatch):
    from flexspark.streaming import batches

    monkeypatch.setattr(batches, "METRICS_KEPT", 2)
    live = []
    kept = for_each_batch(stream, lambda df, i: live.append(i), "availableNow", folder + "/c", on_batch=lambda m: live.append(m["rows"]))
    assert live[0] == 0 and len(live) == 8 and [m["batch"] for m in kept] == [2, 3]


def test_sink_takes_every_batch_once(spark, stream, folder):
    sink = BatchSink(spark, folder + "/t", "ids", stream.schema)
    assert sink.read().count() == 0 and sink.read().schema.names == ["id"]
    tried = []

    def process(df, i):
        tried.append(i)
        put = sink.write(df, i)
        if tried.count(i) == 1 and i in (1, 2):
            assert put
            raise RuntimeError("after the commit, before the checkpoint's")
        assert put == (i not in (1, 2))

    for_each_batch(stream, process, "availableNow", folder + "/c", wait=lambda s: None)
    assert tried == [0, 1, 1, 2, 2, 3]
    assert sorted(r.id for r in sink.read().collect()) == list(range(40))


def test_sink_reads_only_what_is_committed(spark, folder):
    sink = BatchSink(spark, folder + "/t", "a/b", spark.createDataFrame([], "row long, attempt string").schema)
    rows = spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], sink.schema)
    assert sink.write(rows, 7) and not sink.write(rows, 7)
    rows.write.parquet(f"{sink.base}/rows/attempt-{5:032x}")  # of a run that died before its commit
    assert sorted(map(tuple, sink.read().collect()), key=str) == [(1, "x"), (1, "x"), (None, None)]
    open(f"{sink.base}/commits/0000000008", "w").close()  # of a run that died in its commit
    assert not sink.committed(8) and sink.write(rows, 8) and sink.read().count() == 6
    with pytest.raises(ValueError, match="columns"):
        sink.write(rows.withColumn("more", F.lit(1)), 9)
    assert sink.write(rows.limit(0), 9) and sink.read().count() == 6


def test_for_each_batch_arguments(stream, folder):
    nothing = lambda df, i: None
    for kwargs in ({"window_size": None, "checkpoint_location": "c"}, {"window_size": "1 second", "checkpoint_location": None},
                   {"window_size": "1 second", "checkpoint_location": "c", "batch_max_retries": 101}):
        with pytest.raises(ValueError):
            for_each_batch(stream, nothing, **kwargs)


def test_sample_stream(stream):
    seen = []
    frame = sample_stream(stream, "1 second", 9000, 15, lambda df, i: seen.append(i))
    assert frame.count() == 15 and seen
    with pytest.raises(ValueError):
        sample_stream(stream, "20 seconds")


def test_bookmarks(spark, folder):
    got, schema = [], spark.range(1).schema

    def run(mode="enable", **kwargs):
        marks = Bookmarks(folder + "/marks", "nightly job", mode, **kwargs)
        marks.read(spark, "ids", folder + "/in", "parquet", schema, lambda df: got.append(df.count()))

    spark.range(5).write.parquet(folder + "/in")
    run()
    run()
    spark.range(7).write.mode("append").parquet(folder + "/in")
    run()
    run("disable")
    now, day = datetime.datetime.now(datetime.timezone.utc), datetime.timedelta(days=1)
    run("pause", start=now - day, end=now + day)
    run("pause", start=now - 2 * day, end=now - day)
    run()
    assert got == [5, 7, 12, 12, 0]


def test_bookmark_arguments(folder):
    for kwargs in ({"mode": "stop"}, {"mode": "pause"}, {"mode": "pause", "start": 1}, {"start": 1, "end": 2}, {"mode": "disable", "end": 2}):
        with pytest.raises(ValueError):
            Bookmarks(folder, "j", **kwargs)
    assert Bookmarks("/b/", "my-job").location("a_b") == "/b/my-job/a_b"
    assert Bookmarks("/b/", "my-job").location("a/b") not in ("/b/my-job/a_b", Bookmarks("/b", "my-job").location("a b"))
    with pytest.raises(ValueError):
        Bookmarks(folder, "j").location("")


def test_a_failed_run_is_repeated(spark, folder):
    spark.range(5).write.parquet(folder + "/in")
    got = []

    def process(df):
        got.append(df.count())
        if len(got) == 1:
            raise RuntimeError("lost")

    for _ in range(2):
        try:
            Bookmarks(folder + "/m", "j").read(spark, "c", folder + "/in", "parquet", "id bigint", process)
        except Exception:
            pass
    assert got == [5, 5]


def test_staged_json_is_parsed_once(spark, folder):
    lines = ['{"a": 1, "b": "{\\"x\\": 1}"}', '{"a": "t", "b": "{"}', "{", "[1]", '{"a": null}']
    spark.createDataFrame([(v,) for v in lines], "value string").write.text(f"{folder}/in/p=1")
    spark.createDataFrame([('{"a": 2.5, "b": "{}"}',)], "value string").write.text(f"{folder}/in/p=2")
    plain = FlexReader(spark).json([f"{folder}/in"])
    held = FlexReader(spark).from_options("file", {"paths": [f"{folder}/in"]}, "json", staging_path=f"{folder}/stage")
    assert held.df.schema == plain.df.schema and held.schema() == plain.schema()
    shown = lambda df: sorted(map(repr, df.select(F.to_json(F.struct("*"))).collect()))
    assert shown(held.df) == shown(plain.df) and shown(held.errors().df) == shown(plain.errors().df)
    opened = held.unbox("b", "json", "x int", staging_path=f"{folder}/stage", stage_threshold=1, total_threshold=4)
    for df in (opened.df, opened.errors().df):
        assert all("/stage/" in f for f in df.inputFiles())
    opened.write("file", {"path": f"{folder}/out"}, "parquet")
    pruned = FlexReader(spark).from_options("file", {"paths": [f"{folder}/in"]}, "json", push_down_predicate="p = 2", staging_path=f"{folder}/stage")
    assert pruned.df.count() == 1 and pruned.errors_count() == 0
    late = FlexReader(spark).from_options("file", {"paths": [f"{folder}/in"]}, "json", staging_path=f"{folder}/stage").filter("p = 1", total_threshold=1)
    with pytest.raises(ErrorThresholdExceeded):
        late.write("file", {"path": f"{folder}/never"}, "parquet")
    assert not os.path.exists(f"{folder}/never")
