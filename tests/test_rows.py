import pytest
from pyspark.sql import functions as F

from flexspark.frame import ErrorThresholdExceeded, FlexFrame, FrameSet
from flexspark.operators.rows import count_distinct_tuples, latest_per_key, semi_join, subtract_rows


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_distinct_tuples_count_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, 2), (1, 2)], "a int, b int")
    assert count_distinct_tuples(df, ["a", "b"]).first()[0] == 3


def test_split_rows_partitions_the_input(spark):
    df = spark.createDataFrame([(5,), (10,), (15,), (20,), (None,)], "age int")
    parts = FlexFrame(df).split_rows({"age": {">": 10, "<": 20}}, "in", "out")
    assert rows(parts["in"].df) == [(15,)]
    assert parts["in"].count() + parts["out"].count() == 5
    assert FlexFrame(df).split_rows({"age": {"!=": 5}})["frame2"].count() == 2
    with pytest.raises(ValueError):
        FlexFrame(df).split_rows({"age": {"~": 1}})


def test_join_names_and_nested_keys(spark):
    a = FlexFrame(spark.createDataFrame([(1, (7,), "x")], "id int, k struct<v:int>, t string"), "a")
    b = FlexFrame(spark.createDataFrame([(7, 1, "y")], "v int, id int, right_t string"), "b")
    got = a.join("k.v", ["v"], b)
    assert got.name == "ab" and got.df.columns == ["id", "k", "t", "v", "right_id", "right_t"]
    assert got.count() == 1
    with pytest.raises(ValueError):
        a.join(["id", "t"], "id", b)


def test_merge(spark):
    source = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "id int, v string")
    staged = spark.createDataFrame([(1, "new", 5), (3, "ins", 6)], "id int, v string, extra int")
    once = FlexFrame(source).merge(FlexFrame(staged), "id")
    assert rows(once.df) == rows(spark.createDataFrame([(2, "c", None), (None, "n", None), (1, "new", 5), (3, "ins", 6)], "id int, v string, extra int"))
    assert rows(once.merge(FlexFrame(staged), "id").df) == rows(once.df)


def test_semi_and_subtract(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(semi_join(a, b, "k")) == [(1, "x"), (1, "y")]
    assert rows(subtract_rows(a.select("k"), b)) == [(2,)]


def test_latest_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 9, "c"), (1, 12, "d"), (2, 11, "e")], "k int, t int, v string")
    assert rows(latest_per_key(df, "k", "t", 10)) == [(1, 9, "b"), (1, 9, "c")]
    assert rows(latest_per_key(df, "k", "t").select("v")) == [("d",), ("e",)]


@pytest.fixture
def tight(spark):
    """Sort-merge joins with small partitions, so that skew shows on little data."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k in conf:
        spark.conf.unset(k)


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    n = df.count()
    df.collect()
    return n, df._jdf.queryExecution().executedPlan().toString()


def _hot(spark, n=60_000):
    """One key holds a third of all rows."""
    return spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v")
    )


def test_hot_key_is_split_in_joins(tight):
    hot = _hot(tight)
    keys = tight.range(0, 60_000, 2, numPartitions=8).select(F.col("id").alias("k"))
    n, plan = _final_plan(semi_join(hot, keys.union(keys), "k"))
    assert "isSkew=true" in plan or "skew=true" in plan
    merged = FlexFrame(hot).merge(FlexFrame(keys.where("k > 0").withColumn("v", F.lit("s"))), "k")
    n, plan = _final_plan(merged.df)
    assert n == 20_000 + 20_000 + 29_999
    assert "isSkew=true" in plan or "skew=true" in plan
    joined = FlexFrame(hot).join("k", "k", FlexFrame(keys))
    n, plan = _final_plan(joined.df)
    assert n == 20_000 + 20_000 and ("isSkew=true" in plan or "skew=true" in plan)


def test_hot_key_is_split_when_nesting(tight):
    nested = FlexFrame(_hot(tight).withColumn("n", F.monotonically_increasing_id())).nest("k", 20).df
    parts = nested.where("k = 0").agg(F.count("*"), F.sum(F.size("items"))).first()
    assert parts[1] == 20_000 and parts[0] == 20
    assert nested.where("k = 0").select(F.spark_partition_id()).distinct().count() > 1


def test_latest_spreads_a_hot_key(tight):
    hot = _hot(tight).withColumn("t", F.monotonically_increasing_id())
    plan = latest_per_key(hot, "k", "t")._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" +-:") for line in plan.splitlines()]
    at = {kind: next(i for i, line in enumerate(lines) if line.startswith("WindowGroupLimit") and kind in line) for kind in ("Partial", "Final")}
    exchange = [i for i, line in enumerate(lines) if line.startswith("Exchange")]
    assert len(exchange) == 1 and at["Final"] < exchange[0] < at["Partial"], plan


def test_errors_and_limits(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "n int")

    def odd(r):
        if r.n % 2:
            raise RuntimeError(f"odd {r.n}")
        return {"n": r.n}

    frame = FlexFrame(df, "f").map(odd, "n int", info="first", stage_threshold=5, total_threshold=7)
    frame.assert_error_threshold()
    assert frame.stage_errors_count() == 5 and frame.count() == 5

    def four(r):
        if r.n == 4:
            raise RuntimeError("four")
        return True

    later = frame.filter(four, total_threshold=5)
    assert later.stage_errors_count() == 1 and later.errors_count() == 6
    with pytest.raises(ErrorThresholdExceeded):
        later.assert_error_threshold()
    assert frame.select_fields("n").stage_errors_count() == 0
    with pytest.raises(ErrorThresholdExceeded):
        FlexFrame(df).map(odd, "n int", stageThreshold=4).assertErrorThreshold()
    assert {r["step"] for r in later.errors().df.collect()} == {0, 1}
    assert FlexFrame(df).errors().count() == 0


def test_errors_travel_through_joins(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")

    def fail(r):
        raise RuntimeError("no")

    bad = FlexFrame(df).map(fail, "n int")
    assert FlexFrame(df).union(bad).errors_count() == 2
    assert bad.join("n", "n", bad).errors_count() == 2
    parts = bad.split_rows({"n": {">": 1}})
    assert parts["frame1"].union(parts["frame2"]).errors_count() == 2


def test_user_code_runs_once(spark, folder):
    calls = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([(i,) for i in range(3)], "n int").coalesce(1)

    def odd(r):
        calls.add(1)
        if r.n == 1:
            raise RuntimeError("one")
        return {"n": r.n}

    ways = (
        lambda f: f.filter(odd, stage_threshold=2),
        lambda f: f.map(odd, "n int", total_threshold=1),
        lambda f: f.map(odd, "n int", staging_path=folder),
    )
    for i, way in enumerate(ways):
        frame = way(FlexFrame(df))
        frame.write("file", {"path": f"{folder}/out{i}"}, "parquet")
        assert frame.errors_count() == 1 and frame.count() == 2
        assert calls.value == 3 * (i + 1)
        frame.unpersist()


def test_map_cases(spark):
    df = spark.createDataFrame([(i,) for i in range(6)], "n int")

    def f(r):
        if r.n == 0:
            return None
        if r.n == 1:
            return {}
        if r.n == 2:
            return {"x": "not a number"}
        if r.n == 3:
            raise KeyError("gone")
        return {"x": r.n * 10, "s": {"y": [r.n]}}

    frame = FlexFrame(df).map(f, "x int, s struct<y:array<int>>", persist=True)
    assert sorted(r["x"] for r in frame.df.collect()) == [40, 50]
    messages = {r["record"]: r["error_message"] for r in frame.errors().df.collect()}
    assert set(messages) == {'{"n":0}', '{"n":1}', '{"n":2}', '{"n":3}'}
    assert messages['{"n":0}'] == messages['{"n":1}'] and "no record" in messages['{"n":0}']
    assert frame.count() + frame.errors_count() == 6
    assert frame.steps[-1].cached.is_cached and not frame.unpersist().steps[-1].cached.is_cached


def test_records_are_nested_dicts_with_attributes(spark):
    df = spark.createDataFrame([((1, [("p",)]), {"k": 2}, "[1, \"z\"]")], "s struct<a:int,l:array<struct<b:string>>>, m map<string,int>, j string")
    df = df.select("s", "m", F.parse_json("j").alias("v"))
    got = FlexFrame(df).map(lambda r: {"a": r.s.a, "b": r.s.l[0].b, "m": r.m["k"], "v": str(r.v)}, "a int, b string, m int, v string")
    assert tuple(got.df.first()) == (1, "p", 2, "[1, 'z']")


def test_filter_exceptions(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "n int")

    def keep(r):
        if r.n == 0:
            return r["missing"]
        if r.n == 1:
            return int("x")
        if r.n == 2:
            return "a" + 1
        if r.n == 3:
            raise RuntimeError("broken")
        return True

    frame = FlexFrame(df).filter(keep)
    assert rows(frame.df) == [(4,)]
    assert [r["record"] for r in frame.errors().df.collect()] == ['{"n":3}']
    assert rows(FlexFrame(df).filter(F.col("n") > 3).df) == [(4,)]


def test_map_without_schema(spark, folder):
    df = spark.createDataFrame([(i,) for i in range(4)], "n int")
    frame = FlexFrame(df).map(lambda r: {"v": r.n if r.n % 2 else str(r.n), "l": [r.n]}, staging_path=folder)
    assert frame.schema()["v"].dataType.simpleString() == "choice<bigint,string>"
    assert sorted(r["l"][0] for r in frame.df.collect()) == [0, 1, 2, 3]


def test_frame_sets(spark):
    df = spark.createDataFrame([(1,)], "n int")
    a, b = FlexFrame(df, "a"), FlexFrame(df, "b")
    frames = FrameSet([a, b])
    assert len(frames) == 2 and list(frames.keys()) == ["a", "b"] and frames["a"] is a
    assert frames.select("nope").df.columns == [] and frames.select("nope").count() == 0
    seen = []
    frames.map(lambda f, ctx: seen.append(ctx) or f, "job")
    assert seen == ["job:a", "job:b"]
    flat = frames.flatmap(lambda f, ctx: FrameSet([FlexFrame(f.df, f.name + "1"), FlexFrame(f.df, "same")]))
    assert set(flat.keys()) == {"a1", "b1", "same"}
    assert set(frames.apply(FlexFrame.select_fields, "self", paths="n").keys()) == {"a", "b"}
    for bad in (lambda: FrameSet("x"), lambda: frames.map(lambda f, ctx: 1), lambda: frames.flatmap(lambda f, ctx: 1)):
        with pytest.raises(TypeError):
            bad()


def test_partitions(spark):
    frame = FlexFrame(spark.range(100))
    assert frame.repartition(5).getNumPartitions() == 5
    assert frame.repartition(5).coalesce(2).getNumPartitions() == 2
    assert frame.coalesce(7, shuffle=True).getNumPartitions() == 7
    with pytest.raises(TypeError):
        frame.repartition(2, nonsense=1)
