"""Projection, nesting and column functions on small frames."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.examples import projection
from flexspark.frame import FlexFrame
from flexspark.functions.columns import add_ingestion_time_columns, explode_with_index, named_struct, replace_array_element
from flexspark.operators.nest import FILE_ROW, nest_rows, relationalize, unnest
from flexspark.operators.project import apply_mapping, drop_fields, rename_field, select_fields, split_fields


@pytest.fixture
def nested(spark):
    return spark.createDataFrame(
        [(1, (10, ("x", None)), [(1, "p"), (2, "q")], 5), (2, None, None, None), (3, (30, None), [], 7)],
        "id int, o struct<a:int,p:struct<s:string,t:string>>, arr array<struct<k:int,l:string>>, `d.t` int",
    )


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_select_keeps_nesting_and_nulls(nested):
    df = select_fields(nested, ["o.p.s", "arr.k", "`d.t`"])
    assert df.schema.simpleString() == "struct<o:struct<p:struct<s:string>>,arr:array<struct<k:int>>,d.t:int>"
    got = df.collect()
    assert got[1]["o"] is None and got[2]["o"]["p"] is None and got[0]["arr"][1]["k"] == 2
    with pytest.raises(ValueError):
        select_fields(nested, "o.nope")


def test_drop_through_arrays(nested):
    df = drop_fields(nested, ["arr[].l", "o.p.t", "`d.t`", "not.there"])
    assert df.schema.simpleString() == "struct<id:int,o:struct<a:int,p:struct<s:string>>,arr:array<struct<k:int>>>"
    assert drop_fields(nested, ["o.a", "o.p"]).columns == ["id", "arr", "d.t"]
    assert drop_fields(nested, ["o", "o.a"]).columns == ["id", "arr", "d.t"]


def test_drop_reads_only_kept_leaves(spark, nested, folder):
    nested.write.parquet(folder + "/t")
    plan = drop_fields(spark.read.parquet(folder + "/t"), "o.p.t")._jdf.queryExecution().executedPlan().toString()
    assert "p:struct<s:string>" in plan and "t:string" not in plan


def test_rename_and_move(nested):
    assert rename_field(nested, "o.a", "o.z").schema["o"].dataType.names == ["z", "p"]
    assert rename_field(nested, "arr.k", "arr.key").schema["arr"].dataType.elementType.names == ["key", "l"]
    assert rename_field(nested, "id", "`d.t`").columns == ["d.t", "o", "arr"]
    assert rename_field(nested, "id", "ID").columns == ["ID", "o", "arr", "d.t"]
    moved = rename_field(nested, "o.a", "o.p.new")
    assert moved.schema["o"].dataType.simpleString() == "struct<p:struct<s:string,t:string,new:int>>"
    assert moved.collect()[0]["o"]["p"]["new"] == 10
    deep = rename_field(nested, "`d.t`", "x.y.z")
    assert deep.collect()[0]["x"]["y"]["z"] == 5 and "d.t" not in deep.columns
    with pytest.raises(ValueError):
        rename_field(nested, "arr.k", "out")


def test_split_fields(nested):
    a, b = split_fields(nested, ["id", "o.a"])
    assert a.columns == ["id", "o"] and b.schema["o"].dataType.names == ["p"]
    both = FlexFrame(nested, "f").split_fields("id")
    assert set(both.keys()) == {"f1", "f2"}


def test_mapping(nested):
    df = apply_mapping(nested, [("ID", "key"), ("o.a", "int", "n.a", "string"), ("o.p.s", "n.s"), ("arr.k", "ks", "long")])
    assert df.schema.simpleString() == "struct<key:int,n:struct<a:string,s:string>,ks:array<bigint>>"
    assert df.collect()[0]["ks"] == [1, 2]
    with pytest.raises(TypeError):
        apply_mapping(nested, [["id", "x"]])
    with pytest.raises(ValueError):
        apply_mapping(nested, [("id",)])
    with pytest.raises(ValueError):
        apply_mapping(nested, [("ID", "x")], case_sensitive=True)


def test_mapping_misfits_become_null(spark):
    df = spark.createDataFrame([("7",), ("x",)], "s string")
    assert rows(apply_mapping(df, [("s", "string", "n", "int")])) == [(7,), (None,)]


def test_unnest(spark, nested):
    flat = unnest(nested, key_cols="id")
    assert flat.columns == ["id", "o.a", "o.p.s", "o.p.t", "arr", "d.t"]
    assert rows(flat.select("arr")) == [(1,), (None,), (3,)]
    assert unnest(drop_fields(nested, "arr")).columns == ["id", "o.a", "o.p.s", "o.p.t", "d.t"]


def test_relationalize_arrays_of_arrays(spark, folder):
    df = spark.createDataFrame(
        [(1, [[1, 2], [], None], {"a": 1}), (2, [], None), (3, None, {})], "id int, m array<array<int>>, p map<string,int>"
    )
    for tables in (relationalize(df, "r", key_cols="id"), relationalize(df, "r", folder)):
        assert set(tables) == {"r", "r_m", "r_m_val", "r_p"}
        root, m, val = tables["r"], tables["r_m"], tables["r_m_val"]
        lengths = root.join(m, root.m == m.id, "left").groupBy(root.id).agg(F.count("index").alias("n"))
        assert dict(rows(lengths)) == {1: 3, 2: 0, 3: 0}
        again = m.join(val, m.val == val.id).select(m["index"], val["index"].alias("i"), val["val"])
        assert sorted(rows(again)) == [(0, 0, 1), (0, 1, 2)]
        assert rows(root.where("id = 3").select("m")) == [(None,)]
        assert rows(tables["r_p"].select("`val.key`", "`val.value`")) == [("a", 1)]
    with pytest.raises(RuntimeError):
        relationalize(df)


def test_repeated_and_null_keys_stay_apart(spark, folder):
    df = spark.createDataFrame([(1, [10, 11]), (1, [12]), (None, [13]), (None, [14, 15]), (2, None)], "id int, p array<int>")
    for path in (None, folder):
        tables = relationalize(df, "r", path, key_cols="id")
        joined = tables["r"].join(tables["r_p"].withColumnRenamed("id", "key"), F.col("p") == F.col("key"))
        assert sorted(rows(joined.select("id", "index", "val")), key=str) == sorted([(1, 0, 10), (1, 1, 11), (1, 0, 12), (None, 0, 13), (None, 0, 14), (None, 1, 15)], key=str)
    assert rows(relationalize(df.where("id = 2"), "r", key_cols="id")["r"]) == [(2, None)]


def test_nest_one_row_per_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 25_000, 0).otherwise(F.col("id")).alias("k"), "id")
    nested = nest_rows(df, "k", 1)
    assert nested.count() == 5001 and nested.where("k = 0").select(F.size("items")).first()[0] == 25_000
    assert sorted(rows(nested.selectExpr("inline(items)"))) == sorted(rows(df))


@pytest.mark.parametrize("partitions", [1, 7])
def test_nest_parts_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(6000).select(F.when(F.col("id") < 2000, None).otherwise(F.col("id") % 5).alias("k"), (F.col("id") % 2).alias("m"), "id")
    parts = nest_rows(df.repartition(partitions), ["k", "m"], 10)
    got = {(r.k, r.m, r.part): sorted(i.id for i in r["items"]) for r in parts.collect()}
    want = {(r.k, r.m, r.part): sorted(i.id for i in r["items"]) for r in nest_rows(df, ["k", "m"], 10).collect()}
    assert got == want and sum(map(len, got.values())) == 6000
    assert {p for k, m, p in got if k is None and m == 0} == set(range(10))
    with pytest.raises(ValueError):
        nest_rows(df, "k", 0)


def test_nest_null_keys_and_choices(spark):
    df = spark.createDataFrame([(None, '{"a":1}'), ("x", '"q"'), (None, "3")], "k string, j string").select("k", F.parse_json("j").alias("v"))
    nested = nest_rows(df, "k", 3).selectExpr("k", "inline(items) as (k2, v)")
    assert sorted(rows(nested.select("k", F.to_json("v"))), key=str) == [("x", '"q"'), (None, "3"), (None, '{"a":1}')]


def test_columns(spark):
    df = spark.createDataFrame([([1, 2, 3], 9)], "a array<int>, b int")
    assert rows(df.select(replace_array_element("a", "b", 1), replace_array_element("a", "b", 5))) == [([1, 9, 3], [1, 2, 3])]
    assert rows(df.select(explode_with_index("a"))) == [(0, 1), (1, 2), (2, 3)]
    assert df.select(named_struct(["x", "b"]).alias("s")).first()["s"]["x"] == 9
    with pytest.raises(ValueError):
        named_struct("x")
    assert add_ingestion_time_columns(df, "day").columns[2:] == ["ingest_year", "ingest_month", "ingest_day"]
    with pytest.raises(ValueError):
        add_ingestion_time_columns(df, "week")


def test_unbox_errors_keep_the_text(spark):
    df = spark.createDataFrame([(1, ('{"k": 1}',)), (2, ("{oops",)), (3, (None,))], "id int, a struct<t:string>")
    for schema in (None, "struct<k:int>"):
        frame = FlexFrame(df).unbox("a.t", "json", schema=schema, info="box", transformation_ctx="open")
        assert sorted(rows(frame.df.select("id"))) == [(1,), (3,)]
        bad = frame.errors().df.first()
        assert bad["record"] == '{"id":2,"a":{"t":"{oops"}}' and bad["info"] == "box" and bad["stage"] == "open"
        assert frame.errors_count() == 1
    with pytest.raises(ValueError):
        FlexFrame(df).unbox("id", "json")
    with pytest.raises(ValueError):
        FlexFrame(df).unbox("a.t", "avro")


def test_unbox_csv(spark):
    df = spark.createDataFrame([("h|h\n1|a\n2|b",), ("h|h\nx|c",)], "t string")
    many = FlexFrame(df).unbox("t", "csv", schema="struct<n:int,s:string>", separator="|", skip_first=True)
    assert [tuple(x) for x in many.df.first()["t"]] == [(1, "a"), (2, "b")]
    assert many.errors_count() == 1
    quoted = spark.createDataFrame([('a,b\n"x,y",2',)], "t string")
    opened = FlexFrame(quoted).unbox("t", "csv", with_header=True).open_variant("t")
    assert [tuple(x) for x in opened.df.first()["t"]] == [("x,y", "2")]
    json_schema = T.StructType([T.StructField("n", T.IntegerType())]).json()
    assert FlexFrame(spark.createDataFrame([("5",)], "t string")).unbox("t", "csv", schema=json_schema).df.first()["t"][0]["n"] == 5
    lines = spark.createDataFrame([('1,"a\nb"\n2,c\n3,"d ""e""\n\n f"',)], "t string")
    got = FlexFrame(lines).unbox("t", "csv", schema="struct<n:int,s:string>", escaper='"').df.first()["t"]
    assert [tuple(x) for x in got] == [(1, "a\nb"), (2, "c"), (3, 'd "e"\n\n f')]


def test_unbox_inside_arrays_reports_errors(spark):
    df = spark.createDataFrame([(1, [('{"k":1}',), ("{",)]), (2, [('{"k":2}',)]), (3, None), (4, [(None,)])], "id int, a array<struct<t:string>>")
    for schema in (None, "struct<k:int>"):
        opened = FlexFrame(df).unbox("a.t", "json", schema=schema)
        assert opened.count() == 4 and opened.errors_count() == 1
        assert '"id":1' in opened.errors().df.first()["record"]


def test_tagged_json(spark):
    df = spark.read.json(spark.sparkContext.parallelize([
        '{"a":{"N":"1.5"},"b":{"M":{"c":{"S":"x"},"n":{"NULL":true}}},"d":{"L":[{"N":"1"},{"S":"y"}]},"e":{"SS":["p"]},"f":{"NS":["4"]},"g":{"BOOL":true}}']))
    got = FlexFrame(df).unnest_tagged_json().df
    r = got.select(F.col("a").cast("double"), "b.c", F.to_json("d"), "e", F.col("f")[0].cast("int"), "g").first()
    assert tuple(r) == (1.5, "x", '[1,"y"]', ["p"], 4, True)


def test_rows_keyed_by_their_file(spark, folder):
    rows = [(i % 3, [i, None] if i % 4 else None) for i in range(40)]
    spark.createDataFrame(rows, "k int, xs array<int>").repartition(3).write.parquet(f"{folder}/t")
    read = spark.read.parquet(f"{folder}/t").where("k < 2").select("xs", "k")
    spark.sparkContext.setJobGroup("keyed", "relationalize")
    tables = relationalize(read, "r", key_cols=FILE_ROW)
    flat = unnest(read, FILE_ROW)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("keyed")) == []
    spark.sparkContext.setJobGroup("rest", "rest")
    root, xs = tables["r"], tables["r_xs"]
    keys = [r["xs"] for r in root.collect()]
    assert len(keys) == sum(k < 2 for k, _ in rows) and len({k for k in keys if k}) == sum(k < 2 and v is not None for k, v in rows)
    assert sorted(map(str, keys)) == sorted(str(r["xs"]) for r in flat.collect())
    joined = root.select("k", F.col("xs").alias("id")).join(xs, "id").select("k", "index", "val").collect()
    assert sorted(map(repr, map(tuple, joined))) == sorted(repr((k, i, v)) for k, a in rows if k < 2 for i, v in enumerate(a or []))
    for bad in (spark.createDataFrame(rows, "k int, xs array<int>"), read.withColumn("_metadata", F.lit(1))):
        with pytest.raises(ValueError, match="_metadata|Parquet"):
            relationalize(bad, "r", key_cols=FILE_ROW)


def test_nest_whole_holds_a_group_in_bounded_parts(spark, folder, monkeypatch):
    rows = [("N" if i % 9 else None, "O", i % 700, i % 7, f"c{i}") for i in range(6000)] + [("R", "F", None, 1, "a"), ("A", "F", None, 1, "b"), ("A", "F", 5, 2, "c")]
    spark.createDataFrame(rows, "l_returnflag string, l_linestatus string, l_orderkey long, l_linenumber int, l_comment string").write.parquet(f"{folder}/lineitem.parquet")
    seen = []
    monkeypatch.setattr(projection, "nest_rows", lambda *a: seen.append(nest_rows(*a)) or seen[-1])
    monkeypatch.setattr(projection, "_PART_ROWS", 500)
    monkeypatch.setattr(projection, "_RANGE", 64)
    got = {(r.l_returnflag, r.l_linestatus): r["items"] for r in projection.nest_whole(spark, folder).collect()}
    want = {}
    for flag, status, order, line, _ in rows:
        want.setdefault((flag, status), []).extend([] if order is None else [order * 10 + line])
    assert got == {k: hashlib.md5(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
    assert seen[0].agg(F.max(F.size("items"))).first()[0] < 700 and "l_comment" in seen[0].select(F.inline("items")).columns
