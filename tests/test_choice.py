import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.frame import FlexFrame
from flexspark.operators.choice import ResolveOption, alternatives, drop_null_fields
from flexspark.operators.project import rename_field
from flexspark.plans.discover import _take_apart, discover, from_variant, frame_schema
from flexspark.plans.types import Choice

LINES = [
    '{"id":2,"arr":[{"k":1},{"k":"z"}],"n":{"a":"q"},"m":[1,1.5],"x y":{"a.b":1}}',
    '{"id":1,"v":5,"n":{"a":1.5},"m":[1],"g":[[1],["a"]]}',
    '{"id":3,"v":null,"d":1e3,"e":[],"o":{},"w":{"z":null,"q":[null]}}',
    '{"id":"7","n":4}',
]
L, S, D = T.LongType(), T.StringType(), T.DoubleType()


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([(j,) for j in LINES], "j string").select(F.parse_json("j").alias("v"))


@pytest.fixture(scope="module")
def typed(raw):
    return from_variant(raw, "v", discover(raw)["v"])


def test_descriptions_are_taken_apart():
    text = "OBJECT<`a, b`: ARRAY<OBJECT<k: VARIANT>>, n: DECIMAL(3,1), o: OBJECT<>, z: VOID>"
    assert _take_apart(text) == [
        ((), "OBJECT"), ((".a, b",), "ARRAY"), ((".a, b", "[]"), "OBJECT"), ((".a, b", "[]", ".k"), "VARIANT"),
        ((".n",), "DECIMAL(3,1)"), ((".o",), "OBJECT"), ((".z",), "VOID"),
    ]


def test_discovery(raw):
    schema = discover(raw)["v"]
    assert schema["id"].dataType == Choice([L, S])
    assert schema["arr"].dataType.elementType["k"].dataType == Choice([L, S])
    assert schema["m"].dataType == T.ArrayType(Choice([L, D]))
    assert schema["g"].dataType == T.ArrayType(T.ArrayType(Choice([L, S])))
    assert schema["n"].dataType.options["struct"]["a"].dataType == Choice([D, S])
    assert schema["v"].dataType == L and schema["w"].dataType["z"].dataType == T.NullType()
    assert schema["x y"].dataType.names == ["a.b"] and schema["e"].dataType == T.ArrayType(T.NullType())


def test_typed_frame_keeps_values(typed):
    assert typed.schema["v"].dataType == L and isinstance(typed.schema["id"].dataType, T.VariantType)
    assert [r[0] for r in typed.select("v").collect()] == [None, 5, None, None]
    assert typed.select(F.col("x y").getField("a.b")).first()[0] == 1
    assert frame_schema(typed).simpleString() == frame_schema(typed).simpleString()


def test_deep_conflicts(spark):
    lines = ['{"a":[{"b":[{"c":1},{"c":[1,"x"]}]}]}', '{"a":[{"b":[{"c":{"d":[[true,2]]}}]},7]}']
    df = spark.createDataFrame([(j,) for j in lines], "j string").select(F.parse_json("j").alias("v"))
    element = discover(df)["v"]["a"].dataType.elementType
    assert set(element.options) == {"struct", "long"}
    c = element.options["struct"]["b"].dataType.elementType["c"].dataType
    assert set(c.options) == {"long", "array", "struct"}
    assert c.options["array"].elementType == Choice([L, S])
    assert c.options["struct"]["d"].dataType.elementType.elementType == Choice([T.BooleanType(), L])


def test_alternatives_with_and_without_metadata(typed):
    assert alternatives(typed, "id") == [L, S]
    renamed = rename_field(typed, "id", "key")
    assert "choices" in renamed.schema["key"].metadata and alternatives(renamed, "key") == [L, S]
    plain = typed.withMetadata("id", {})
    assert alternatives(plain, "id") == [L, S]


def test_project_tests_the_type_and_cast_converts(spark):
    df = spark.createDataFrame([("1",), ("1.5",), ('"2"',), ("null",), ('{"a":1}',)], "j string").select(F.parse_json("j").alias("c"))
    frame = FlexFrame(df)
    one = lambda **kw: [r[0] for r in frame.resolve_choice(**kw).df.collect()]
    assert one(specs=[("c", "project:long")]) == [1, None, None, None, None]
    assert one(specs=[("c", "cast:long")]) == [1, 1, 2, None, None]
    assert one(specs=[("c", "project:double")]) == [None, 1.5, None, None, None]
    assert one(choice="cast:string") == ["1", "1.5", "2", None, '{"a":1}']


def test_struct_cols_and_leftovers(typed):
    made = FlexFrame(typed).resolve_choice(specs=[("arr.k", "make_struct"), ("id", "make_cols")]).df
    assert {"id_long", "id_string"} <= set(made.columns)
    assert made.first()["arr"][1]["k"].asDict() == {"long": None, "string": "z"}
    plain = FlexFrame(typed).toDF([ResolveOption("id", "Cast", "string")])
    assert "variant" not in plain.schema.simpleString()
    assert plain.collect()[0]["n"]["struct"]["a"]["string"] == "q"
    assert plain.collect()[1]["n"]["struct"]["a"]["double"] == 1.5


def test_bad_specs(typed):
    frame = FlexFrame(typed)
    for kwargs in ({}, {"specs": [("id", "cast:long")], "choice": "make_cols"}, {"specs": [("id", "cast")]}, {"choice": "nope"},
                   {"choice": "match_catalog"}):
        with pytest.raises(ValueError):
            frame.resolve_choice(**kwargs)
    with pytest.raises(ValueError):
        frame.toDF([ResolveOption("id", "Project")])
    with pytest.raises(ValueError):
        frame.toDF([ResolveOption("id", "Guess", "long")])


def test_choices_cannot_be_keys(typed):
    frame = FlexFrame(typed)
    for act in (lambda: frame.join("id", "id", frame), lambda: frame.merge(frame, "id"), lambda: frame.distinct()):
        with pytest.raises(ValueError, match="choice"):
            act()


def test_union_of_conflicts(spark):
    a = spark.createDataFrame([(1, (1, 2), [1])], "x bigint, s struct<p:int,q:int>, l array<int>")
    b = spark.createDataFrame([("z", ("w", 3), ["k"], 1.5)], "x string, s struct<p:string,r:int>, l array<string>, extra double")
    both = FlexFrame(a).union(FlexFrame(b))
    assert both.schema()["x"].dataType == Choice([L, S])
    assert both.df.schema["s"].dataType.names == ["p", "q", "r"]
    got = both.resolve_choice(choice="make_struct").df.collect()
    assert got[0]["x"]["long"] == 1 and got[1]["x"]["string"] == "z" and got[0]["extra"] is None
    assert got[1]["s"]["p"]["string"] == "w" and got[0]["s"]["r"] is None
    assert got[0]["l"][0]["long"] == 1 and got[1]["l"][0]["string"] == "k"


def test_union_integer_widths_widen(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "x bigint")
    assert FlexFrame(a).union(FlexFrame(b)).df.schema["x"].dataType == L


def test_drop_null_fields(typed):
    out = drop_null_fields(typed)
    assert out.schema["w"].dataType.names == ["q"] and "e" in out.columns


def test_with_schema(raw):
    frame = FlexFrame(raw).with_frame_schema("id string, v int")
    assert [tuple(r) for r in frame.df.collect()] == [("2", None), ("1", 5), ("3", None), ("7", None)]


def _brute(value):
    """Type of one JSON value by plain recursion."""
    from functools import reduce

    from flexspark.plans.types import merge_types

    if value is None:
        return T.NullType()
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return L
    if isinstance(value, float):
        return D
    if isinstance(value, str):
        return S
    if isinstance(value, list):
        return T.ArrayType(reduce(merge_types, [_brute(v) for v in value], T.NullType()))
    return T.StructType([T.StructField(k, _brute(v)) for k, v in value.items()])


def _canonical(dtype):
    if isinstance(dtype, Choice):
        return ("choice", tuple(sorted((n, _canonical(o)) for n, o in dtype.options.items())))
    if isinstance(dtype, T.StructType):
        return ("struct", tuple(sorted((f.name, _canonical(f.dataType)) for f in dtype.fields)))
    if isinstance(dtype, T.ArrayType):
        return ("array", _canonical(dtype.elementType))
    return (dtype.simpleString(),)


def _value(rng, depth):
    kinds = ["int", "float", "str", "bool", "null"] + (["list", "dict", "list", "dict"] if depth else [])
    kind = rng.choice(kinds)
    if kind == "int":
        return rng.randint(-5, 10**12)
    if kind == "float":
        return rng.randint(-50, 50) + 0.25
    if kind == "list":
        return [_value(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    if kind == "dict":
        return {k: _value(rng, depth - 1) for k in rng.sample(["a", "b c", "d.e", "f`g"], rng.randint(0, 3))}
    return {"str": "x", "bool": True, "null": None}[kind]


@pytest.mark.parametrize("seed", range(6))
def test_discovery_equals_brute_force(spark, seed):
    import json
    import random
    from functools import reduce

    from flexspark.plans.types import merge_types

    rng = random.Random(seed)
    docs = [{k: _value(rng, 4) for k in ("p", "q", "r")} for _ in range(30)]
    want = reduce(merge_types, [_brute(d) for d in docs])
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "j string").select(F.parse_json("j").alias("v"))
    got = discover(df)["v"]
    assert _canonical(got) == _canonical(want)
    typed = from_variant(df, "v", got)
    assert _canonical(frame_schema(typed)) == _canonical(want)
    typed.collect()


def test_plain_frame_reproduces_every_value(spark):
    """Every alternative lands in its own field: nothing is lost on the way to plain types."""
    import json

    docs = [{"v": v} for v in [1, "a", 2.5, True, None, [1, "b"], {"k": [None, {"z": 1}]}, {"k": "c"}]]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "j string").select(F.parse_json("j").alias("v"))
    plain = FlexFrame(from_variant(df, "v", discover(df)["v"])).toDF()
    got = [r["v"].asDict(recursive=True) if r["v"] is not None else None for r in plain.collect()]
    only = [{k: v for k, v in (g or {}).items() if v is not None} for g in got]
    assert only[:5] == [{"long": 1}, {"string": "a"}, {"double": 2.5}, {"boolean": True}, {}]
    assert only[5]["array"][0]["long"] == 1 and only[5]["array"][1]["string"] == "b"
    assert only[6]["struct"]["k"]["array"][1] == {"z": 1} and only[7]["struct"]["k"]["string"] == "c"


def test_objects_keyed_by_data(spark):
    texts = ['{"m": {"a": {"x": 1}, "b": {"x": "s", "l": [1, {"y": 2}]}}, "o": {"p": 1}}', '{"m": {"c.d": {"x": 2}, "e": 5}}', '{"m": {}}', '{"m": null, "l": [{"n": {"k1": 1, "k2": 2}}]}']
    raw = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("v"))
    got = discover(raw, ["v"], ["m", "l[].n"])["v"]
    assert isinstance(got["m"].dataType, T.MapType) and got["o"].dataType.simpleString() == "struct<p:bigint>"
    assert got["l"].dataType.elementType["n"].dataType.simpleString() == "map<string,bigint>"
    typed = from_variant(raw, "v", got)
    keys = typed.select(F.explode("m").alias("k", "x")).select("k", F.to_json("x").alias("x")).collect()
    assert {r.k for r in keys} == {"a", "b", "c.d", "e"} and ("e", "5") in {(r.k, r.x) for r in keys}
    assert typed.where("l is not null").select(F.col("l")[0]["n"]["k2"]).first()[0] == 2
