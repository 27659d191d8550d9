import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from flexspark.plans.paths import join_path, split_path
from flexspark.plans.types import Choice, merge_types, parse_type, schema_from_json, schema_to_json, to_spark

I, L, S, D, N = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType(), T.NullType()


def struct(**fields):
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def test_paths():
    assert split_path("a.b.c") == ("a", "b", "c")
    assert split_path("`a.b`.c") == ("a.b", "c")
    assert split_path("lines[].qty") == ("lines", "qty")
    assert split_path("x y.`q``r`") == ("x y", "q`r")
    assert join_path(("a.b", "c")) == "`a.b`.c"
    for bad in ("", "a.", ".a", "a..b"):
        with pytest.raises(ValueError):
            split_path(bad)


@given(st.lists(st.text(min_size=1, max_size=5), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_path_round_trip(names):
    assert split_path(join_path(names)) == tuple(names)


def test_null_gives_way():
    assert merge_types(N, L) == L and merge_types(L, N) == L


def test_different_kinds_are_a_choice():
    assert merge_types(I, L) == Choice([I, L])
    assert merge_types(merge_types(I, S), L) == Choice([I, S, L])
    assert merge_types(S, Choice([I, S])) == Choice([S, I])


def test_struct_keeps_left_order():
    a, b = struct(x=L, y=S), struct(z=D, y=L, x=L)
    merged = merge_types(a, b)
    assert merged.names == ["x", "y", "z"]
    assert merged["y"].dataType == Choice([S, L])
    assert a == struct(x=L, y=S) and b == struct(z=D, y=L, x=L)


def test_choices_merge_inside():
    left = Choice([struct(a=L), S])
    merged = merge_types(left, struct(a=S))
    assert merged.options["struct"]["a"].dataType == Choice([L, S])
    assert left.options["struct"] == struct(a=L)


def test_arrays_maps_decimals():
    assert merge_types(T.ArrayType(L), T.ArrayType(S)) == T.ArrayType(Choice([L, S]))
    assert merge_types(T.MapType(S, L), T.MapType(S, D)) == T.MapType(S, Choice([L, D]))
    assert merge_types(T.DecimalType(8, 2), T.DecimalType(12, 3)) == T.DecimalType(8, 2)


def test_enum_and_set():
    e = lambda *o: T.StructType([T.StructField("e", S, True, {"enum": list(o)})])
    assert merge_types(e("a"), e("b"))["e"].metadata["enum"] == ["a", "b"]
    s = lambda t: T.StructType([T.StructField("s", T.ArrayType(t), True, {"set": True})])
    assert merge_types(s(L), s(S))["s"].dataType == T.ArrayType(L)


_types = st.recursive(
    st.sampled_from([I, L, S, D, N, T.BooleanType(), T.DateType()]),
    lambda inner: st.one_of(
        inner.map(T.ArrayType),
        st.dictionaries(st.sampled_from("abc"), inner, min_size=1, max_size=3).map(lambda d: struct(**d)),
    ),
    max_leaves=6,
)


@given(_types, _types)
@settings(max_examples=150, deadline=None)
def test_merge_is_idempotent(a, b):
    both = merge_types(a, b)
    assert merge_types(both, both) == both
    assert merge_types(both, b).simpleString() == both.simpleString()


@given(_types, _types)
@settings(max_examples=100, deadline=None)
def test_json_round_trip(a, b):
    schema = struct(x=merge_types(a, b))
    assert schema_from_json(schema_to_json(schema)).simpleString() == schema.simpleString()


def test_json_form():
    text = '{"dataType": "struct", "properties": {}, "fields": [{"name": "a", "container": {"dataType": "choice", "properties": {}, "choices": [{"dataType": "int"}, {"dataType": "decimal", "precision": 5, "scale": 1}]}, "properties": {}}, {"name": "e", "container": {"dataType": "enum", "options": ["x"]}, "properties": {}}]}'
    schema = schema_from_json(text)
    assert schema["a"].dataType == Choice([I, T.DecimalType(5, 1)])
    assert schema["e"].dataType == S and schema["e"].metadata == {"enum": ["x"]}
    assert schema_from_json(schema_to_json(schema)) == schema


def test_names(spark):
    assert parse_type("decimal") == T.DecimalType(10, 2)
    assert parse_type("int") == I and parse_type("long") == L and parse_type("array<string>") == T.ArrayType(S)
    assert to_spark(struct(a=Choice([L, S]))) == struct(a=T.VariantType())
    with pytest.raises(ValueError):
        Choice([L, L])
