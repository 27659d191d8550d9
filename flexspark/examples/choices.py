"""Queries over values that have several types in one place."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flexspark.examples.registry import load, load_wide, query
from flexspark.frame import FlexFrame
from flexspark.operators.choice import ResolveOption
from flexspark.plans.discover import discover, from_variant
from flexspark.plans.nested import nodes
from flexspark.plans.types import Choice, type_name


def events_choice(spark, sf):
    """Events with ``v`` a number, a text or an object by event type, as they would come from JSON, types discovered."""
    kind = F.col("event_type")
    v = (
        F.when(kind == "click", F.to_json(F.struct(F.col("user_id").alias("v"))))
        .when(kind == "view", F.to_json(F.struct(F.col("event_type").alias("v"))))
        .when(kind == "signup", F.to_json(F.struct((F.col("value") + 0.125).alias("v"))))
        .when(kind == "purchase", F.to_json(F.struct(F.struct(F.col("user_id").alias("who")).alias("v"))))
        .otherwise(F.lit('{"v": null}'))
    )
    raw = load(spark, sf, "events").select("event_id", F.parse_json(v).alias("boxed"))
    return from_variant(raw, "boxed", discover(raw, ["boxed"])["boxed"])


@query("""
SELECT * FROM (VALUES ('arr', 'array'), ('arr.k', 'double'), ('arr.k', 'long'), ('arr.k', 'string'), ('id', 'long'), ('v', 'double'), ('v', 'string')) AS t(path, type)
WHERE (SELECT count(*) FROM events) > 0""")
def choice_discover(spark, sf):
    """Every path of nested JSON with every type seen there, conflicts inside arrays included."""
    pick = F.when(F.col("event_type") == "view", F.lit('"x"')).otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    arr = F.concat(F.lit('[{"k": '), F.col("user_id"), F.lit('}, {"k": "z"}, {"k": 0.5}]'))
    text = F.concat(F.lit('{"id": '), "event_id", F.lit(', "v": '), pick, F.lit(', "arr": '), arr, F.lit("}"))
    raw = load_wide(spark, sf, "events").select(F.parse_json(text).alias("v"))
    rows = []
    for names, dtype in nodes(discover(raw, ["v"])["v"]):
        options = dtype.options.values() if isinstance(dtype, Choice) else [dtype]
        rows += [(".".join(names), type_name(o)) for o in options]
    return spark.createDataFrame(rows, "path string, type string")


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN user_id END AS v FROM events")
def choice_project(spark, sf):
    return FlexFrame(events_choice(spark, sf)).resolve_choice(specs=[("v", "project:long")]).df


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN user_id::VARCHAR WHEN 'view' THEN 'view'
  WHEN 'purchase' THEN '{"who":' || user_id || '}' WHEN 'signup' THEN (value + 0.125)::VARCHAR END AS v
FROM events""")
def choice_cast(spark, sf):
    return FlexFrame(events_choice(spark, sf)).resolve_choice(specs=[("v", "cast:string")]).df


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN user_id::DOUBLE WHEN 'signup' THEN value + 0.125 END AS v FROM events""")
def choice_cast_number(spark, sf):
    return FlexFrame(events_choice(spark, sf)).resolve_choice(choice="cast:double").df


_BY_TYPE = """
SELECT event_id, CASE WHEN event_type = 'signup' THEN value + 0.125 END AS v_double, CASE WHEN event_type = 'click' THEN user_id END AS v_long,
       CASE WHEN event_type = 'view' THEN 'view' END AS v_string, CASE WHEN event_type = 'purchase' THEN user_id END AS v_who
FROM events"""


@query(_BY_TYPE)
def choice_struct(spark, sf):
    made = FlexFrame(events_choice(spark, sf)).resolve_choice(choice="make_struct").df
    return made.select("event_id", F.col("v.double").alias("v_double"), F.col("v.long").alias("v_long"),
                       F.col("v.string").alias("v_string"), F.col("v.struct.who").alias("v_who"))


@query(_BY_TYPE)
def choice_cols(spark, sf):
    made = FlexFrame(events_choice(spark, sf)).resolve_choice(specs=[("v", "make_cols")]).df
    return made.select("event_id", "v_double", "v_long", "v_string", F.col("v_struct.who").alias("v_who"))


@query("""
SELECT event_id::INTEGER AS event_id, CASE event_type WHEN 'click' THEN user_id::VARCHAR WHEN 'view' THEN 'view'
  WHEN 'purchase' THEN '{"who":' || user_id || '}' WHEN 'signup' THEN (value + 0.125)::VARCHAR END AS v
FROM events""")
def choice_catalog(spark, sf):
    """Types taken from a catalog table."""
    from flexspark.examples.storage import database

    db = database(spark)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{db}`.wanted (event_id INT, v STRING) USING parquet")
    return FlexFrame(events_choice(spark, sf)).resolve_choice(choice="match_catalog", database=db, table_name="wanted").df


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN user_id END AS v FROM events")
def choice_to_df(spark, sf):
    return FlexFrame(events_choice(spark, sf)).toDF([ResolveOption("v", "Project", "long")])


@query(_BY_TYPE)
def choice_to_df_default(spark, sf):
    made = FlexFrame(events_choice(spark, sf)).toDF()
    return made.select("event_id", F.col("v.double").alias("v_double"), F.col("v.long").alias("v_long"),
                       F.col("v.string").alias("v_string"), F.col("v.struct.who").alias("v_who"))


@query("SELECT l_orderkey, l_linenumber, l_linestatus AS status FROM lineitem")
def drop_null_fields(spark, sf):
    lines = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit(None).alias("gone"),
        F.struct(F.col("l_linestatus").alias("status"), F.lit(None).alias("gone")).alias("s"),
        F.array(F.struct(F.lit(None).alias("gone"))).alias("only_gone"),
    )
    return FlexFrame(lines).drop_null_fields().df.select("l_orderkey", "l_linenumber", "s.*")


@query("""
SELECT o_orderkey AS key_long, NULL::VARCHAR AS key_string FROM orders
UNION ALL SELECT NULL, o_orderpriority FROM orders""")
def union_choice(spark, sf):
    orders = load(spark, sf, "orders")
    mixed = FlexFrame(orders.select(F.col("o_orderkey").alias("key"))).union(FlexFrame(orders.select(F.col("o_orderpriority").alias("key"))))
    return mixed.resolve_choice(choice="make_cols").df


@query("""
SELECT user_id, 'choice<bigint,string>' AS seen FROM events GROUP BY user_id""")
def union_choice_schema(spark, sf):
    """Schema of a union with a conflict, and the whole data behind it."""
    events = load(spark, sf, "events")
    mixed = FlexFrame(events.select("user_id", F.col("event_id").alias("x"))).union(FlexFrame(events.select("user_id", F.col("event_type").alias("x"))))
    seen = mixed.schema()["x"].dataType.simpleString()
    return mixed.df.groupBy("user_id").agg(F.lit(seen).alias("seen"))


@query("SELECT event_id, user_id AS a, event_type AS b FROM events")
def nested_choice(spark, sf):
    """A conflict inside an array of structs, resolved in place."""
    text = F.concat(F.lit('{"id": '), "event_id", F.lit(', "arr": [{"k": '), "user_id", F.lit('}, {"k": "'), "event_type", F.lit('"}]}'))
    raw = load(spark, sf, "events").select(F.parse_json(text).alias("v"))
    typed = FlexFrame(from_variant(raw, "v", discover(raw, ["v"])["v"]))
    assert isinstance(typed.df.schema["arr"].dataType.elementType["k"].dataType, T.VariantType)
    made = typed.resolve_choice(specs=[("arr.k", "make_struct")]).df
    return made.select(F.col("id").alias("event_id"), F.col("arr")[0]["k"]["long"].alias("a"), F.col("arr")[1]["k"]["string"].alias("b"))
