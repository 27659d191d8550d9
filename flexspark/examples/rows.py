"""Queries that filter, map, split, join, merge, union and aggregate rows."""

from pyspark.sql import functions as F

from flexspark.examples.registry import exact_sum, load, load_wide, query
from flexspark.frame import ErrorThresholdExceeded, FlexFrame, FrameSet
from flexspark.operators.rows import group_max as max_per_group
from flexspark.operators.rows import latest_per_key, semi_join as keep_matching
from flexspark.operators.rows import subtract_rows
from flexspark.sources.scratch import new_dir


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 10 AND l_quantity < 20")
def split_rows_in(spark, sf):
    lines = FlexFrame(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))
    return lines.split_rows({"l_quantity": {">": 10, "<": 20}})["frame1"].df


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT (l_quantity > 10 AND l_quantity < 20)")
def split_rows_out(spark, sf):
    lines = FlexFrame(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))
    return lines.split_rows({"l_quantity": {">": 10, "<": 20}})["frame2"].df


@query("""
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1998-01-01' AND l_discount > 0.05""")
def filter_expr(spark, sf):
    frame = FlexFrame(load(spark, sf, "lineitem")).filter(
        "l_returnflag = 'R' AND l_shipdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00' AND l_discount > 0.05"
    )
    return frame.df.select("l_orderkey", "l_linenumber", "l_discount")


@query("SELECT event_id, user_id FROM events WHERE event_type IN ('click', 'view') AND value > 20")
def filter_callable(spark, sf):
    """The predicate fails with ValueError on purchases (dropped) and with RuntimeError on errors (kept apart)."""
    return FlexFrame(load_wide(spark, sf, "events")).filter(_wanted).df.select("event_id", "user_id")


def _wanted(r):
    if r.event_type == "purchase":
        raise ValueError("not comparable")
    if r.event_type == "error":
        raise RuntimeError("cannot judge " + r.event_type)
    return r.event_type in ("click", "view") and r["value"] > 20


@query("""
SELECT 'filter' AS stage, 'cannot judge error' AS error_message, count(*) AS n, sum(event_id) AS ids
FROM events WHERE event_type = 'error'""")
def filter_errors(spark, sf):
    kept = FlexFrame(load(spark, sf, "events")).filter(_wanted)
    ids = F.get_json_object("record", "$.event_id").cast("long")
    return kept.errors().df.groupBy("stage", "error_message").agg(F.count("*").alias("n"), F.sum(ids).alias("ids"))


def _priced(r):
    if r.event_type == "error":
        raise RuntimeError("no price for " + r.event_type)
    return {"id": r.event_id, "user": r.user_id, "double": r["value"] * 2}


@query("SELECT event_id AS id, user_id AS user, value * 2 AS double, ts AS at, props FROM events WHERE event_type <> 'error'")
def map_records(spark, sf):
    made = FlexFrame(load_wide(spark, sf, "events")).map(lambda r: {**_priced(r), "at": r.ts, "props": r.props}, "id bigint, user bigint, double double, at timestamp_ntz, props string")
    return made.df


@query("""
SELECT 'map' AS stage, 'prices' AS info, 'no price for error' AS error_message, count(*) AS n, sum(event_id) AS ids
FROM events WHERE event_type = 'error'""")
def map_errors(spark, sf):
    mapped = FlexFrame(load(spark, sf, "events")).map(_priced, "id bigint, user bigint, double double", info="prices")
    ids = F.get_json_object("record", "$.event_id").cast("long")
    return mapped.errors().df.groupBy("stage", "info", "error_message").agg(F.count("*").alias("n"), F.sum(ids).alias("ids"))


@query("""
SELECT event_id AS id, CASE WHEN event_type = 'click' THEN user_id END AS v_long,
       CASE WHEN event_type <> 'click' THEN event_type END AS v_string
FROM events""")
def map_free_form(spark, sf):
    """Results of different types under one name: staged once, discovered, then one column per type."""
    mapped = FlexFrame(load(spark, sf, "events")).map(
        lambda r: {"id": r.event_id, "v": r.user_id if r.event_type == "click" else r.event_type}
    )
    return mapped.resolve_choice(specs=[("v", "make_cols")]).df.select("id", "v_long", "v_string")


def _count_types(rows):
    seen = {}
    for r in rows:
        seen[r.event_type] = seen.get(r.event_type, 0) + 1
    for kind, n in seen.items():
        yield {"kind": kind, "n": n}


@query("SELECT event_type AS kind, count(*) AS n FROM events GROUP BY event_type")
def map_partitions(spark, sf):
    counts = FlexFrame(load_wide(spark, sf, "events")).map_partitions(_count_types, "kind string, n bigint").df
    return counts.groupBy("kind").agg(F.sum("n").cast("long").alias("n"))


@query("SELECT count(*) AS n, true AS numbered FROM events")
def map_partitions_indexed(spark, sf):
    frame = FlexFrame(load(spark, sf, "events")).repartition(4)
    parts = frame.map_partitions_with_index(
        lambda i, rows: [{"part": i, "n": sum(1 for _ in rows)}], "part int, n bigint"
    ).df
    return parts.agg(F.sum("n").alias("n"), ((F.max("part") <= 3) & (F.count("*") == F.count_distinct("part"))).alias("numbered"))


@query("""
SELECT c_mktsegment, o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def join_frames(spark, sf):
    joined = FlexFrame(load(spark, sf, "orders"), "orders").join("o_custkey", "c_custkey", FlexFrame(load(spark, sf, "customer"), "customer"))
    return joined.df.groupBy("c_mktsegment", "o_orderstatus").agg(F.count("*").alias("n"), exact_sum("o_totalprice").alias("total"))


@query("""
SELECT a.event_id, b.event_id AS right_event_id FROM events a JOIN events b ON a.event_id = b.event_id AND a.user_id = b.user_id""")
def join_clashing(spark, sf):
    events = FlexFrame(load(spark, sf, "events"), "events")
    both = events.join(["event_id", "user_id"], ["event_id", "user_id"], events)
    return both.df.select("event_id", "right_event_id")


def _staged_orders(spark, sf):
    """Finished orders with a changed price, and copies of the open ones under new keys."""
    orders = load(spark, sf, "orders")
    changed = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(1.0))
    new = orders.where("o_orderstatus = 'O'").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return changed.union(new)


@query("""
WITH staged AS (
  SELECT o_orderkey, o_custkey, 1.0::DOUBLE AS o_totalprice FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT -o_orderkey - 1, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM staged)
UNION ALL SELECT * FROM staged""")
def merge_frames(spark, sf):
    merged = FlexFrame(load(spark, sf, "orders")).merge(FlexFrame(_staged_orders(spark, sf)), "o_orderkey")
    return merged.df.select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
WITH staged AS (SELECT * REPLACE (0.5::DOUBLE AS l_discount) FROM lineitem WHERE l_returnflag = 'R'),
merged AS (
  SELECT * FROM lineitem l WHERE NOT EXISTS (
    SELECT 1 FROM staged s WHERE s.l_orderkey = l.l_orderkey AND s.l_linenumber = l.l_linenumber)
  UNION ALL SELECT * FROM staged)
SELECT l_returnflag, l_discount, count(*) AS n, sum(l_quantity) AS quantity FROM merged GROUP BY ALL""")
def merge_frames_dups(spark, sf):
    lines = load(spark, sf, "lineitem")
    staged = lines.where("l_returnflag = 'R'").withColumn("l_discount", F.lit(0.5))
    merged = FlexFrame(lines).merge(FlexFrame(staged), ["l_orderkey", "l_linenumber"]).df
    return merged.groupBy("l_returnflag", "l_discount").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def semi_join(spark, sf):
    lines = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return keep_matching(load(spark, sf, "orders"), lines, "o_orderkey").select("o_orderkey", "o_orderstatus")


@query("""
SELECT o_orderkey, o_orderpriority, l_linenumber, l_shipdate FROM orders JOIN lineitem
ON o_orderkey = l_orderkey AND o_orderdate = l_shipdate""")
def compound_join(spark, sf):
    orders, lines = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    both = orders.join(lines, (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("o_orderdate") == F.col("l_shipdate")), "inner")
    return both.select("o_orderkey", "o_orderpriority", "l_linenumber", "l_shipdate")


@query("""
SELECT user_id, event_id, ts FROM (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00')
WHERE r = 1""")
def latest_version(spark, sf):
    as_of = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return latest_per_key(load(spark, sf, "events"), "user_id", "ts", as_of).select("user_id", "event_id", "ts")


@query("""
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders) WHERE r = 1""")
def latest_orders(spark, sf):
    return latest_per_key(load(spark, sf, "orders"), "o_custkey", "o_orderdate").select("o_custkey", "o_orderkey", "o_orderdate")


@query("SELECT c_mktsegment, max(c_acctbal) AS top FROM customer GROUP BY c_mktsegment")
def group_max(spark, sf):
    return max_per_group(load(spark, sf, "customer"), "c_mktsegment", "c_acctbal", "top")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark, sf):
    return FlexFrame(load(spark, sf, "orders")).select_fields(["o_orderstatus", "o_orderpriority"]).distinct().df


@query("SELECT c_custkey AS name FROM customer EXCEPT SELECT o_custkey FROM orders")
def subtract_names(spark, sf):
    names = load(spark, sf, "customer").select(F.col("c_custkey").alias("name"))
    return subtract_rows(names, load(spark, sf, "orders").select(F.col("o_custkey").alias("name")))


@query("SELECT o_custkey AS name FROM orders WHERE o_totalprice > 100000 EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def subtract_customers(spark, sf):
    """Customers with a large order and no partial one, each once."""
    orders = load(spark, sf, "orders").withColumnRenamed("o_custkey", "name")
    return subtract_rows(orders.where("o_totalprice > 100000").select("name"), orders.where("o_orderstatus = 'P'").select("name"))


def _failing(r):
    if r.event_type == "error":
        raise RuntimeError("no price")
    return {"id": r.event_id, "value": r["value"]}


@query("""
SELECT count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type <> 'error') AS n_rows FROM events""")
def errors_total_split_union(spark, sf):
    """Errors of a step that several branches share count once, also after the branches meet again."""
    mapped = FlexFrame(load(spark, sf, "events")).map(_failing, "id bigint, value double")
    parts = mapped.split_rows({"value": {">": 20}})
    whole = parts["frame1"].union(parts["frame2"])
    twice = whole.join("id", "id", parts["frame1"].union(parts["frame2"]))
    counted = whole.df.agg(F.count("*").alias("n_rows")).withColumn("errors", F.lit(whole.errors_count()).cast("long"))
    assert twice.errors_count() == whole.errors_count()
    return counted


@query("""
SELECT count(*) FILTER (event_type = 'error') AS first, count(*) FILTER (event_type = 'purchase' AND value > 30) AS last FROM events""")
def errors_stage(spark, sf):
    """Errors of one step and of the last step only."""

    def cheap(r):
        if r["value"] > 30 and r.kind == "purchase":
            raise RuntimeError("too dear")
        return True

    first = FlexFrame(load(spark, sf, "events")).map(lambda r: {**_failing(r), "kind": r.event_type}, "id bigint, value double, kind string")
    last = first.filter(cheap)
    return last.errors().df.agg(F.count_if(F.col("step") == 0).alias("first"), F.lit(last.stage_errors_count()).cast("long").alias("last"))


@query("SELECT count(*) AS n_rows, 'errors' AS stopped_by FROM events WHERE event_type <> 'error'")
def errors_threshold(spark, sf):
    """A limit below the number of errors stops the sink; one above lets it write. The function runs once for rows, errors and checks."""
    path = new_dir(spark, "limited")
    errors = load(spark, sf, "events").where("event_type = 'error'").count()
    mapped = lambda limit: FlexFrame(load(spark, sf, "events")).map(_failing, "id bigint, value double", total_threshold=limit)
    try:
        mapped(errors - 1).write("file", {"path": path}, "parquet")
        stopped = "nothing"
    except ErrorThresholdExceeded:
        stopped = "errors"
    mapped(errors).write("file", {"path": path}, "parquet")
    return spark.read.parquet(path).agg(F.count("*").alias("n_rows"), F.lit(stopped).alias("stopped_by"))


@query("""
SELECT o_orderkey AS key, o_orderstatus AS status, NULL::DOUBLE AS amount FROM orders
UNION ALL SELECT l_orderkey, NULL, l_extendedprice FROM lineitem""")
def union_all(spark, sf):
    orders = load(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))
    lines = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("amount"))
    return FlexFrame(orders).union(FlexFrame(lines)).df


@query("SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def union_positional(spark, sf):
    customers = load(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return customers.union(load(spark, sf, "supplier").select("s_suppkey", "s_name"))


@query("SELECT count(*) AS n, false AS empty FROM orders")
def count_rows(spark, sf):
    frame = FlexFrame(load(spark, sf, "orders"))
    return spark.createDataFrame([(frame.count(), frame.is_empty())], "n bigint, empty boolean")


@query("SELECT o_orderstatus, true AS empty FROM orders GROUP BY o_orderstatus")
def is_empty(spark, sf):
    """A set has no order priced below zero, in any status."""
    orders = load(spark, sf, "orders")
    frames = FrameSet([FlexFrame(orders.where((F.col("o_orderstatus") == s) & (F.col("o_totalprice") < 0)), s) for s in "FOP"])
    return spark.createDataFrame([(n, f.is_empty()) for n, f in frames.items()], "o_orderstatus string, empty boolean")


@query("SELECT least(20, count(*)) AS n FROM orders")
def limit_rows(spark, sf):
    """First rows, as ``show`` takes them."""
    from flexspark.examples.storage import distinct_known

    orders = load(spark, sf, "orders")
    return distinct_known(orders.limit(20), orders, "o_orderkey")


@query("SELECT 'lineitem' AS source, count(*) AS n, 6 AS many, 2 AS few, 3 AS hinted, 3 AS shuffled FROM lineitem")
def partition_hints(spark, sf):
    from flexspark.sources.read import partition_hint

    frame = FlexFrame(load(spark, sf, "lineitem"))
    many = frame.repartition(6)
    counts = [
        many.getNumPartitions(), many.coalesce(2).getNumPartitions(),
        partition_hint(many.df, target=3).rdd.getNumPartitions(), many.coalesce(3, shuffle=True).getNumPartitions(),
    ]
    total = many.coalesce(2).df.agg(F.lit("lineitem").alias("source"), F.count("*").alias("n"))
    return total.select("*", *[F.lit(c).alias(n) for n, c in zip(["many", "few", "hinted", "shuffled"], counts)])


@query("""
WITH l AS (SELECT CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_suppkey END AS k, l_quantity FROM lineitem),
s AS (SELECT s_suppkey AS k, s_name AS who FROM supplier UNION ALL SELECT 0, s_name FROM supplier WHERE s_suppkey <= 3)
SELECT k, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, max(who) AS who FROM l JOIN s USING (k) GROUP BY k""")
def join_hot_key(spark, sf):
    """A key with a third of the rows is dealt over eight tasks, and the result grouped on it."""
    line = load(spark, sf, "lineitem").select(F.when(F.col("l_partkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_suppkey")).cast("long").alias("k"), "l_quantity")
    supplier = load(spark, sf, "supplier")
    who = supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("who")).unionByName(supplier.where("s_suppkey <= 3").select(F.lit(0).cast("long").alias("k"), F.col("s_name").alias("who")))
    joined = FlexFrame(line).join("k", "k", FlexFrame(who), salts=8).df
    return joined.groupBy("k").agg(F.count("*").alias("n"), exact_sum("l_quantity").alias("quantity"), F.max("who").alias("who"))
