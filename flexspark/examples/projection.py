"""Queries that map, keep, drop, rename, split and flatten fields."""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from flexspark.examples.registry import exact_sum, load, load_wide, query
from flexspark.frame import FlexFrame, FrameSet
from flexspark.functions.columns import add_ingestion_time_columns, expand_items, explode_with_index, named_struct, replace_array_element
from flexspark.jobs.summary import distinct_pairs as count_pairs
from flexspark.jobs.summary import summarize_csv
from flexspark.operators.nest import FILE_ROW, nest_rows, parts_for, relationalize
from flexspark.operators.project import apply_mapping, expand_struct, order_columns
from flexspark.sources.read import FlexReader
from flexspark.sources.scratch import new_dir


@query("SELECT count(DISTINCT {'a': user_id, 'b': event_type}) AS distinct_count FROM events")
def distinct_pairs(spark, sf):
    return count_pairs(load(spark, sf, "events"), "user_id", "event_type")


@query("SELECT count(DISTINCT {'a': user_id, 'b': event_type}) AS distinct_count FROM events")
def csv_summary(spark, sf):
    source = new_dir(spark, "events-csv")
    load(spark, sf, "events").write.option("header", "true").option("escape", '"').csv(source)
    return summarize_csv(spark, source, new_dir(spark, "summary"), "user_id", "event_type")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(trunc(o_totalprice) AS INTEGER) AS price, CAST(o_orderdate AS DATE) AS day,
       o_custkey AS cust_id, o_orderpriority AS cust_prio
FROM orders""")
def apply_mapping_types(spark, sf):
    mapped = FlexFrame(load(spark, sf, "orders"), "orders").apply_mapping(
        [
            ("o_orderkey", "long", "key", "string"),
            ("o_totalprice", "double", "price", "int"),
            ("o_orderdate", "day", "date"),
            ("o_custkey", "cust.id"),
            ("o_orderpriority", "string", "cust.prio", "string"),
        ]
    )
    return mapped.df.select("key", "price", "day", F.col("cust.id").alias("cust_id"), F.col("cust.prio").alias("cust_prio"))


@query("""
SELECT o_orderkey AS key, TRY_CAST(o_orderpriority AS INTEGER) AS prio, CAST(o_totalprice AS DECIMAL(10,2)) AS total
FROM orders""")
def apply_mapping_df(spark, sf):
    return apply_mapping(
        load(spark, sf, "orders"),
        [("O_OrderKey", "key"), ("o_orderpriority", "prio", "int"), ("o_totalprice", "double", "total", "decimal")],
    )


def orders_nested(spark, sf):
    """Orders with their customer as a struct."""
    customer = load(spark, sf, "customer").select("c_custkey", F.struct("c_name", "c_nationkey", "c_mktsegment").alias("customer"))
    orders = load(spark, sf, "orders")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).drop("c_custkey")


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def select_nested(spark, sf):
    kept = FlexFrame(orders_nested(spark, sf)).select_fields(["o_orderkey", "customer.c_name", "customer.c_mktsegment"])
    return kept.df.select("o_orderkey", "customer.*")


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, c_nationkey, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""")
def drop_nested(spark, sf):
    left = FlexFrame(orders_nested(spark, sf)).drop_fields(["customer.c_name", "o_totalprice", "o_orderpriority"])
    return left.df.select(*[c for c in left.df.columns if c != "customer"], "customer.*")


@query("""
SELECT o_orderkey, c_name AS full_name, c_mktsegment AS segment
FROM orders JOIN customer ON o_custkey = c_custkey""")
def rename_nested(spark, sf):
    frame = FlexFrame(orders_nested(spark, sf)).rename_field("customer.c_name", "customer.full_name")
    frame = frame.rename_field("customer.c_mktsegment", "market.segment")
    return frame.df.select("o_orderkey", "customer.full_name", "market.segment")


@query("SELECT c_custkey, c_name FROM customer")
def split_fields_first(spark, sf):
    return FlexFrame(load(spark, sf, "customer"), "customer").split_fields(["c_custkey", "c_name"])["customer1"].df


@query("SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer")
def split_fields_rest(spark, sf):
    return FlexFrame(load(spark, sf, "customer"), "customer").split_fields(["c_custkey", "c_name"])["customer2"].df


@query("SELECT o_custkey, o_orderkey, o_orderstatus, 'orders' AS source FROM orders")
def ordered_projection(spark, sf):
    boxed = load(spark, sf, "orders").select(F.struct("o_orderkey", "o_custkey", "o_orderstatus").alias("entity"))
    flat = expand_struct(boxed, "entity").withColumn("source", F.lit("orders"))
    return order_columns(flat, ["o_custkey", "o_orderkey", "o_orderstatus", "source"])


@query("""
SELECT o_orderkey, year(o_orderdate) AS ingest_year, month(o_orderdate) AS ingest_month, day(o_orderdate) AS ingest_day,
       hour(o_orderdate) AS ingest_hour
FROM orders""")
def ingest_columns(spark, sf):
    stamped = add_ingestion_time_columns(load(spark, sf, "orders"), "hour", ts="o_orderdate")
    return stamped.select("o_orderkey", "ingest_year", "ingest_month", "ingest_day", "ingest_hour")


@query("""
SELECT vec_id, label AS third, CAST(embedding[1] AS DOUBLE) AS first, len(embedding) AS n FROM embeddings""")
def replace_element(spark, sf):
    replaced = load(spark, sf, "embeddings").withColumn(
        "embedding", replace_array_element("embedding", F.col("label").cast("float"), 2)
    )
    e = F.col("embedding")
    return replaced.select("vec_id", e[2].cast("int").alias("third"), e[0].cast("double").alias("first"), F.size(e).alias("n"))


@query("SELECT l_orderkey, l_linenumber AS line, l_quantity AS qty FROM lineitem", name="named_struct")
def named_struct_fields(spark, sf):
    made = load(spark, sf, "lineitem").select("l_orderkey", named_struct("line", "l_linenumber", "qty", "l_quantity").alias("s"))
    return made.select("l_orderkey", "s.*")


@query("""
SELECT vec_id, CAST(i - 1 AS INTEGER) AS "index", CAST(embedding[i] AS DOUBLE) AS val
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def explode_index(spark, sf):
    rows = load(spark, sf, "embeddings").select("vec_id", explode_with_index("embedding"))
    return rows.select("vec_id", "index", F.col("val").cast("double").alias("val"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem")
def nest_roundtrip(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    return expand_items(nest_rows(lines, "l_orderkey", 4))


@query("""
SELECT l_orderkey, array_to_string(list_sort(list(l_linenumber * 1000 + l_quantity::INT)), ',') AS items
FROM lineitem GROUP BY l_orderkey""")
def nest_per_key(spark, sf):
    """One row per key, its items compared."""
    return _listed(nest_rows(load(spark, sf, "lineitem").withColumn("n", F.expr("l_linenumber * 1000 + int(l_quantity)")), "l_orderkey", 1), "l_orderkey")


_PART_ROWS, _RANGE = 100_000, 2_000  # rows of a part; width of a range of numbers


def _listed(nested, *keys):
    numbers = F.array_sort(F.transform("items", lambda x: x.n))
    return nested.select(*keys, F.array_join(F.transform(numbers, lambda n: n.cast("string")), ",").alias("items"))


@query("""
SELECT l_returnflag, l_linestatus, md5(array_to_string(list_sort(list(l_orderkey * 10 + l_linenumber)), ',')) AS items
FROM lineitem GROUP BY ALL""")
def nest_whole(spark, sf):
    """A few large groups: whole rows nested in parts of bounded size, a group's numbers listed range by range, its digest taken range after range."""
    lines = load(spark, sf, "lineitem").withColumn("n", F.expr("l_orderkey * 10 + l_linenumber"))
    keys = ["l_returnflag", "l_linestatus"]
    nested = nest_rows(lines, keys, parts_for(lines, _PART_ROWS))
    numbers = nested.select(*keys, F.explode("items.n").alias("n")).withColumn("range", F.expr(f"n div {_RANGE}"))
    texts = numbers.groupBy(*keys, "range").agg(F.collect_list("n").alias("ns"))
    text = F.array_join(F.transform(F.array_sort("ns"), lambda n: n.cast("string")), ",")
    texts = texts.select(*keys, "range", F.when(F.col("range").isNotNull(), text).alias("text"))
    return texts.repartition(*keys).sortWithinPartitions(*keys, "range").select(*keys, "text").mapInArrow(_digests, "l_returnflag string, l_linestatus string, items string")


def _digests(batches):
    """A row for each run of equal keys: the MD5 of its texts joined by commas, taken as they pass; nulls are left out."""
    keys, held, digest, mark = [], None, None, b""

    def row():
        return pa.RecordBatch.from_arrays([*[pa.array([k], pa.string()) for k in held], pa.array([digest.hexdigest()])], names=[*keys, "items"])

    for batch in batches:
        keys = batch.schema.names[:-1]
        for *key, text in zip(*(c.to_pylist() for c in batch.columns)):
            if key != held:
                if held is not None:
                    yield row()
                held, digest, mark = key, hashlib.md5(), b""
            if text is not None:
                digest.update(mark + text.encode())
                mark = b","
    if held is not None:
        yield row()


@query("SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, 16 AS parts, true AS split FROM lineitem")
def nest_parts(spark, sf):
    """The same groups in 16 parts each: no part holds a quarter of its group, and the items are all there."""
    nested = nest_rows(load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], 16)
    by = nested.groupBy("l_returnflag", "l_linestatus").agg(F.count_distinct("part").alias("parts"), (F.max(F.size("items")) * 4 < F.sum(F.size("items"))).alias("split"))
    rows = nested.select(F.inline("items")).select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber")
    return rows.join(by.withColumn("parts", F.col("parts").cast("int")), ["l_returnflag", "l_linestatus"])


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
def nest_all(spark, sf):
    """All rows, without a key, in 8 parts."""
    nested = nest_rows(load(spark, sf, "lineitem"), (), 8)
    return nested.where("part between 0 and 7").select(F.inline("items")).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
SELECT o_orderkey, o_custkey AS "who.id", o_orderpriority AS "who.ask.priority", o_totalprice AS total
FROM orders""")
def unnest_flat(spark, sf):
    nested = load(spark, sf, "orders").select(
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("id"), F.struct(F.col("o_orderpriority").alias("priority")).alias("ask")).alias("who"),
        F.col("o_totalprice").alias("total"),
    )
    return FlexFrame(nested).unnest().df


def documents_nested(spark, sf):
    """Documents with origin as a struct and their words as arrays, per line."""
    return load_wide(spark, sf, "documents").select(
        "doc_id",
        F.struct("lang", "source").alias("origin"),
        F.transform(
            F.split("text", "\n", -1),
            lambda line: F.struct(F.length(line).alias("size"), F.split(line, " ", -1).alias("words")),
        ).alias("lines"),
    )


def _document_tables(spark, sf):
    return relationalize(documents_nested(spark, sf), "documents", key_cols="doc_id")


@query('SELECT doc_id, lang AS "origin.lang", source AS "origin.source", doc_id AS lines FROM documents')
def relationalize_root(spark, sf):
    return _document_tables(spark, sf)["documents"]


@query("""
SELECT doc_id AS id, i - 1 AS "index", length(ls[i]) AS size
FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))""")
def relationalize_child(spark, sf):
    return _document_tables(spark, sf)["documents_lines"].select("id", "index", F.col("`val.size`").alias("size"))


@query("""
SELECT doc_id, count(*) AS words, sum(length(w)) AS letters
FROM (SELECT doc_id, unnest(string_split(l, ' ')) AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents))
GROUP BY doc_id""")
def relationalize_grandchild(spark, sf):
    words = _document_tables(spark, sf)["documents_lines.val_words"]
    doc = F.split("id", r"\.")[0].cast("long").alias("doc_id")
    return words.groupBy(doc).agg(F.count("*").alias("words"), F.sum(F.length("val")).alias("letters"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def relationalize_staged(spark, sf):
    """Rows without a natural key are numbered in one staged copy; root and child join back to the whole."""
    talks = nest_rows(load(spark, sf, "conversations"), "conv_id", 1, items="turns")
    tables = FlexFrame(talks).relationalize("talks", new_dir(spark, "pivot"))
    root, turns = tables["talks"].df, tables["talks_turns"].df
    joined = root.select("conv_id", F.col("turns").alias("key")).join(turns, F.col("key") == F.col("id"))
    return joined.select("conv_id", F.col("`val.turn`").alias("turn"), F.col("`val.role`").alias("role"), F.col("`val.text`").alias("text"))


@query("""
SELECT doc_id, i - 1 AS "index", length(ls[i]) AS size
FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE lang <> 'en'))""")
def relationalize_file_rows(spark, sf):
    """Rows keyed by their file and place in it: no pass over the keys and no copy, root and child join back to the whole."""
    docs = load(spark, sf, "documents").where("lang <> 'en'").select("doc_id", F.transform(F.split("text", "\n", -1), lambda line: F.struct(F.length(line).alias("size"))).alias("lines"))
    tables = relationalize(docs, "documents", key_cols=FILE_ROW)
    root, lines = tables["documents"].select("doc_id", F.col("lines").alias("key")), tables["documents_lines"]
    return root.join(lines, F.col("key") == F.col("id")).select("doc_id", "index", F.col("`val.size`").alias("size"))


@query("""
SELECT user_id AS user, event_type AS kind, event_id AS first, value AS second, value > 10 AS big FROM events""")
def tagged_unnest(spark, sf):
    text = F.col("value").cast("decimal(18,2)").cast("string")
    tagged = load(spark, sf, "events").select(
        F.struct(F.col("user_id").cast("string").alias("N")).alias("user"),
        F.struct(F.col("event_type").alias("S")).alias("kind"),
        F.struct(F.array(F.struct(F.col("event_id").cast("string").alias("N")), F.struct(text.alias("N"))).alias("L")).alias("pair"),
        F.struct(F.struct(F.struct((F.col("value") > 10).alias("BOOL")).alias("big")).alias("M")).alias("more"),
    )
    plain = FlexFrame(tagged).unnest_tagged_json().df
    return plain.select(
        F.col("user").cast("long").alias("user"), "kind", F.col("pair")[0].cast("long").alias("first"),
        F.col("pair")[1].cast("double").alias("second"), "more.big",
    )


@query("SELECT sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS total, count(*) AS n FROM events")
def unbox_json(spark, sf):
    opened = FlexFrame(load(spark, sf, "events")).unbox("props", "json", schema="struct<k:bigint>")
    return opened.df.agg(F.sum("props.k").alias("total"), F.count("*").alias("n"))


@query("SELECT event_type, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS total FROM events GROUP BY event_type")
def unbox_json_open(spark, sf):
    opened = FlexFrame(load(spark, sf, "events")).unbox("props", "json").open_variant("props")
    return opened.df.groupBy("event_type").agg(F.sum("props.k").alias("total"))


@query("SELECT event_id AS id, user_id AS who, event_type AS kind FROM events")
def unbox_csv(spark, sf):
    boxed = load(spark, sf, "events").select(F.struct(F.concat_ws("|", "event_id", "user_id", "event_type").alias("text")).alias("a"))
    opened = FlexFrame(boxed).unbox("a.text", "csv", schema="struct<id:bigint,who:bigint,kind:string>", separator="|")
    return opened.df.select(F.inline("a.text"))


@query("SELECT event_id AS id, user_id AS who, event_type || chr(10) || 'x' AS kind FROM events")
def unbox_csv_lines(spark, sf):
    """Many records in one text, with a header line and line breaks in quotes: every one comes back."""
    line = F.concat_ws(",", "event_id", "user_id", F.concat(F.lit('"'), "event_type", F.lit('\nx"')))
    texts = load(spark, sf, "events").groupBy("user_id").agg(F.concat(F.lit("id,who,kind\n"), F.array_join(F.collect_list(line), "\n")).alias("text"))
    opened = FlexFrame(texts).unbox("text", "csv", schema="struct<id:bigint,who:bigint,kind:string>", with_header=True)
    return opened.df.select(F.inline("text"))


@query("""
SELECT 'unbox' AS stage, count(*) AS errors, sum(event_id) AS ids, (SELECT count(*) FROM events) AS n_rows
FROM events WHERE event_type = 'error'""")
def unbox_array_errors(spark, sf):
    """Text inside arrays: a row with one that does not parse stays, and is reported."""
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("<"), "props")).otherwise(F.col("props"))
    boxed = load(spark, sf, "events").select("event_id", F.array(F.struct(F.col("props").alias("text")), F.struct(broken.alias("text"))).alias("list"))
    opened = FlexFrame(boxed).unbox("list.text", "json", schema="struct<k:bigint>")
    kept = opened.df.select(F.lit(None).cast("string").alias("stage"), F.lit(None).cast("long").alias("id"))
    bad = opened.errors().df.select("stage", F.get_json_object("record", "$.event_id").cast("long").alias("id"))
    return kept.unionByName(bad).agg(F.max("stage").alias("stage"), F.count("stage").alias("errors"), F.sum("id").alias("ids"), F.count_if(F.col("stage").isNull()).alias("n_rows"))


@query("""
SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, 2 AS copies
FROM documents""")
def relationalize_repeated_keys(spark, sf):
    """Every document twice, some keys null: each root row still meets its own lines only."""
    nested = documents_nested(spark, sf).withColumn("k", F.when(F.col("doc_id") % 7 > 0, F.col("doc_id")))
    tables = relationalize(nested.union(nested), "documents", key_cols="k")
    lines = tables["documents_lines"].groupBy("id").agg(F.count("*").alias("n"))
    joined = tables["documents"].join(lines, F.col("lines") == F.col("id"))
    return joined.groupBy("doc_id").agg(F.max("n").alias("n_lines"), F.count("*").cast("int").alias("copies"))


@query("""
SELECT n AS name, t AS type, (SELECT count(*) FROM customer) AS n_rows FROM (VALUES
('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'double'), ('c_mktsegment', 'string')) AS v(n, t)""")
def schema_as_rows(spark, sf):
    """What a frame's schema says, beside its rows."""
    frame = FlexFrame(load(spark, sf, "customer"))
    fields = [F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in frame.schema().fields]
    return frame.df.agg(F.count("*").alias("n_rows")).select("n_rows", F.inline(F.array(*fields)))


@query("SELECT count(*) AS n_rows, count(*) - count(*) AS missing FROM customer")
def frameset_missing(spark, sf):
    """A name the set does not have is an empty frame without columns."""
    frames = _by_segment(spark, sf)
    none = frames.select("no such segment").df
    assert none.columns == []
    return _together(frames).agg(F.count("*").alias("n_rows")).withColumn("missing", F.lit(none.count()).cast("long"))


@query("SELECT event_id, event_type FROM events")
def unbox_csv_header(spark, sf):
    boxed = load(spark, sf, "events").select(F.concat(F.lit("event_id,event_type\n"), F.concat_ws(",", "event_id", "event_type")).alias("text"))
    opened = FlexFrame(boxed).unbox("text", "csv", with_header=True).open_variant("text")
    rows = opened.df.select(F.explode("text").alias("r"))
    return rows.select(F.col("r.event_id").cast("long").alias("event_id"), F.col("r.event_type").alias("event_type"))


@query("SELECT 'unbox' AS stage, count(*) AS errors, sum(event_id) AS ids FROM events WHERE event_type = 'error'")
def unbox_errors(spark, sf):
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("<"), "props")).otherwise(F.col("props"))
    opened = FlexFrame(load(spark, sf, "events").withColumn("props", broken)).unbox("props", "json", schema="struct<k:bigint>")
    bad = opened.errors().df
    return bad.groupBy("stage").agg(F.count("*").alias("errors"), F.sum(F.get_json_object("record", "$.event_id").cast("long")).alias("ids"))


@query("SELECT c_mktsegment, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def frameset_select(spark, sf):
    return _by_segment(spark, sf).select("BUILDING").df.select("c_mktsegment", "c_custkey")


def _by_segment(spark, sf):
    customer = load(spark, sf, "customer")
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return FrameSet([FlexFrame(customer.where(F.col("c_mktsegment") == n), n) for n in names])


def _together(frames):
    first, *rest = frames.values()
    for f in rest:
        first = first.union(f)
    return first.df


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def frameset_map(spark, sf):
    counted = _by_segment(spark, sf).map(
        lambda f, ctx: FlexFrame(f.df.groupBy("c_mktsegment").agg(F.count("*").alias("n")), f.name)
    )
    return _together(counted)


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000")
def frameset_flatmap(spark, sf):
    halves = _by_segment(spark, sf).flatmap(
        lambda f, ctx: f.split_rows({"c_acctbal": {">": 5000}}, f"{f.name}.rich", f"{f.name}.rest")
    )
    rich = FrameSet({n: f.select_fields(["c_custkey", "c_acctbal"]) for n, f in halves.items() if n.endswith(".rich")})
    return _together(rich)


@query("SELECT c_custkey FROM customer")
def frameset_apply(spark, sf):
    """A named operator over every member, the frame passed by keyword."""
    return _together(_by_segment(spark, sf).apply(FlexFrame.select_fields, "self", paths="c_custkey"))


@query("""
SELECT o_orderkey, c_name, c_rate FROM orders JOIN customer ON o_custkey = c_custkey
JOIN (SELECT c_mktsegment AS seg, count(*) AS c_rate FROM customer GROUP BY c_mktsegment) ON c_mktsegment = seg""")
def from_rows(spark, sf):
    """A few local rows (one per market segment) become a frame again and join the tables."""
    customer = load(spark, sf, "customer")
    rates = customer.groupBy("c_mktsegment").agg(F.count("*").alias("n")).collect()
    lookup = FlexReader(spark).from_rows([(r[0], r[1]) for r in rates], "rates", "seg string, c_rate bigint")
    joined = FlexFrame(customer).join("c_mktsegment", "seg", lookup)
    orders = FlexFrame(load(spark, sf, "orders")).join("o_custkey", "c_custkey", joined)
    return orders.df.select("o_orderkey", "c_name", "c_rate")


@query("SELECT c_mktsegment, c_nationkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer GROUP BY ALL")
def with_schema(spark, sf):
    """Known schema given to JSON records: no discovery pass."""
    path = new_dir(spark, "customer-json")
    load(spark, sf, "customer").write.json(path)
    raw = FlexReader(spark).json([path], "customer", discover_types=False)
    typed = raw.with_frame_schema("c_mktsegment string, c_nationkey int, c_acctbal double")
    return typed.df.groupBy("c_mktsegment", "c_nationkey").agg(exact_sum("c_acctbal").alias("balance"))
