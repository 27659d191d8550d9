"""Queries that read and write files and catalog tables."""

import datetime
import uuid

from pyspark.sql import functions as F

from flexspark.examples.registry import exact_sum, load, query
from flexspark.frame import FlexFrame, FrameSet
from flexspark.sources.bookmarks import Bookmarks
from flexspark.sources.ledger import JobRun
from flexspark.sources.purge import purge_path
from flexspark.sources.purge import purge_table as purge_catalog_table
from flexspark.sources.read import FlexDataFrameReader, FlexReader
from flexspark.sources.scratch import new_dir
from flexspark.sources.write import FlexWriter, stamped, write_data_frame

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def _orders(spark, sf):
    return load(spark, sf, "orders")


def database(spark):
    """Demo database whose tables live in the shared folder."""
    name = "flexspark_demo"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{new_dir(spark, name)}'")
    return name


def _table(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


@query("""
SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment""")
def read_options(spark, sf):
    """CSV through connection, format, options and a predicate."""
    path = new_dir(spark, "customer-csv")
    FlexWriter().from_options(FlexFrame(load(spark, sf, "customer")), "file", {"path": path}, "CSV", {"withHeader": True, "separator": "|"})
    read = FlexReader(spark).from_options(
        "file", {"paths": [path]}, "csv", {"withHeader": True, "separator": "|"},
        push_down_predicate="c_acctbal > 0",
        schema="c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    )
    return read.df.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"), exact_sum("c_acctbal").alias("balance"))


@query("SELECT event_type, count(*) AS n, sum(event_id) AS ids FROM events GROUP BY event_type")
def read_json_dynamic(spark, sf):
    path = new_dir(spark, "events-json")
    load(spark, sf, "events").write.json(path)
    frame = FlexReader(spark).from_options("file", {"paths": [path]}, "json")
    return frame.df.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT 'read_json' AS stage, count(*) AS bad, sum(event_id) AS ids FROM events WHERE event_type = 'error'")
def read_json_errors(spark, sf):
    """Lines that are no JSON object come back as error records."""
    path = new_dir(spark, "lines")
    events = load(spark, sf, "events")
    line = F.to_json(F.struct("event_id", "event_type"))
    events.select(F.when(F.col("event_type") == "error", F.col("event_id").cast("string")).otherwise(line)).write.text(path)
    bad = FlexReader(spark).json([path], "lines", discover_types=False).errors().df
    return bad.groupBy("stage").agg(F.count("*").alias("bad"), F.sum(F.col("record").cast("long")).alias("ids"))


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity >= 25 GROUP BY l_returnflag")
def read_parquet_frame(spark, sf):
    frame = FlexReader(spark).from_options("parquet", {"paths": [f"{sf}/lineitem.parquet"]}, push_down_predicate="l_quantity >= 25")
    return FlexFrame.fromDF(frame.toDF(), "lines").df.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query(_ORDERS)
def json_roundtrip(spark, sf):
    path = new_dir(spark, "orders-json")
    FlexFrame(_orders(spark, sf)).write("file", {"path": path}, "json")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    read = FlexReader(spark).from_options("file", {"paths": [path]}, "json").df
    return read.select(*columns, F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 50000")
def json_partitioned(spark, sf):
    """JSON in folders: the folders' column comes back, and only the folders the predicate needs are looked at."""
    path = new_dir(spark, "orders-by-status")
    FlexFrame(_orders(spark, sf)).write("file", {"path": path, "partitionBy": ["o_orderstatus"]}, "json")
    read = FlexReader(spark).from_options("file", {"paths": [path]}, "json", push_down_predicate="o_orderstatus = 'F' AND o_totalprice > 50000")
    return read.df.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")


@query("""
SELECT count(*) FILTER (WHERE event_id % 7 <> 0 AND event_id % 5 <> 0) AS good, count(*) FILTER (WHERE event_id % 7 = 0) AS broken_lines,
       count(*) FILTER (WHERE event_id % 7 <> 0 AND event_id % 5 = 0) AS broken_texts FROM events""")
def json_limits_one_pass(spark, sf):
    """Broken lines and broken boxed text within limits: types, rows, errors and limits from one pass over the source."""
    path, out = new_dir(spark, "event-lines"), new_dir(spark, "event-boxes")
    boxed = F.when(F.col("event_id") % 5 == 0, F.lit("{")).otherwise(F.to_json(F.struct("user_id", "event_type")))
    line = F.when(F.col("event_id") % 7 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("event_id", boxed.alias("box"))))
    load(spark, sf, "events").select(line.alias("value")).write.text(path)
    stage = new_dir(spark, "parsed")
    frame = FlexReader(spark).from_options("file", {"paths": [path]}, "json", staging_path=stage)
    opened = frame.unbox("box", "json", "user_id bigint, event_type string", staging_path=stage, total_threshold=2**40)
    opened.write("file", {"path": out}, "parquet")
    found = opened.errors().df.groupBy().pivot("stage", ["read_json", "unbox"]).count()
    good = spark.read.parquet(out).where("box is not null and box.user_id is not null").agg(F.count("*").alias("good"))
    counted = good.select("good", F.lit(0).cast("long").alias("broken_lines"), F.lit(0).cast("long").alias("broken_texts"))
    errors = found.select(F.lit(0).cast("long").alias("good"), F.col("read_json").alias("broken_lines"), F.col("unbox").alias("broken_texts"))
    return counted.unionByName(errors).agg(*[F.sum(c).alias(c) for c in counted.columns])


@query("SELECT event_id, user_id, event_type, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS copies FROM events")
def json_root_array_schema(spark, sf):
    """Root arrays count as their elements, also where the schema is given."""
    path = new_dir(spark, "arrays")
    record = F.to_json(F.struct("event_id", "user_id", "event_type"))
    line = F.when(F.col("event_id") % 3 == 0, record).otherwise(F.concat(F.lit("["), record, F.lit(","), record, F.lit("]")))
    load(spark, sf, "events").select(line).write.text(path)
    read = FlexReader(spark).from_options("file", {"paths": [path]}, "json", schema="event_id bigint, user_id bigint, event_type string").df
    return read.groupBy("event_id", "user_id", "event_type").agg(F.count("*").cast("int").alias("copies"))


@query("SELECT event_id, 'u' || user_id AS who, event_type AS kind, value AS amount FROM events")
def json_data_keys(spark, sf):
    """Objects keyed by data become maps: one node for all keys, however many there are."""
    path = new_dir(spark, "keyed")
    inner = F.struct(F.col("event_type").alias("kind"), F.array("value").alias("amounts"))
    load(spark, sf, "events").select("event_id", F.create_map(F.concat(F.lit("u"), "user_id"), inner).alias("by")).write.json(path)
    frame = FlexReader(spark).from_options("file", {"paths": [path]}, "json", {"asMap": ["by"]})
    assert frame.df.schema["by"].dataType.simpleString() == "map<string,struct<amounts:array<double>,kind:string>>"
    return frame.df.select("event_id", F.explode("by").alias("who", "x")).select("event_id", "who", "x.kind", F.col("x.amounts")[0].alias("amount"))


@query("SELECT event_id, event_type, 'compressionType lzo needs a format' AS refused FROM events")
def codec_needs_format(spark, sf):
    """A codec that has to be read in a named format is refused without one; with one the format's reader decides."""
    path = new_dir(spark, "packed")
    load(spark, sf, "events").select("event_id", "event_type").write.option("compression", "gzip").json(path)
    reader = FlexReader(spark)
    try:
        reader.from_options("file", {"paths": [path], "compressionType": "lzo"})
        refused = "not at all"
    except ValueError as e:
        refused = str(e)
    read = reader.from_options("file", {"paths": [path], "compressionType": "gzip"}, "json").df
    return read.select("event_id", "event_type", F.lit(refused).alias("refused"))


@query("""
SELECT doc_id, lang AS "origin.lang", source AS "origin.source", len(string_split(text, chr(10))) AS n_lines FROM documents""")
def collection_write_relationalized(spark, sf):
    """All tables of a pivot written in one go, the source read and keyed once."""
    from flexspark.examples.projection import documents_nested

    tables = FlexFrame(documents_nested(spark, sf)).relationalize("documents", new_dir(spark, "pivot"), key_cols="doc_id")
    base = new_dir(spark, "tables")
    FlexWriter().from_options(tables, "file", {"path": base}, "parquet")
    root, lines = spark.read.parquet(f"{base}/documents"), spark.read.parquet(f"{base}/documents_lines")
    counted = lines.groupBy("id").agg(F.count("*").alias("n_lines"))
    return root.join(counted, F.col("lines") == F.col("id")).select("doc_id", "`origin.lang`", "`origin.source`", "n_lines")


@query(_ORDERS)
def orc_roundtrip(spark, sf):
    path = new_dir(spark, "orders-orc")
    FlexWriter().from_options(FlexFrame(_orders(spark, sf)), "orc", {"path": path, "mode": "overwrite"})
    return FlexReader(spark).from_options("orc", {"paths": [path]}).df


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus")
def parquet_partitioned(spark, sf):
    path = new_dir(spark, "orders-parquet")
    FlexFrame(_orders(spark, sf)).write("file", {"path": path, "partitionBy": ["o_orderstatus"]}, "parquet")
    read = FlexReader(spark).from_options("parquet", {"paths": [path]}, push_down_predicate="o_orderstatus in ('F', 'O')")
    return read.df.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(_ORDERS)
def catalog_roundtrip(spark, sf):
    db, table = database(spark), _table("orders")
    frame, writer = FlexFrame(_orders(spark, sf)), FlexWriter()
    writer.from_catalog(frame.filter("o_orderstatus = 'F'"), db, table, additional_options={"path": new_dir(spark, table)})
    writer.from_catalog(frame.filter("o_orderstatus <> 'F'"), name_space=db, table_name=table)
    return FlexReader(spark).from_catalog(name_space=db, table_name=table).df


@query(_ORDERS)
def catalog_data_frame(spark, sf):
    db, table = database(spark), _table("orders_plain")
    write_data_frame(_orders(spark, sf), db, table)
    return FlexDataFrameReader(spark).from_catalog(db, table, stream=False)


def _partitioned_table(spark, sf):
    db, table = database(spark), _table("orders_by_status")
    write_data_frame(_orders(spark, sf), db, table, path=new_dir(spark, table), partitionBy=["o_orderstatus"])
    return db, table


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def catalog_predicate(spark, sf):
    db, table = _partitioned_table(spark, sf)
    return FlexReader(spark).from_catalog(db, table, push_down_predicate="o_orderstatus = 'P'").df.select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("""
SELECT n AS name, t AS type, (SELECT count(*) FROM orders) AS n_rows FROM (VALUES
('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string'), ('o_orderstatus', 'string')) AS v(n, t)""")
def catalog_schema(spark, sf):
    db, table = _partitioned_table(spark, sf)
    reader = FlexReader(spark)
    fields = [F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in reader.catalog_schema(db, table).fields]
    counted = reader.from_catalog(db, table).df.agg(F.count("*").alias("n_rows"))
    return counted.select("n_rows", F.inline(F.array(*fields)))


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def collection_write(spark, sf):
    """Every member of a set under its own name."""
    base, customer = new_dir(spark, "segments"), load(spark, sf, "customer")
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    FlexWriter().from_options(FrameSet([FlexFrame(customer.where(F.col("c_mktsegment") == n), n) for n in names]), "file", {"path": base}, "parquet")
    read = spark.read.parquet(*[f"{base}/{n}" for n in names])
    return read.groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("""
SELECT 'event_id is ok' AS what, count(*) AS n FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'amount is not double', count(*) FROM events WHERE event_type = 'error'""")
def write_errors(spark, sf):
    """Rows whose required field does not fit its type are refused by the sink and returned."""
    path = new_dir(spark, "checked")
    amount = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    events = FlexFrame(load(spark, sf, "events").select("event_id", amount.alias("amount")), "events")
    refused = events.write("file", {"path": path, "required": {"amount": "double"}}, "parquet")
    assert refused.name == "events_errors"
    good = spark.read.parquet(path).select(F.lit("event_id is ok").alias("what"))
    return good.union(refused.df.select("error_message")).groupBy("what").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, true AS stamped FROM orders")
def stamped_path(spark, sf):
    """Output name with a time stamp before the extension."""
    base = new_dir(spark, "stamped")
    fixed = stamped(f"{base}/orders.parquet", datetime.datetime(2024, 3, 9, 7, 5))
    FlexWriter().from_options(FlexFrame(_orders(spark, sf)), "file", {"path": fixed}, "parquet")
    named = spark.read.parquet(base + "/orders_2024-03-09-07_05.parquet")
    return named.agg(F.count("*").alias("n"), F.lit(fixed.endswith("orders_2024-03-09-07_05.parquet")).alias("stamped"))


@query("SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders")
def spigot_pass(spark, sf):
    """A sample is written on the way; the frame goes on unchanged."""
    passed = FlexFrame(_orders(spark, sf)).spigot(new_dir(spark, "spigot"), {"topk": 50, "prob": 0.5})
    return passed.df.agg(F.count("*").alias("n"), exact_sum("o_totalprice").alias("total"))


def distinct_known(sample, source, key):
    """Which rows a sample holds is not promised: count its distinct rows that the source knows."""
    return sample.join(source.select(key), key, "left_semi").agg(F.count_distinct(key).alias("n"))


@query("SELECT least(100, count(*)) AS n FROM orders")
def sample_rows(spark, sf):
    reader = FlexReader(spark)
    sample = reader.sample_from_options("parquet", {"paths": [f"{sf}/orders.parquet"]}, 100, {"fraction": 0.5, "seed": 7})
    return distinct_known(sample.df, load(spark, sf, "orders"), "o_orderkey")


@query("SELECT least(10, count(*)) AS n FROM orders")
def sample_catalog(spark, sf):
    db, table = _partitioned_table(spark, sf)
    return distinct_known(FlexReader(spark).sample_from_catalog(db, table, 10).df, load(spark, sf, "orders"), "o_orderkey")


@query("SELECT o_orderstatus, count(*) AS n_rows, max(o_orderdate) AS latest, true AS found FROM orders GROUP BY o_orderstatus")
def purge_dry_run(spark, sf):
    """Old files of a folder are listed, none is touched: the rows are still there afterwards."""
    path = new_dir(spark, "to-purge")
    _orders(spark, sf).repartition(3).write.parquet(path)
    later = datetime.datetime.now() + datetime.timedelta(days=30)
    found = purge_path(spark, path, now=later).where("path like '%.parquet'").count() >= 3
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"), F.max("o_orderdate").alias("latest"), F.lit(found).alias("found"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus")
def purge_table(spark, sf):
    """One partition of a scratch table is purged for real: files deleted, partition dropped, the others whole."""
    db, table = _partitioned_table(spark, sf)
    later = datetime.datetime.now() + datetime.timedelta(days=30)
    purge_catalog_table(spark, db, table, "o_orderstatus = 'F'", dry_run=False, now=later)
    assert spark.sql(f"SHOW PARTITIONS `{db}`.`{table}`").count() == 2
    return spark.table(f"`{db}`.`{table}`").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def bookmark_paused(spark, sf):
    """A paused bookmark: the files modified in a range of time."""
    path, target = new_dir(spark, "event-files"), new_dir(spark, "event-files-seen")
    events = load(spark, sf, "events")
    events.write.parquet(path)
    now, day = datetime.datetime.now(datetime.timezone.utc), datetime.timedelta(days=1)
    paused = Bookmarks(new_dir(spark, "bookmarks"), "events job", "pause", now - day, now + day)
    paused.read(spark, "inbox", path, "parquet", events.schema, lambda df: df.write.parquet(target))
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"))


@query("""
WITH f AS (SELECT *, o_orderkey % 3 AS part FROM orders)
SELECT 'first' AS run, 'orders' AS source, count(*) AS n, sum(o_orderkey) AS keys FROM f WHERE part < 2
UNION ALL SELECT 'first', 'customers', count(*), sum(c_custkey) FROM customer
UNION ALL SELECT 'repeated', 'orders', count(*), sum(o_orderkey) FROM f WHERE part < 2
UNION ALL SELECT 'repeated', 'customers', count(*), sum(c_custkey) FROM customer
UNION ALL SELECT 'next', 'orders', count(*), sum(o_orderkey) FROM f WHERE part = 2
UNION ALL SELECT 'next', 'customers', 0, NULL""")
def bookmark_commit(spark, sf):
    """Two sources: a run that dies before its commit is repeated whole; after a commit only new files are read, from both sources."""
    orders, customer = load(spark, sf, "orders"), load(spark, sf, "customer")
    inbox, people, root = new_dir(spark, "order-files"), new_dir(spark, "customer-files"), new_dir(spark, "ledger")
    for part in (0, 1):
        orders.where(F.col("o_orderkey") % 3 == part).write.mode("append").parquet(inbox)
    customer.write.json(people)

    def run(label, commit):
        job = JobRun(spark, root, "nightly orders")
        reader = FlexReader(spark, run=job)
        a = reader.from_options("file", {"path": inbox}, "parquet", transformation_ctx="orders").df
        b = reader.from_options("file", {"path": people}, "json", transformation_ctx="customers", schema=customer.schema).df
        sums = [df.agg(F.count("*").alias("n"), F.sum(key).alias("keys")).select(F.lit(label).alias("run"), F.lit(source).alias("source"), "n", "keys") for df, key, source in ((a, "o_orderkey", "orders"), (b, "c_custkey", "customers"))]
        out = sums[0].unionByName(sums[1])
        if commit:
            job.commit()
        return out

    first, repeated = run("first", False), run("repeated", True)
    orders.where(F.col("o_orderkey") % 3 == 2).write.mode("append").parquet(inbox)
    return first.unionByName(repeated).unionByName(run("next", True))


@query("""
SELECT o_orderkey AS id, o_orderkey % 2 AS half, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority, o_totalprice AS price, NULL AS refused
FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 10 <> 1
UNION ALL SELECT NULL, NULL, NULL, NULL, 'price is not double: ' || count(*) FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 10 = 1""")
def catalog_evolving_append(spark, sf):
    """A second append brings a new column, columns in another order and case, keys as text, and prices some of which are no numbers."""
    db, table, writer = database(spark), _table("orders_evolving"), FlexWriter()
    orders = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 2).alias("half"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"))
    even, odd = orders.where("half = 0").drop("priority"), orders.where("half = 1")
    price = F.when(F.col("id") % 10 == 1, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    writer.from_catalog(FlexFrame(even), db, table, additional_options={"path": new_dir(spark, table)})
    refused = writer.from_catalog(FlexFrame(odd.select("priority", price.alias("PRICE"), F.col("id").cast("string").alias("id"), "half")), db, table).df
    kept = spark.table(f"{db}.{table}").select("id", "half", "priority", "price", F.lit(None).cast("string").alias("refused"))
    counted = refused.groupBy("error_message").agg(F.count("*").alias("n"))
    told = counted.select(*[F.lit(None).cast(t).alias(c) for c, t in (("id", "long"), ("half", "long"), ("priority", "string"), ("price", "double"))], F.concat_ws(": ", "error_message", F.col("n").cast("string")).alias("refused"))
    return kept.unionByName(told)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5('7:' || o_orderkey) LIMIT 100")
def sample_seeded(spark, sf):
    """A hundred rows drawn by a seed: the same ones on every run and however the file is cut."""
    reader = FlexReader(spark)
    sample = reader.sample_from_options("parquet", {"paths": [f"{sf}/orders.parquet"]}, 100, {"seed": 7, "key": ["o_orderkey"]})
    return sample.df.select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT event_id, event_type, user_id FROM events ORDER BY md5('11:' || event_id) LIMIT 50")
def spigot_seeded(spark, sf):
    """A sample on the way, drawn by a seed, read back."""
    path = new_dir(spark, "spigot")
    FlexFrame(load(spark, sf, "events")).spigot(path, {"topk": 50, "seed": 11, "key": ["event_id"]})
    return spark.read.schema("event_id long, event_type string, user_id long").json(path)
