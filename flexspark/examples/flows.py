"""Streaming queries, incremental reads and composite jobs."""

from pyspark.sql import functions as F

from flexspark.examples.registry import exact_sum, load, load_wide, query
from flexspark.functions.columns import add_ingestion_time_columns
from flexspark.jobs.entities import KINDS, count_entities, detect_entities, mask_entities
from flexspark.jobs.measures import check_measures, lies_between, measure, merge_measures, repeated_rows, report, unmatched_rows
from flexspark.jobs.summary import ENTITY_PATTERNS, entity_share as share_of_entities, evaluate_rules
from flexspark.jobs.versions import backup, restore, rollback, write_backup
from flexspark.operators.rows import latest_per_key
from flexspark.sources.bookmarks import Bookmarks
from flexspark.sources.read import FlexDataFrameReader
from flexspark.sources.scratch import new_dir, stage
from flexspark.sources.write import write_data_frame
from flexspark.streaming.batches import for_each_batch, sample_stream as take_sample
from flexspark.streaming.sink import BatchSink


def event_files(spark, sf):
    """Events as a folder of files, streamed four files per batch."""
    path = new_dir(spark, "event-files")
    events = load(spark, sf, "events")
    events.repartition(8, "event_id").write.parquet(path)
    stream = FlexDataFrameReader(spark).from_options("file", {"path": path}, "parquet", {"maxFilesPerTrigger": 4}, events.schema)
    return stream, path


@query("SELECT event_type, count(*) AS n, sum(event_id) AS ids FROM events GROUP BY event_type")
def stream_foreach(spark, sf):
    """Micro-batches written one by one; the first attempt at the second batch fails and is retried."""
    stream, _ = event_files(spark, sf)
    target, failed = new_dir(spark, "batches"), []

    def process(batch, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost once")
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    for_each_batch(stream, process, "availableNow", new_dir(spark, "state"), wait=lambda s: None)
    assert failed == [1]
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT event_type, count(*) AS n, sum(event_id) AS ids, 2 AS batches FROM events GROUP BY event_type")
def stream_once(spark, sf):
    """Micro-batches put into a table; the first batch fails before it counts, the second after it does, and each is repeated: every row is there once."""
    stream, _ = event_files(spark, sf)
    sink, tried, put = BatchSink(spark, new_dir(spark, "sink"), "events", stream.schema), [], []

    def process(batch, batch_id):
        tried.append(batch_id)
        if tried == [0]:
            batch.write.parquet(f"{sink.base}/rows/attempt-{0:032x}")
            raise RuntimeError("lost before its commit")
        put.append((batch_id, sink.write(batch, batch_id)))
        if tried == [0, 0, 1]:
            raise RuntimeError("lost after its commit")

    for_each_batch(stream, process, "availableNow", new_dir(spark, "state"), wait=lambda s: None)
    batches = len([i for i, new in put if new])
    return sink.read().groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.lit(batches).alias("batches"))


@query("SELECT count(*) AS n_rows, 2 AS batches FROM events")
def stream_metrics(spark, sf):
    """Metrics of every batch arrive while the stream runs; only the latest ones are kept."""
    stream, _ = event_files(spark, sf)
    live = []
    kept = for_each_batch(stream, lambda batch, i: None, "availableNow", new_dir(spark, "state"), on_batch=live.append)
    assert kept == live and all(m["ms"] >= 0 for m in live)
    return spark.createDataFrame([(m["batch"], m["rows"]) for m in live], "batch long, n long").agg(F.sum("n").alias("n_rows"), F.count("*").cast("int").alias("batches"))


@query("SELECT event_type, count(*) AS n, 2 AS runs FROM events GROUP BY event_type")
def bookmark_incremental(spark, sf):
    """Two runs over a growing folder, and a third that finds nothing new."""
    path, target = new_dir(spark, "inbox"), new_dir(spark, "inbox-seen")
    bookmarks = Bookmarks(new_dir(spark, "bookmarks"), "events job")
    events, runs = load(spark, sf, "events"), []

    def process(df):
        runs.append(len(runs))
        df.write.mode("overwrite").parquet(f"{target}/run={runs[-1]}")

    for part in ("event_type in ('click', 'view')", "event_type not in ('click', 'view')", None):
        if part:
            events.where(part).write.mode("append").parquet(path)
        bookmarks.read(spark, "inbox", path, "parquet", events.schema, process)
    seen = spark.read.parquet(target)
    return seen.groupBy("event_type").agg(F.count("*").alias("n"), F.lit(len(runs)).alias("runs"))


@query("SELECT least(100, count(*)) AS n FROM events")
def stream_sample(spark, sf):
    from flexspark.examples.storage import distinct_known

    stream, _ = event_files(spark, sf)
    sample = take_sample(stream, "1 second", polling_time_ms=20000, record_polling_limit=100)
    return distinct_known(sample.df, load(spark, sf, "events"), "event_id")


def _drained(spark, stream):
    target = new_dir(spark, "drained")
    query = (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", new_dir(spark, "state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(target)


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def stream_options(spark, sf):
    stream, _ = event_files(spark, sf)
    return _drained(spark, stream.select("user_id")).groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY event_type")
def stream_catalog(spark, sf):
    from flexspark.examples.storage import _table, database

    db, table = database(spark), _table("events")
    write_data_frame(load(spark, sf, "events"), db, table)
    stream = FlexDataFrameReader(spark).from_catalog(db, table)
    return _drained(spark, stream).groupBy("event_type").agg(exact_sum("value").alias("total"))


@query("SELECT event_id, year(ts) AS ingest_year, month(ts) AS ingest_month, day(ts) AS ingest_day FROM events")
def stream_ingest_columns(spark, sf):
    stream, _ = event_files(spark, sf)
    dated = add_ingestion_time_columns(stream, "day", ts="ts")
    return _drained(spark, dated.select("event_id", "ingest_year", "ingest_month", "ingest_day"))


_AS_OF = "1998-06-01 00:00:00"


def _versions(spark, sf):
    """Orders read as versions: a customer is the versioned name, the order date its time of change."""
    return load(spark, sf, "orders").select(
        F.col("o_custkey").alias("name"), F.col("o_orderdate").alias("updateTime"), "o_orderkey", F.col("o_orderstatus").alias("owner")
    )


def _parts(spark, sf):
    """Line items as parts of suppliers, which share the customers' numbers."""
    return load(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("tableName"), F.col("l_shipdate").alias("creationTime"), "l_orderkey", "l_linenumber"
    )


def _rolled(spark, sf):
    return rollback(_versions(spark, sf), _parts(spark, sf), F.lit(_AS_OF).cast("timestamp_ntz"))


@query(f"""
SELECT name, "updateTime", o_orderkey, owner FROM (
  SELECT o_custkey AS name, o_orderdate AS "updateTime", o_orderkey, o_orderstatus AS owner,
         rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r
  FROM orders WHERE o_orderdate <= TIMESTAMP '{_AS_OF}') WHERE r = 1""")
def rollback_restore(spark, sf):
    return _rolled(spark, sf)["restore"].df


@query(f"SELECT o_custkey AS name FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate <= TIMESTAMP '{_AS_OF}'")
def rollback_delete(spark, sf):
    return _rolled(spark, sf)["delete"].df


@query(f"""
SELECT l_suppkey AS "tableName", l_orderkey, l_linenumber FROM lineitem
WHERE l_shipdate > TIMESTAMP '{_AS_OF}' AND l_suppkey IN (SELECT o_custkey FROM orders)""")
def rollback_delete_parts(spark, sf):
    return _rolled(spark, sf)["delete_parts"].df.select("tableName", "l_orderkey", "l_linenumber")


def _entities(spark, sf):
    customers = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("name"), F.col("c_mktsegment").alias("owner"), F.lit(None).cast("bigint").alias("tableName"), F.lit(None).cast("bigint").alias("part")
    )
    orders = load(spark, sf, "orders").select(
        F.lit(None).cast("bigint").alias("name"), F.lit(None).cast("string").alias("owner"), F.col("o_custkey").alias("tableName"), F.col("o_orderkey").alias("part")
    )
    return customers, orders


def _restored(spark, sf):
    path = new_dir(spark, "backup")
    saved = backup(*_entities(spark, sf), owner="BUILDING", database="sales")
    write_backup(saved, path)
    return restore(spark, path, saved.schema)


@query("SELECT c_custkey AS name, c_mktsegment AS owner FROM customer WHERE c_mktsegment = 'BUILDING'")
def backup_restore(spark, sf):
    return _restored(spark, sf)["table"].df.select("name", "owner")


@query("""
SELECT o_custkey AS "tableName", o_orderkey AS part FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def backup_restore_parts(spark, sf):
    return _restored(spark, sf)["partition"].df.select("tableName", "part")


@query("""
WITH keys AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY l_orderkey)
SELECT 'complete' AS rule, 'l_partkey' AS "column", count(*) AS checked, count(*) FILTER (WHERE l_partkey IS NULL) AS failed,
       count(*) FILTER (WHERE l_partkey IS NULL) = 0 AS passed FROM lineitem
UNION ALL SELECT 'in_range', 'l_quantity', count(*), count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 40), count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 40) = 0 FROM lineitem
UNION ALL SELECT 'in_set', 'l_returnflag', count(*), count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')), count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) = 0 FROM lineitem
UNION ALL SELECT 'row_count', NULL, count(*), CASE WHEN count(*) >= 1 THEN 0 ELSE count(*) END, count(*) >= 1 FROM lineitem
UNION ALL SELECT 'unique', 'l_orderkey', sum(c), coalesce(sum(c) FILTER (WHERE c > 1), 0), coalesce(sum(c) FILTER (WHERE c > 1), 0) = 0 FROM keys""")
def quality_rules(spark, sf):
    rules = [
        {"rule": "complete", "column": "l_partkey"},
        {"rule": "in_range", "column": "l_quantity", "min": 1, "max": 40},
        {"rule": "in_set", "column": "l_returnflag", "values": ["A", "N"]},
        {"rule": "row_count", "min": 1},
        {"rule": "unique", "column": "l_orderkey"},
    ]
    return evaluate_rules(load(spark, sf, "lineitem"), rules).select("rule", "column", "checked", "failed", "passed")


@query("\nUNION ALL ".join(
    f"""SELECT 'text' AS "column", '{e}' AS entity, count(*) AS "rows", count(*) FILTER (WHERE regexp_matches(text, '{p}')) AS matches FROM documents"""
    for e, p in ENTITY_PATTERNS.items()
))
def entity_share(spark, sf):
    return share_of_entities(load_wide(spark, sf, "documents"), ["text"])


_MEASURED = ["l_quantity", "l_extendedprice", "l_orderkey", "l_linestatus"]


def _measures(spark, sf):
    """States of two parts of the line items, stored apart and merged."""
    items = load(spark, sf, "lineitem").select(*_MEASURED, "l_returnflag")
    parts = [stage(measure(items.where(w), _MEASURED), "measures") for w in ("l_returnflag = 'N'", "l_returnflag <> 'N'")]
    return merge_measures(*parts)


@query("\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS nulls, {"NULL" if c == "l_linestatus" else f"CAST(min({c}) AS DOUBLE)"} AS low,
       {"NULL" if c == "l_linestatus" else f"CAST(max({c}) AS DOUBLE)"} AS high, {f"min({c})" if c == "l_linestatus" else "NULL"} AS low_text,
       {f"max({c})" if c == "l_linestatus" else "NULL"} AS high_text, true AS near FROM lineitem""" for c in _MEASURED
))
def measures_merged(spark, sf):
    """Measures of two parts merged; ``near``: the sketched distinct count and median are those of the whole, within 5 % of count and rank."""
    found, items = report(_measures(spark, sf), [0.5]), load(spark, sf, "lineitem")
    medians = {r["column"]: r["quantiles"][0] for r in found.select("column", "quantiles").collect()}  # a row a column
    whole = items.agg(*[F.count_distinct(c).alias(f"d_{c}") for c in _MEASURED], *[lies_between(F.col(c), medians[c], 0.45, 0.55).alias(f"q_{c}") for c in _MEASURED[:3]])
    truth = whole.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(f"d_{c}").alias("d"), (F.col(f"q_{c}") if c != "l_linestatus" else F.lit(None).cast("boolean")).alias("q")) for c in _MEASURED
    ])))
    near = (F.abs(F.col("distinct_values") / F.col("d") - 1) < 0.05) & F.coalesce("q", F.lit(True))
    return found.join(truth, F.col("column") == F.col("c")).select("column", "n", "nulls", "low", "high", "low_text", "high_text", near.alias("near"))


@query("""
SELECT 'rows' AS rule, 'l_quantity' AS "column", CAST(count(*) AS DOUBLE) AS value, count(*) >= 1 AS passed FROM lineitem
UNION ALL SELECT 'null_share', 'l_linestatus', avg(CASE WHEN l_linestatus IS NULL THEN 1.0 ELSE 0 END), avg(CASE WHEN l_linestatus IS NULL THEN 1.0 ELSE 0 END) <= 0.01 FROM lineitem
UNION ALL SELECT 'low', 'l_quantity', CAST(min(l_quantity) AS DOUBLE), min(l_quantity) >= 2 FROM lineitem
UNION ALL SELECT 'high', 'l_extendedprice', CAST(max(l_extendedprice) AS DOUBLE), max(l_extendedprice) <= 1000000 FROM lineitem""")
def measures_rules(spark, sf):
    """Rules on merged states."""
    rules = [
        {"rule": "rows", "column": "l_quantity", "min": 1},
        {"rule": "null_share", "column": "l_linestatus", "max": 0.01},
        {"rule": "low", "column": "l_quantity", "min": 2},
        {"rule": "high", "column": "l_extendedprice", "max": 1000000},
    ]
    return check_measures(_measures(spark, sf), rules)


@query("""
SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
WHERE (l_orderkey, l_partkey) IN (SELECT (l_orderkey, l_partkey) FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)""")
def rule_repeated(spark, sf):
    """Line items whose order and part are not unique together."""
    return repeated_rows(load(spark, sf, "lineitem"), ["l_orderkey", "l_partkey"]).select("l_orderkey", "l_partkey", "l_linenumber")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def rule_unmatched(spark, sf):
    """Orders that refer to no customer of a segment."""
    known = load(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return unmatched_rows(load(spark, sf, "orders"), ["o_custkey"], known, ["c_custkey"]).select("o_orderkey", "o_custkey")


# The confirmations in SQL; its patterns know no look-around, so word borders stand for it.
_CONFIRMED = {
    "EMAIL": "NOT contains(x, '..')",
    "IP_ADDRESS": "list_max(list_transform(string_split(x, '.'), lambda o: CAST(o AS INTEGER))) <= 255",
    "CREDIT_CARD": """regexp_matches(x, '^[2-6]') AND list_sum(list_transform(range(1, len(regexp_replace(x, '[^0-9]', '', 'g')) + 1),
        lambda i: CASE WHEN i % 2 = 1 THEN CAST(regexp_replace(x, '[^0-9]', '', 'g')[-i] AS INTEGER)
                       ELSE 2 * CAST(regexp_replace(x, '[^0-9]', '', 'g')[-i] AS INTEGER) // 10 + 2 * CAST(regexp_replace(x, '[^0-9]', '', 'g')[-i] AS INTEGER) % 10 END)) % 10 = 0""",
    "IBAN": """list_reduce(list_prepend(0, list_transform(string_split(x[5:] || x[:4], ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END)),
        lambda a, v: (a * CASE WHEN v >= 10 THEN 100 ELSE 10 END + v) % 97) = 1""",
    "PHONE_NUMBER": "x[1] >= '2' AND x[5] >= '2' AND x[2:3] <> '11' AND x[6:7] <> '11'",
    "SSN": "x[1:3] NOT IN ('000', '666') AND x[1] <> '9' AND x[5:6] <> '00' AND x[8:] <> '0000'",
}


def _sql_pattern(name: str) -> str:
    return KINDS[name].pattern.replace("(?<![0-9A-Za-z_])", r"\b").replace("(?![0-9A-Za-z_])", r"\b")


def _candidates(name: str, table: str) -> str:
    """(doc_id, i, x, hits, gaps): every candidate of a kind, one a row."""
    cut = f"regexp_extract_all(text, '{_sql_pattern(name)}') AS hits, string_split_regex(text, '{_sql_pattern(name)}') AS gaps"
    return f"(SELECT *, hits[i] AS x FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (SELECT doc_id, {cut} FROM {table})))"


@query("\nUNION ALL ".join(
    f"""SELECT 'text' AS "column", '{n}' AS entity, (SELECT count(*) FROM documents) AS "rows", count(DISTINCT doc_id) AS matches, count(*) AS found
FROM {_candidates(n, 'documents')} WHERE {c}""" for n, c in _CONFIRMED.items()
))
def entity_counts(spark, sf):
    """Entities that checksums and number ranges confirm."""
    return count_entities(load_wide(spark, sf, "documents"), ["text"])


@query("\nUNION ALL ".join(
    f"""SELECT doc_id, '{n}' AS entity, start, start + length(x) AS stop FROM (
  SELECT doc_id, x, list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS start
  FROM {_candidates(n, 'documents')}) WHERE {c}""" for n, c in _CONFIRMED.items()
))
def entity_spans(spark, sf):
    """Place of every confirmed entity."""
    found = detect_entities(load_wide(spark, sf, "documents"), "text")
    return found.select("doc_id", F.explode("entities").alias("e")).select("doc_id", "e.entity", F.col("e.start").cast("long").alias("start"), F.col("e.stop").cast("long").alias("stop"))


def _masked_sql(names: list[str]) -> str:
    parts, table = [], "documents"
    for n in names:
        shown = f"string_agg(gaps[i] || CASE WHEN i > len(hits) THEN '' WHEN {_CONFIRMED[n]} THEN '[{n}]' ELSE x END, '' ORDER BY i)"
        every = _candidates(n, table).replace("len(hits) + 1", "len(hits) + 2")
        parts.append(f"m{len(parts)} AS (SELECT doc_id, {shown} AS text FROM {every} GROUP BY doc_id)")
        table = f"m{len(parts) - 1}"
    return f"WITH {', '.join(parts)} SELECT doc_id, length(text) AS n_chars, md5(text) AS masked FROM {table}"


@query(_masked_sql(["EMAIL", "CREDIT_CARD", "IP_ADDRESS"]))
def entity_masked(spark, sf):
    """Texts with three kinds of confirmed entities replaced."""
    masked = mask_entities(load_wide(spark, sf, "documents"), "text", ["EMAIL", "CREDIT_CARD", "IP_ADDRESS"])
    return masked.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("masked"))


@query("""
SELECT event_type, user_id, event_id FROM (
  SELECT *, rank() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC) AS r FROM events) WHERE r = 1""")
def latest_pair(spark, sf):
    """Latest version of a key made of two columns."""
    keyed = load(spark, sf, "events").withColumn("pair", F.struct("event_type", "user_id"))
    return latest_per_key(keyed, "pair", "ts").select("event_type", "user_id", "event_id")


@query("SELECT count(DISTINCT {'a': c_nationkey, 'b': c_mktsegment}) AS distinct_count FROM customer")
def sql_pairs(spark, sf):
    """The pair count as SQL text over a view, written with overwrite and read back."""
    load(spark, sf, "customer").createOrReplaceTempView("customer_pairs")
    counted = spark.sql("SELECT COUNT(DISTINCT struct(c_nationkey, c_mktsegment)) AS distinct_count FROM customer_pairs")
    path = new_dir(spark, "pairs")
    counted.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
