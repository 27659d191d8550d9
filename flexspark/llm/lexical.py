"""Ranked lexical search: all documents for every item, in integers, by term partitioning with pipelined accumulators.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. N counts the documents with a term, L all their terms,
n one document's, df the documents with a term, tf its occurrences in one. A term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))); with
m = 25 + (75 n N) div L a posting's impact is (10^9 tf) div (1000 tf + 8 m), and a document's score the sum of w * impact over the item's terms.

How it runs:

* One pass over the texts posts the items' terms. Documents stand in buckets of at most DOCS rows and about 2 MB of text; a bucket numbers them by key.
* The terms are dealt to OWNERS owners, the heaviest (rarest) first, the shares of all postings as stated there.
* A bundle is BUNDLE items in one bucket, with its sparse accumulators (item, document, score so far). It goes from owner to owner: each stage
  cogroups the bundles with the owner's postings of their bucket and adds its contributions. Bundles are written between the stages, so a lost
  executor costs one stage at most.
* After each stage the k-th best sum so far of every item is a floor. An accumulator whose sum and the largest that all later owners can add stay
  below the floor cannot come among the first k; it is let go, and it alone. Ties with the floor stay.
* Last, every bundle gives its own first k, and these are ranked.

Only the items' terms and figures for each of them are held by the driver and sent to all tasks: items are searched in passes of about PAIRS (item,
term) pairs. No text or document list leaves the tasks. Terms are told apart by 64 bits of hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flexspark.llm import hashing as H
from flexspark.sources.scratch import stage

DOCS, BUNDLE, PAIRS = 2048, 256, 1 << 20
OWNERS = (0.05, 0.2, 0.5, 1.0)  # each owner's last term, as a share of all postings


def item_terms(items: DataFrame, item: str) -> DataFrame:
    """(id, h, q): each item's terms and their occurrences. Rows of one id are one item, equal rows counted once; items without terms are not there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = H.WordHasher(H.spaces(punctuation=True))
        for batch in batches:
            first = 0
            for c in H.chunks(batch["text"]):
                w = words(c)
                yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(first + w.doc)), pa.array(w.hash.view(np.int64))], names=["id", "h"])
                first += c.count

    rows = items.select(F.col(f"`{item}`").alias("id"), "text").where(F.col("text").isNotNull()).distinct()
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, h long").groupBy("id", "h").agg(F.count("*").alias("q"))


def postings(docs: DataFrame, key: str, vocab: np.ndarray) -> DataFrame:
    """A row for each bucket: its documents' ids and numbers of terms, and its postings (term, document, tf) by term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col("text").alias("__text"))
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, vocab = H.WordHasher(H.spaces(punctuation=True)), shared.value
        made, part = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for low in range(0, len(batch), DOCS):
                some, at = batch.slice(low, DOCS), 0
                for c in H.chunks(some["__text"]):
                    ids = some["id"].slice(at, c.count)
                    at += c.count
                    order = pc.sort_indices(ids, null_placement="at_start")
                    place = np.argsort(order.to_numpy())
                    w = words(c)
                    t = np.minimum(np.searchsorted(vocab, w.hash), len(vocab) - 1)
                    known = vocab[t] == w.hash
                    u, tf = np.unique(t[known] * c.count + place[w.doc[known]], return_counts=True)
                    one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x, kind))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part | made]),
                            one(ids.take(order), None),
                            one(w.per_doc[order.to_numpy()], pa.int64()),
                            one(u // c.count, pa.int32()),
                            one(u % c.count, pa.int32()),
                            one(tf, pa.int64()),
                        ],
                        names=["bucket", "ids", "n", "term", "doc", "tf"],
                    )
                    made += 1

    return rows.mapInArrow(run, f"bucket long, ids array<{kind}>, n array<long>, term array<int>, doc array<int>, tf array<long>")


def _per_term(size: int, column: str | None, merge: np.ufunc):
    """Function over batches of buckets: each task's count of postings, or merged value of a column, for every term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size, np.int64)
        for batch in batches:
            t = batch["term"].flatten().to_numpy()
            merge.at(out, t, batch[column].flatten().to_numpy() if column else 1)
        t = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(out[t])], names=["term", "v"])

    return run


def _told(rows: DataFrame, size: int, column: str | None, merge: np.ufunc) -> np.ndarray:
    """One number for each term of the vocabulary."""
    part = rows.select("term", *([column] if column else [])).mapInArrow(_per_term(size, column, merge), "term int, v long")
    got = part.groupBy("term").agg((F.sum if merge is np.add else F.max)("v").alias("v")).toArrow()
    out = np.zeros(size, np.int64)
    out[got["term"].to_numpy()] = got["v"].to_numpy()
    return out


def impacts(posted: DataFrame, owner: np.ndarray, owners: int, documents: int, terms: int) -> DataFrame:
    """(owner, bucket, term, doc, impact): the postings of each bucket, a row for each owner that has some there."""
    shared = posted.sparkSession.sparkContext.broadcast(owner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner = shared.value
        for batch in batches:
            for i in range(len(batch)):
                n, term, doc, tf = (batch[c][i].values.to_numpy() for c in ("n", "term", "doc", "tf"))
                m = 25 + (75 * n * documents) // max(terms, 1)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
                of = owner[term]
                for k in range(owners):
                    at = np.flatnonzero(of == k)
                    if len(at):
                        one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([k], pa.int32()), batch["bucket"].slice(i, 1), one(term[at], pa.int32()), one(doc[at], pa.int32()), one(impact[at], pa.int64())],
                            names=["owner", "bucket", "term", "doc", "impact"],
                        )

    return posted.select("bucket", "n", "term", "doc", "tf").mapInArrow(run, "owner int, bucket long, term array<int>, doc array<int>, impact array<long>")


_BUNDLES = "bundle int, bucket long, item array<int>, doc array<int>, score array<long>, top_item array<int>, top array<long>"


def _stage(shared, k: int):
    """One owner's work on a bundle; ``shared`` holds (first, item, weight, floor, later) of the owner's terms and the items."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        first, item, weight, floor, later = shared.value
        bundle, bucket = key[0].as_py(), key[1].as_py()
        base = bundle * BUNDLE
        floor, later = floor[base : base + BUNDLE], later[base : base + BUNDLE]
        acc = np.zeros((len(floor), DOCS), np.int64)
        lists = lambda t, c: t[c].combine_chunks().values.to_numpy() if t.num_rows else np.zeros(0, np.int64)
        acc[lists(left, "item"), lists(left, "doc")] = lists(left, "score")
        term, doc, impact = (lists(right, c) for c in ("term", "doc", "impact"))
        here, start = np.unique(term, return_index=True)
        for t, a, b in zip(here.tolist(), start.tolist(), [*start[1:].tolist(), len(term)]):
            lo, hi = first[t], first[t + 1]
            lo, hi = lo + np.searchsorted(item[lo:hi], base), lo + np.searchsorted(item[lo:hi], base + BUNDLE)
            if hi > lo:
                acc[(item[lo:hi] - base)[:, None], doc[a:b]] += weight[lo:hi, None] * impact[a:b]
        i, d = np.nonzero((acc > 0) & (acc + later[:, None] >= floor[:, None]))
        best = -np.partition(-acc, min(k, DOCS) - 1, axis=1)[:, :k]
        ti, at = np.nonzero((best > 0) & (best >= floor[:, None] - later[:, None]))
        one = lambda x, kind: pa.array([x], pa.list_(kind))
        return pa.table(
            {
                "bundle": pa.array([bundle], pa.int32()),
                "bucket": pa.array([bucket], pa.int64()),
                "item": one(i, pa.int32()),
                "doc": one(d, pa.int32()),
                "score": one(acc[i, d], pa.int64()),
                "top_item": one(ti + base, pa.int32()),
                "top": one(best[ti, at], pa.int64()),
            }
        )

    return run


def _floors(bundles: DataFrame, items: int, k: int) -> np.ndarray:
    """Of each item the k-th best sum so far, over all buckets; 1 while there are fewer."""
    rows = bundles.select(F.explode(F.arrays_zip("top_item", "top")).alias("x")).select("x.top_item", "x.top")
    best = Window.partitionBy("top_item").orderBy(F.desc("top"))
    kth = rows.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).groupBy("top_item").agg(F.min("top").alias("v"), F.count("*").alias("n"))
    got = kth.where(F.col("n") == k).select("top_item", "v").toArrow()
    out = np.ones(items, np.int64)
    out[got["top_item"].to_numpy()] = got["v"].to_numpy()
    return out


def _chosen(bundles: DataFrame, ids: pa.Array, kind: str, floor: np.ndarray, k: int) -> DataFrame:
    """(item id, number, bucket, doc, score): each bundle's first k of every item at the floor or above, ties to the smaller key."""
    shared = bundles.sparkSession.sparkContext.broadcast((ids, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, floor = shared.value
        for batch in batches:
            for r in range(len(batch)):
                item, doc, score = (batch[c][r].values.to_numpy() for c in ("item", "doc", "score"))
                item = item + batch["bundle"][r].as_py() * BUNDLE
                at = np.flatnonzero(score >= floor[item])
                at = at[np.lexsort((doc[at], -score[at], item[at]))]
                begin = np.flatnonzero(np.diff(item[at], prepend=-1))
                at = at[np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at)))) < k] if len(at) else at
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(item[at])), pa.array(item[at], pa.int32()), pa.array(np.full(len(at), batch["bucket"][r].as_py()), pa.int64()), pa.array(doc[at], pa.int32()), pa.array(score[at], pa.int64())],
                    names=["item_id", "item", "bucket", "doc", "score"],
                )

    return bundles.select("bundle", "bucket", "item", "doc", "score").mapInArrow(run, f"item_id {kind}, item int, bucket long, doc int, score long")


def _searched(docs: DataFrame, terms: DataFrame, key: str, k: int) -> DataFrame:
    """One pass: (item_id, rank, id, score) for the items whose (id, h, q) rows are given."""
    spark = docs.sparkSession
    got = terms.select("id", "h", "q").toArrow()  # about PAIRS rows
    met = pa.concat_arrays(got["id"].chunks or [pa.nulls(0)]).dictionary_encode(null_encoding="encode")
    no, ids = met.indices.to_numpy().astype(np.int64), met.dictionary
    h, q, items = got["h"].to_numpy().view(H.U64), got["q"].to_numpy(), len(ids)
    vocab, term = np.unique(h, return_inverse=True)
    posted = stage(postings(docs, key, vocab if len(vocab) else np.zeros(1, H.U64)), "postings")
    total = posted.select(F.size(F.filter("n", lambda x: x > 0)).alias("d"), F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x).alias("l")).agg(F.sum("d").alias("d"), F.sum("l").alias("l")).first()
    documents, words = int(total["d"] or 0), int(total["l"] or 0)
    size = max(len(vocab), 1)
    df = _told(posted, size, None, np.add)
    w = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    # owners: heaviest terms first
    order = np.argsort(df, kind="stable")
    share = np.cumsum(df[order]) / max(df.sum(), 1)
    owner = np.empty(size, np.int8)
    owner[order] = np.minimum(np.searchsorted(OWNERS, share - 1e-12), len(OWNERS) - 1)
    owned = stage(impacts(posted, owner, len(OWNERS), documents, words), "owners")
    most = _told(owned, size, "impact", np.maximum)
    weight = w[term] * q if len(term) else np.zeros(0, np.int64)
    gain = np.zeros((len(OWNERS) + 1, items), np.int64)
    if len(term):
        np.add.at(gain, (owner[term], no), weight * most[term])
    later = gain[::-1].cumsum(axis=0)[::-1]  # what this owner and all after it can add
    by = np.lexsort((no, term))
    first = np.searchsorted(term[by], np.arange(size + 1))
    floor = np.ones(items, np.int64)
    numbers = F.sequence(F.lit(0), F.lit(max(0, items - 1) // BUNDLE))
    bundles = posted.select(F.explode(numbers).alias("bundle"), "bucket", *[F.array().cast(t).alias(c) for c, t in (("item", "array<int>"), ("doc", "array<int>"), ("score", "array<long>"))])
    for s in range(len(OWNERS)):
        shared = spark.sparkContext.broadcast((first, no[by], weight[by], floor, later[s + 1]))
        own = owned.where(F.col("owner") == s).select(F.explode(numbers).alias("bundle"), "bucket", "term", "doc", "impact")
        met = bundles.select("bundle", "bucket", "item", "doc", "score").groupBy("bundle", "bucket").cogroup(own.groupBy("bundle", "bucket"))
        bundles = stage(met.applyInArrow(_stage(shared, k), _BUNDLES), "bundles")
        floor = _floors(bundles, items, k)
    chosen = _chosen(bundles, ids, dict(terms.dtypes)["id"], floor, k)
    named = chosen.join(posted.select("bucket", "ids"), "bucket").select("item_id", "item", F.element_at("ids", F.col("doc") + 1).alias("id"), "score")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return named.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """(item, rank from 1, key, score) of each item's k best documents with a score above 0; ties by ascending key.

    Every row of ``docs`` is a document of its own, also where keys repeat; a null key comes before all others. Null and empty texts have no terms. Rows of
    one item id are one item (repeated rows count once), null being an id like others; items or documents without terms give no rows. Other columns
    of either table are ignored.
    """
    terms = stage(item_terms(items, item), "items")
    passes = max(1, -(-terms.count() // PAIRS))
    out = None
    for p in range(passes):
        part = terms.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p) if passes > 1 else terms
        found = _searched(docs, part, key, k)
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("item_id").alias(item), "rank", F.col("id").alias(key), "score")
