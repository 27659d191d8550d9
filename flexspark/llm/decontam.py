"""Benchmark leaks: every passage of every text queries a BM25 index of the test items by block-max WAND; hits are verified on shingles.

Words stand between white space and ASCII punctuation, A-Z in lower case. Passages are PASSAGE words long and start every STEP words.
An item is retrieved if a passage's score reaches THRESHOLD of the least that STEP consecutive words of the item (the whole, if shorter) score
themselves; a passage that holds so many words of the item reaches it. Retrieval keeps all such items, with no limit on their number:

* a passage whose words' largest weights do not add up to the lowest threshold is passed over, as WAND does;
* so is every block of items whose own largest weights do not reach the block's lowest threshold (block-max);
* only the rest is scored.

An item's answer follows its last question mark, else it is the last sentence, else the last quarter of its words. Verified
is an item with at least 0.8 of its five-word shingles in the text, and half of those that touch the answer and of those that don't.
An item of fewer than five words is only found in a text that consists of just these words; one without words, never.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flexspark.llm import hashing as H
from flexspark.sources.scratch import stage

PASSAGE, STEP = 64, 32
THRESHOLD, OVERLAP, PART = 0.5, 0.8, 0.5
SHINGLE = 5
K1, B = 1.2, 0.75
BLOCK = 16
INDEX_BYTES = 16 << 20


class Index(NamedTuple):
    ids: list
    vocab: np.ndarray  # sorted term hashes
    high: np.ndarray  # largest weight of each term
    first: np.ndarray  # of each term, in item and weight
    item: np.ndarray
    weight: np.ndarray
    top_first: np.ndarray  # of each term, in block and top
    block: np.ndarray
    top: np.ndarray
    least: np.ndarray  # threshold of each item
    block_least: np.ndarray
    shingles: list  # of each item, by position
    answer: list  # of each item: which shingles touch the answer


def answer_start(text: str) -> int:
    """Where the answer begins: a position in the text, or -1 for the last quarter of the words."""
    if "?" in text.rstrip()[:-1]:
        return text.rstrip()[:-1].rindex("?") + 1
    ends = [m.end() for m in re.finditer(r"[.!?\n]+", text.strip()[:-1])]
    return ends[-1] + len(text) - len(text.lstrip()) if ends else -1


class Statistics(NamedTuple):
    """Of all items with words, whichever index holds them: their number, mean number of words, and the items with each term."""

    items: int
    mean: float
    terms: np.ndarray  # sorted hashes; at least those of the index to be built
    counts: np.ndarray


def build(items: list[tuple], of_all: Statistics | None = None) -> Index:
    """Index of (id, text) items, scored by the statistics given, or else by those of these items."""
    words = H.WordHasher(H.spaces(punctuation=True))
    rows = []
    for key, text in sorted(items, key=lambda r: (str(r[0]), r[1] or "")):
        for c in H.chunks(pa.array([text or ""], pa.string())):
            w = words(c)
            if not len(w.hash):
                continue
            h, _ = H.shingles(w, SHINGLE)
            cut = answer_start(text)
            start = int(np.searchsorted(w.start, len(text[:cut].encode()))) if cut >= 0 else len(w.hash) - max(1, len(w.hash) // 4)
            rows.append((key, w.hash, h, np.arange(len(h)) + SHINGLE > start))
    n = len(rows)
    terms, counts = np.unique(np.concatenate([np.unique(r[1]) for r in rows]), return_counts=True) if n else (np.zeros(0, H.U64), np.zeros(0))
    # items that share their most frequent term stand together: blocks then hold one language
    common = [int(terms[np.searchsorted(terms, u := np.unique(r[1]))][np.argmax(counts[np.searchsorted(terms, u)])]) for r in rows]
    rows = [rows[i] for i in sorted(range(n), key=lambda i: (common[i], len(rows[i][1])))]
    if of_all is None:
        of_all = Statistics(n, np.mean([len(r[1]) for r in rows]) if n else 1.0, terms, counts)
    mean, counts = of_all.mean, of_all.counts[np.searchsorted(of_all.terms, terms)]
    idf = np.log1p((of_all.items - counts + 0.5) / (counts + 0.5))
    t, e, v, least = [], [], [], []
    for i, (_, w, _, _) in enumerate(rows):
        u, tf = np.unique(w, return_counts=True)
        at = np.searchsorted(terms, u)
        x = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
        t.append(at)
        e.append(np.full(len(u), i))
        v.append(x)
        of = x[np.searchsorted(u, w)]
        spans = [w[s : s + STEP] for s in range(0, max(1, len(w) - STEP + 1))]
        least.append(THRESHOLD * min(of[s : s + STEP][np.unique(spans[s], return_index=True)[1]].sum() for s in range(len(spans))))
    t, e, v = (np.concatenate(x) if n else np.zeros(0, k) for x, k in ((t, np.int64), (e, np.int64), (v, float)))
    order = np.lexsort((e, t))
    t, e, v = t[order], e[order], v[order]
    blocks = n // BLOCK + 1
    u, at = np.unique(t * blocks + e // BLOCK, return_index=True)
    ends = np.arange(len(terms) + 1)
    first = np.searchsorted(t, ends)
    least = np.array(least)
    return Index(
        [r[0] for r in rows],
        terms,
        np.maximum.reduceat(v, first[:-1]) if len(terms) else np.zeros(0),
        first,
        e,
        v,
        np.searchsorted(u // blocks, ends),
        u % blocks,
        np.maximum.reduceat(v, at) if len(at) else np.zeros(0),
        least,
        np.array([least[i * BLOCK : (i + 1) * BLOCK].min(initial=np.inf) for i in range(blocks)]),
        [r[2] for r in rows],
        [r[3] for r in rows],
    )


def _expand(first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all postings of the terms, and which term of the list each belongs to."""
    n = first[terms + 1] - first[terms]
    owner = np.repeat(np.arange(len(terms)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[terms][owner], owner


def retrieve(ix: Index, w: H.Words) -> list[tuple[int, int, float]]:
    """(document, item, best passage's score) of all retrieved items of a chunk."""
    if not len(ix.ids) or not len(w.hash):
        return []
    at = np.minimum(np.searchsorted(ix.vocab, w.hash), len(ix.vocab) - 1)
    known = ix.vocab[at] == w.hash
    mass = np.concatenate([[0.0], np.cumsum(np.where(known, ix.high[at], 0.0))])
    # passages: every STEP words of a document, the last one ending with it
    n = np.maximum(1, -(-(w.per_doc - PASSAGE) // STEP) + 1) * (w.per_doc > 0)
    doc = np.repeat(np.arange(len(n)), n)
    begin = np.concatenate([[0], np.cumsum(w.per_doc)])
    start = begin[doc] + STEP * (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n))
    end = np.minimum(start + PASSAGE, begin[doc + 1])
    live = np.flatnonzero(mass[end] - mass[start] >= ix.least.min() - 1e-9)
    out: dict[tuple[int, int], float] = {}
    blocks = len(ix.block_least)
    for part in (live[i : i + 512] for i in range(0, len(live), 512)):
        # (passage, term) pairs, each once
        size = end[part] - start[part]
        passage = np.repeat(np.arange(len(part)), size)
        pos = start[part][passage] + np.arange(len(passage)) - np.repeat(np.cumsum(size) - size, size)
        pos, passage = pos[known[pos]], passage[known[pos]]
        pair = np.unique(passage * len(ix.vocab) + at[pos])
        passage, term = pair // len(ix.vocab), pair % len(ix.vocab)
        p, owner = _expand(ix.top_first, term)
        bound = np.bincount(passage[owner] * blocks + ix.block[p], weights=ix.top[p], minlength=len(part) * blocks).reshape(-1, blocks)
        open_ = bound >= ix.block_least - 1e-9
        some = open_.any(axis=1)[passage]
        passage, term = passage[some], term[some]
        if not len(term):
            continue
        p, owner = _expand(ix.first, term)
        of = passage[owner]
        keep = open_[of, ix.item[p] // BLOCK]
        cell, inverse = np.unique(of[keep] * len(ix.ids) + ix.item[p[keep]], return_inverse=True)
        score = np.bincount(inverse, weights=ix.weight[p[keep]], minlength=len(cell))
        who, item = cell // len(ix.ids), cell % len(ix.ids)
        for i in np.flatnonzero(score >= ix.least[item] - 1e-9):
            key = (int(doc[part[who[i]]]), int(item[i]))
            out[key] = max(out.get(key, 0.0), float(score[i]))
    return [(d, i, s) for (d, i), s in sorted(out.items())]


def verified(ix: Index, w: H.Words, hits: list[tuple[int, int, float]]) -> list[tuple[int, int, float, float, float]]:
    """(document, item, score, question overlap, answer overlap) of the hits that hold."""
    if not hits:
        return []
    h, doc = H.shingles(w, SHINGLE)
    out, last, have = [], -1, None
    for d, i, score in hits:
        if d != last:
            a, b = np.searchsorted(doc, (d, d + 1))
            have, last = np.unique(h[a:b]), d
        there = np.isin(ix.shingles[i], have)
        mark = ix.answer[i]
        ans = there[mark].mean() if mark.any() else there.mean()
        que = there[~mark].mean() if (~mark).any() else ans
        if there.mean() >= OVERLAP and ans >= PART and que >= PART:
            out.append((d, i, score, float(que), float(ans)))
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each item with words a row (part, term) for every term, and one without term that has the number of words."""
    words = H.WordHasher(H.spaces(punctuation=True))
    for batch in batches:
        part, first = batch["part"].to_numpy(), 0
        for c in H.chunks(batch["text"]):
            w = words(c)
            order = np.lexsort((w.hash, w.doc))
            h, doc = w.hash[order], w.doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            some = np.flatnonzero(w.per_doc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[first : first + c.count][np.concatenate([doc[new], some])]),
                    pa.concat_arrays([pa.array(h[new].view(np.int64)), pa.nulls(len(some), pa.int64())]),
                    pa.array(np.concatenate([np.zeros(new.sum(), np.int64), w.per_doc[some]])),
                ],
                names=["part", "h", "words"],
            )
            first += c.count


def indexes(items: DataFrame, key: str) -> Iterator[Index]:
    """Indexes of (key, text) items of about INDEX_BYTES of text each, one after the other; all score by the statistics of all items."""
    items = items.select(F.col(key).alias("k"), "text").where(F.col("text").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-size // INDEX_BYTES))
    items = stage(items.distinct().withColumn("part", F.pmod(F.xxhash64("k", "text"), F.lit(parts).cast("long"))), "items")
    counts = stage(items.select("part", "text").mapInArrow(_counted, "part long, h long, words long").groupBy("part", "h").agg(F.count("*").alias("n"), F.sum("words").alias("words")), "terms")
    total = counts.where(F.col("h").isNull()).agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    counts = counts.where(F.col("h").isNotNull())
    counts = stage(counts.select("part", "h").join(counts.groupBy("h").agg(F.sum("n").alias("n")), "h"), "counts")
    for i in range(parts):
        told = counts.where(F.col("part") == i).select("h", "n").toArrow()  # the terms of one part
        h = told["h"].to_numpy().view(H.U64)
        order = np.argsort(h)
        of_all = Statistics(total["n"] or 0, total["words"] / total["n"] if total["n"] else 1.0, h[order], told["n"].to_numpy()[order])
        yield build([(r["k"], r["text"]) for r in items.where(F.col("part") == i).collect()], of_all)


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """(key, item, score, question_overlap, answer_overlap) of every verified item in every text.

    Null or empty texts hold nothing. Rows that repeat are reported each. No items or no documents: no rows.
    """
    kinds = dict(docs.dtypes)[key], dict(items.dtypes)[item]
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    out = None
    for ix in indexes(items, item):
        shared = docs.sparkSession.sparkContext.broadcast(tuple(ix))  # plain arrays: tasks read them without this package

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words, ix = H.WordHasher(H.spaces(punctuation=True)), Index(*shared.value)
            for batch in batches:
                rows, at = [], 0
                for c in H.chunks(batch["__text"]):
                    w = words(c)
                    rows.extend((at + d, *r) for d, *r in verified(ix, w, retrieve(ix, w)))
                    at += c.count
                yield pa.RecordBatch.from_arrays(
                    [batch[key].take(pa.array([r[0] for r in rows], pa.int64())), pa.array([ix.ids[r[1]] for r in rows], types[kinds[1]]), *[pa.array([r[k] for r in rows], pa.float64()) for k in (2, 3, 4)]],
                    names=[key, item, "score", "question_overlap", "answer_overlap"],
                )

        part = docs.select(key, F.col("text").alias("__text")).mapInArrow(run, f"`{key}` {kinds[0]}, `{item}` {kinds[1]}, score double, question_overlap double, answer_overlap double")
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, items: DataFrame, item: str = "item_id") -> DataFrame:
    """The rows whose text holds no verified item, unchanged; no shuffle."""
    at = docs.columns.index("text")
    for ix in indexes(items, item):
        shared = docs.sparkSession.sparkContext.broadcast(tuple(ix))  # plain arrays: tasks read them without this package

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words, ix = H.WordHasher(H.spaces(punctuation=True)), Index(*shared.value)
            for batch in batches:
                keep, first = np.ones(len(batch), bool), 0
                for c in H.chunks(batch.column(at)):
                    w = words(c)
                    keep[[first + r[0] for r in verified(ix, w, retrieve(ix, w))]] = False
                    first += c.count
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
