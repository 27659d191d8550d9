"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes.

Terms are words (between white space and ASCII punctuation, A-Z in lower case) and their beginnings of PREFIXES bytes, so that inflected forms meet.
The vocabulary holds every term of a bounded sample of labelled rows: at most MAX_TOXIC and MAX_CLEAN, those with the smallest key hashes.
A term weighs the more, the more its presence differs between the labels: evidence is the difference in standard errors, and 1 at least, so no term
is without weight. Term frequencies over documents are counted on all documents. A text's vector is (1 + ln tf) * ln(1 + N / df) * evidence, of
unit length. Terms that no example has meet none; they do not count in a text's length.

Examples with equal vectors are one entry with the sum of their votes. A vote weighs cosine * (labelled rows of the class / sampled ones), so
the sample's class ratio does not matter; the base rate counts as PRIOR votes. Entries at equal cosine are taken
together. A key is one example: of the rows that repeat it, the text with the smallest hash. A text without any term is at distance 0 from examples without any, and these vote; a text none of whose terms an example has gets the base rate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flexspark.llm import hashing as H
from flexspark.sources.scratch import stage

PREFIXES = (4, 5, 6, 7)
MAX_TOXIC, MAX_CLEAN = 2000, 4000
NEIGHBOURS, PRIOR, BLOCK = 16, 0.5, 32
DENSE = 16
CHUNK, DOCS, PAIRS, LOOK = 1 << 18, 128, 512, 16


class Terms:
    """Term hashes of a chunk, with their documents."""

    def __init__(self):
        self.words = H.WordHasher(H.spaces(punctuation=True))
        self.salt = H.stream(len(PREFIXES), 201)

    def __call__(self, c: H.Chunk) -> tuple[np.ndarray, np.ndarray]:
        w = self.words(c)
        data = self.words.lower[c.data]
        sums, between = self.words.rolling.sums(data), self.words.rolling.between
        h, doc = [w.hash], [w.doc]
        for p, salt in zip(PREFIXES, self.salt):
            long = np.flatnonzero(w.end - w.start > p)
            h.append(H.mix(between(sums, w.start[long], w.start[long] + p) ^ salt))
            doc.append(w.doc[long])
        return np.concatenate(h), np.concatenate(doc)


def sample(labels: DataFrame, key: str, label: str) -> tuple[DataFrame, dict[int, float], float]:
    """The sampled keys (bounded), each class's weight, and the share of label 1. Rows without key or label take no part; a key with both labels counts as 1."""
    rows = stage(labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).cast("int").alias("y")), "labels")
    total = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.col(key), F.lit(3))
    part = lambda y, most: rows.where(F.col("y") == y).orderBy(order, key).limit(most)
    taken = stage(part(1, MAX_TOXIC).unionByName(part(0, MAX_CLEAN)), "sample")
    weight = {1: max(1.0, total.get(1, 0) / MAX_TOXIC), 0: max(1.0, total.get(0, 0) / MAX_CLEAN)}
    n = sum(total.values())
    return taken, weight, (total.get(1, 0) / n if n else 0.0)


def vocabulary(examples: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the examples (text, y), sorted, and each term's evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            y, at = np.asarray(batch["y"].to_numpy(zero_copy_only=False)), 0
            for c in H.chunks(batch["text"], CHUNK):
                h, doc = terms(c)
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h, label = h[new], y[at : at + c.count][doc[new]]
                at += c.count
                u, first = np.unique(h, return_index=True)
                n = np.diff(np.append(first, len(h)))
                toxic = np.add.reduceat(label, first) if len(first) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(toxic.astype(np.int64)), pa.array((n - toxic).astype(np.int64))], names=["h", "a", "b"])

    n = {r["y"]: r["n"] for r in examples.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = float(n.get(1, 0)), float(n.get(0, 0))
    if not n1 or not n0:
        return np.zeros(0, H.U64), np.zeros(0)
    counts = examples.select("text", "y").mapInArrow(run, "h long, a long, b long").groupBy("h").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    p = (F.col("a") + F.col("b")) / F.lit(n1 + n0)
    z = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    told = counts.select("h", F.greatest(F.abs(z), F.lit(1.0)).alias("z")).toArrow()  # of a bounded sample
    h = told["h"].to_numpy().view(H.U64)
    order = np.argsort(h)
    out = h[order], told["z"].to_numpy()[order]
    del told, h
    pa.default_memory_pool().release_unused()
    return out


class Lookup:
    """Sorted hashes with the place where each value of their leading bits begins: a place is found by one look, not by halving."""

    def __init__(self, vocab: np.ndarray):
        self.vocab = np.append(vocab, H.U64(0))
        bits = max(1, len(vocab).bit_length() + 2)
        self.shift = H.U64(64 - bits)
        self.first = np.zeros((1 << bits) + 1, np.int32)
        for low in range(0, len(self.first), 1 << 16):  # in pieces, so that they alone are held twice
            part = self.first[low : low + (1 << 16)]
            # the first hash of each value; past the last one, the end
            part[:] = np.searchsorted(vocab, np.minimum(np.arange(low, low + len(part)), (1 << bits) - 1).astype(H.U64) << self.shift)
        self.first[-1] = len(vocab)

    def __len__(self) -> int:
        return len(self.vocab) - 1

    def __call__(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of h are in the vocabulary, by number in h, and the number there."""
        part = (h >> self.shift).astype(np.int64)
        at, end = self.first[part], self.first[part + 1]
        left = np.flatnonzero(at < end)
        at, end, place = at[left].astype(np.int64), end[left], np.full(len(h), -1, np.int64)
        while len(left):
            same = self.vocab[at] == h[left]
            place[left[same]] = at[same]
            more = np.flatnonzero(~same & (at + 1 < end))
            left, at, end = left[more], at[more] + 1, end[more]
        known = np.flatnonzero(place >= 0)
        return known, place[known]


def found(terms: Terms, c: H.Chunk, vocab: np.ndarray | Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term number, count) of the vocabulary's terms, ordered by document. A text with other terms only has the number after the last, once."""
    if not len(vocab):
        return (np.zeros(0, np.int64),) * 3
    h, doc = terms(c)
    known, at = (vocab if isinstance(vocab, Lookup) else Lookup(vocab))(h)
    other = np.flatnonzero((np.bincount(doc, minlength=c.count) > 0) & (np.bincount(doc[known], minlength=c.count) == 0))
    size = len(vocab) + 1
    u, n = np.unique(np.concatenate([doc[known] * size + at, other * size + len(vocab)]), return_counts=True)
    return u // size, u % size, n


def vectors(df: DataFrame, vocab: np.ndarray, keep: list[str]) -> DataFrame:
    """The kept columns, and ``__terms``, ``__counts`` (arrays) of the vocabulary's terms in ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(vocab)
    fields = ", ".join(f"`{n}` {t}" for n, t in df.select(*keep).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, vocab = Terms(), Lookup(shared.value)
        kind = pa.list_(pa.int32())
        for batch in batches:
            ids, counts = [], []
            for c in H.chunks(batch["__text"], CHUNK):
                doc, term, n = found(terms, c, vocab)
                at = pa.array(np.searchsorted(doc, np.arange(c.count + 1)), pa.int32())
                ids.append(pa.ListArray.from_arrays(at, pa.array(term, pa.int32())))
                counts.append(pa.ListArray.from_arrays(at, pa.array(n, pa.int32())))
            whole = lambda parts: pa.concat_arrays(parts) if parts else pa.array([], kind)
            yield pa.RecordBatch.from_arrays([*[batch[k] for k in keep], whole(ids), whole(counts)], names=[*keep, "__terms", "__counts"])

    return df.select(*keep, F.col("text").alias("__text")).mapInArrow(run, f"{fields}, __terms array<int>, __counts array<int>")


class Index(NamedTuple):
    """Bounded by the sample: unit vectors of distinct examples (entries). Frequent terms (those of one entry in DENSE, or more) have a column each and
    stand entry by entry; the others are postings, term by term. Each weight stands in one place only."""

    idf: np.ndarray  # times evidence
    column: np.ndarray  # of each term; -1: none
    first: np.ndarray  # of each term, in entry and value
    entry: np.ndarray
    value: np.ndarray
    begin: np.ndarray  # of each entry, in held and exact
    held: np.ndarray  # columns
    exact: np.ndarray  # and weights there
    votes1: np.ndarray
    votes0: np.ndarray
    rows: np.ndarray
    ids: list
    none: tuple[float, float, list]
    base: float


def build(ids: list, y: np.ndarray, first: np.ndarray, term: np.ndarray, count: np.ndarray, df: np.ndarray, total: int, weight: dict[int, float], base: float, evidence: np.ndarray | float = 1.0) -> Index:
    """Index of examples (id, label) whose terms and counts stand between ``first`` and the next one. Ids differ."""
    idf = np.log1p(total / np.maximum(df, 1.0)) * evidence
    entries: dict[bytes, list] = {}  # by digest: where its terms stand, votes of label 1 and 0, rows, first ids
    for i in sorted(range(len(ids)), key=lambda i: ids[i]):
        a, b = int(first[i]), int(first[i + 1])
        digest = hashlib.sha256(np.concatenate([term[a:b], count[a:b]]).astype(np.int32).tobytes()).digest() if a < b else b""
        slot = entries.setdefault(digest, [a, b, 0.0, 0.0, 0, []])
        slot[3 - y[i]] += weight[int(y[i])]
        slot[4] += 1
        slot[5] = [*slot[5], ids[i]][:NEIGHBOURS]
    none = entries.pop(b"", [0, 0, 0.0, 0.0, 0, []])

    def unit(a: int, b: int) -> np.ndarray:
        w = (1 + np.log(count[a:b])) * idf[term[a:b]]
        return w / np.linalg.norm(w)

    # entries with the same heaviest terms stand in one block, so a block's bounds are tight
    kept = sorted(entries.values(), key=lambda e: term[e[0] : e[1]][np.argsort(-unit(e[0], e[1]), kind="stable")[:4]].tolist())
    n = np.zeros(len(idf), np.int64)
    for a, b, *_ in kept:
        n[term[a:b]] += 1
    often = np.flatnonzero(n * DENSE >= max(len(kept), DENSE))
    column, cells = np.full(len(idf), -1, np.int32), int(n[often].sum())
    column[often], n[often] = np.arange(len(often)), 0
    small = lambda size, most: np.zeros(size, np.uint16 if most < 1 << 16 else np.int32)
    places = np.concatenate([[0], np.cumsum(n)])
    at, entry, value = places[:-1].copy(), small(places[-1], len(kept)), np.zeros(places[-1])
    begin, held, exact = np.zeros(len(kept) + 1, np.int64), small(cells, len(often)), np.zeros(cells)
    for j, (a, b, *_) in enumerate(kept):
        w, c = unit(a, b), column[term[a:b]]
        rare = c < 0
        t = term[a:b][rare]
        entry[at[t]], value[at[t]] = j, w[rare]
        at[t] += 1
        begin[j + 1] = begin[j] + len(c) - len(t)
        held[begin[j] : begin[j + 1]], exact[begin[j] : begin[j + 1]] = c[~rare], w[~rare]
    col = lambda i: np.array([e[i] for e in kept], float)
    return Index(idf, column, places, entry, value, begin, held, exact, col(2), col(3), col(4), [e[5] for e in kept], (none[2], none[3], none[5]), base)


class Search:
    """An index with its frequent terms as columns of a matrix in single precision, with every block's largest weight. An entry's weights stand together,
    so the entries of a few blocks are read in runs. Products with the matrix tell which entries come into question; theirs are then made exactly."""

    def __init__(self, ix: Index):
        self.ix, size = ix, len(ix.rows)
        blocks = size // BLOCK + 1
        self.high = np.zeros((blocks * BLOCK, int(ix.column.max(initial=-1)) + 1), np.float32)
        for j in range(size):
            cells = slice(ix.begin[j], ix.begin[j + 1])
            self.high[j, ix.held[cells]] = ix.exact[cells]
        self.tops = self.high.reshape(blocks, BLOCK, self.high.shape[1]).max(axis=1)


def _floor(score: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of each document, the cosine at which NEIGHBOURS examples are reached; 0, while they are fewer."""
    k = min(NEIGHBOURS, score.shape[1])
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    s = np.take_along_axis(score, best, 1)
    order = np.argsort(-s, axis=1)
    s, n = np.take_along_axis(s, order, 1), np.cumsum(rows[np.take_along_axis(best, order, 1)], axis=1)
    enough = n >= NEIGHBOURS
    return np.where(enough.any(axis=1), s[np.arange(len(s)), np.argmax(enough, axis=1)], 0.0)


def vote(ix: Index | Search, doc: np.ndarray, term: np.ndarray, count: np.ndarray, docs: int) -> tuple[np.ndarray, list, list]:
    """Scores of ``docs`` documents given as (document, term, count) rows by document, and the nearest examples (keys, cosines) each rests on."""
    search = ix if isinstance(ix, Search) else Search(ix)
    ix, blocks = search.ix, len(search.tops)
    size = len(ix.rows)
    score = np.full(docs, ix.base)
    near: list = [[] for _ in range(docs)]
    cosine: list = [[] for _ in range(docs)]
    a, b, ids = ix.none
    bare = np.bincount(doc, minlength=docs) == 0
    score[bare] = (a + PRIOR * ix.base) / (a + b + PRIOR)
    for d in np.flatnonzero(bare):
        near[d], cosine[d] = ids, [1.0] * len(ids)
    if not len(doc) or not size:
        return score, near, cosine
    w = (1 + np.log(count)) * ix.idf[term]
    w = w / np.sqrt(np.bincount(doc, weights=w * w, minlength=docs))[doc]
    column = ix.column[term]
    often, rare = np.flatnonzero(column >= 0), np.flatnonzero(column < 0)
    x = np.zeros((docs, search.high.shape[1]), np.float32)
    x[doc[often], column[often]] = w[often]
    width = blocks * BLOCK
    some = np.zeros((docs, width))
    first = ix.first[term[rare]]
    n = ix.first[term[rare] + 1] - first
    rare, first, n = rare[n > 0], first[n > 0], n[n > 0]
    begin = np.searchsorted(doc[rare], np.arange(docs + 1))
    # one document at a time, so that its postings and sums stay in the processor's cache
    for i in range(docs):
        part = slice(begin[i], begin[i + 1])
        ends = np.cumsum(n[part])
        if len(ends):
            at = np.repeat(first[part] - ends + n[part], n[part])
            at += np.arange(ends[-1])
            weights = ix.value.take(at, mode="clip")
            weights *= np.repeat(w[rare[part]], n[part])
            some[i] = np.bincount(ix.entry.take(at, mode="clip"), weights=weights, minlength=width)
    bound = x @ search.tops.T + some.reshape(docs, blocks, BLOCK).max(axis=2)
    whole = np.zeros_like(some)
    rows = np.append(ix.rows, np.zeros(width - size))
    off = 2.0**-24 * (search.high.shape[1] + 64)  # products in single precision are off by less than this share
    up, down = 1 + off, 1 - off

    def look(which: np.ndarray) -> None:
        if which.all():
            np.add(some, x @ search.high.T, out=whole)
            return
        at = np.flatnonzero(which)
        for low in range(0, len(at), LOOK):  # a few blocks are copied out of the matrix at a time
            part = (at[low : low + LOOK, None] * BLOCK + np.arange(BLOCK)).ravel()
            whole[:, part] = some[:, part] + x @ search.high[part].T

    # the best block of each document gives a floor; then every block whose bound reaches it for some document
    first = np.zeros(blocks, bool)
    first[np.argmax(bound, axis=1)] = True
    first |= first.sum() * 4 > blocks  # most would be looked at anyway
    look(first)
    more = ((bound > 0) & (bound * up >= _floor(whole, rows)[:, None] * down - 1e-9)).any(axis=0) & ~first
    if more.any():
        look(more)
    # single precision leaves some candidates too many, none too few
    d, e = np.nonzero((whole > 0) & (whole * up >= _floor(whole, rows)[:, None] * down - 1e-9))
    s = some[d, e]
    ends, terms = np.searchsorted(d, np.arange(docs + 1)), np.searchsorted(doc[often], np.arange(docs + 1))
    own = np.zeros(search.high.shape[1])  # one document's weights, in double precision
    for i in np.flatnonzero(np.diff(ends)).tolist():
        of = often[terms[i] : terms[i + 1]]
        own[column[of]] = w[of]
        for low in range(ends[i], ends[i + 1], PAIRS):
            part = slice(low, min(low + PAIRS, ends[i + 1]))
            begin = ix.begin[e[part]]
            n = ix.begin[e[part] + 1] - begin
            at = np.arange(n.sum()) + np.repeat(begin - np.cumsum(n) + n, n)
            s[part] += np.bincount(np.repeat(np.arange(len(n)), n), weights=ix.exact[at] * own[ix.held[at]], minlength=len(n))
        own[column[of]] = 0
    order = np.lexsort((e, -s, d))
    d, e, s = d[order], e[order], s[order]
    n = np.cumsum(rows[e])
    n = n - np.concatenate([[0.0], n])[ends[:-1]][d]  # examples so far, within a document
    reached = np.flatnonzero(n >= NEIGHBOURS)
    who, at = np.unique(d[reached], return_index=True)
    floor = np.zeros(docs)
    floor[who] = s[reached[at]]
    keep = s >= np.maximum(floor[d] - 1e-9, 1e-12)
    d, e, s = d[keep], e[keep], s[keep]
    toxic, clean = (np.bincount(d, weights=s * v[e], minlength=docs) for v in (ix.votes1, ix.votes0))
    met = np.bincount(d, minlength=docs) > 0
    score[met] = (toxic[met] + PRIOR * ix.base) / (toxic[met] + clean[met] + PRIOR)
    for i, j, c in zip(d.tolist(), e.tolist(), s.tolist()):
        if len(near[i]) < NEIGHBOURS:
            near[i].extend(ix.ids[j])
            cosine[i].extend([c] * len(ix.ids[j]))
    return score, [n[:NEIGHBOURS] for n in near], [c[:NEIGHBOURS] for c in cosine]


def counts(docs: DataFrame, vocab: np.ndarray) -> tuple[np.ndarray, int]:
    """How many texts hold each term, or, as the term after the last, only others; and the number of texts. Only these sums leave a task."""
    shared, size = docs.sparkSession.sparkContext.broadcast(vocab), len(vocab) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, n, vocab = Terms(), np.zeros(size + 1, np.int64), Lookup(shared.value)
        for batch in batches:
            for c in H.chunks(batch["text"], CHUNK):
                n[:size] += np.bincount(found(terms, c, vocab)[1], minlength=size)
            n[size] += len(batch)
        t = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(n[t])], names=["t", "n"])

    seen = docs.select("text").mapInArrow(run, "t int, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()  # a row for each term of the vocabulary
    out = np.zeros(size + 1, np.int64)
    out[seen["t"].to_numpy()] = seen["n"].to_numpy()
    return out[:size].astype(float), int(out[size])


class Model(NamedTuple):
    vocab: np.ndarray
    index: Index

    def plain(self) -> tuple:
        """As arrays and lists alone, which tasks read without this package."""
        return self.vocab, tuple(self.index)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id") -> Model:
    """Model from the labels given. An example is a sampled key with the text of one of its rows, that of the smallest hash, however many rows repeat it.

    Without labels of both kinds the vocabulary is empty, and every score is the base rate (0 without labels). Nulls and empty texts hold no terms.
    """
    taken, weight, base = sample(labels, key, label)
    picked = docs.select(F.col(f"`{key}`").alias("id"), "text").join(F.broadcast(taken.select(F.col(f"`{key}`").alias("k"), "y")), F.col("id") == F.col("k"))
    examples = stage(picked.groupBy("id").agg(F.max("y").alias("y"), F.min_by("text", F.xxhash64("text")).alias("text")), "examples")  # MAX_TOXIC + MAX_CLEAN rows at most
    vocab, evidence = vocabulary(examples)
    df, total = counts(docs, vocab)
    rows = vectors(examples, vocab, ["id", "y"]).toArrow()
    flat = lambda c: np.concatenate([np.zeros(0, np.int32), *[x.flatten().to_numpy() for x in rows[c].chunks]])
    first = np.cumsum([0, *pc.list_value_length(rows["__terms"]).to_pylist()])
    index = build(rows["id"].to_pylist(), np.array(rows["y"].to_pylist(), int), first, flat("__terms"), flat("__counts"), df, total, weight, base, np.append(evidence, 1.0))
    del rows
    pa.default_memory_pool().release_unused()
    return Model(vocab, index)


def _voted(terms: Terms, ix: Search, vocab: Lookup, column: pa.Array) -> Iterator[tuple[np.ndarray, list, list]]:
    """Votes on a column of texts, in runs of at most DOCS."""
    for c in H.chunks(column, CHUNK):
        doc, term, n = found(terms, c, vocab)
        for low in range(0, c.count, DOCS):
            i, j = np.searchsorted(doc, (low, low + DOCS))
            yield vote(ix, doc[i:j] - low, term[i:j], n[i:j].astype(float), min(DOCS, c.count - low))


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, score, near, cosine): each row's score and the examples that back it; one pass, no shuffle. Rows that repeat are scored each."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())
    rows = docs.select(F.col(f"`{key}`").alias("id"), "text")
    kind, ids = dict(rows.dtypes)["id"], pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, (vocab, index) = Terms(), shared.value
        ix, vocab = Search(Index(*index)), Lookup(vocab)
        for batch in batches:
            at = 0
            for scores, near, cosine in _voted(terms, ix, vocab, batch["text"]):
                yield pa.RecordBatch.from_arrays([batch["id"].slice(at, len(scores)), pa.array(scores), pa.array(near, pa.list_(ids)), pa.array(cosine, pa.list_(pa.float64()))], names=["id", "score", "near", "cosine"])
                at += len(scores)

    return rows.mapInArrow(run, f"id {kind}, score double, near array<bigint>, cosine array<double>").withColumnRenamed("id", key)


def reject(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows whose text scores below the threshold, unchanged; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, (vocab, index) = Terms(), shared.value
        ix, vocab = Search(Index(*index)), Lookup(vocab)
        for batch in batches:
            first = 0
            for scores, _, _ in _voted(terms, ix, vocab, batch.column(at)):
                yield batch.slice(first, len(scores)).filter(pa.array(scores < threshold))
                first += len(scores)

    return docs.mapInArrow(run, docs.schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows no label of which may be learned: crc32 of the key as text, modulo 4, is 2. A null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4 == 2
