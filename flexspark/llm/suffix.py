"""Repeated byte strings across texts, through a prefix-free parse.

Rolling hashes of TRIGGER bytes choose the phrase bounds: in each string of ``length`` bytes the last position with the smallest hash is its
trigger, so equal strings have equal triggers, at the same place in them, whatever stands around. The strings of
``length`` bytes that share one trigger start in one run of positions; that run, to the end of its last string, is a
phrase. Phrases overlap so that every string lies in exactly one phrase: the parse is free of prefixes and loses nothing.

Every string lies in one phrase, so the parse's suffixes differ, as far as ``length`` bytes reach, in their first phrase: order among the
parse's suffixes is order among phrases, and order in the corpus is order among the dictionary's suffixes. Steps:

1. parse: (trigger, phrase) counts. A trigger seen once cannot stand in a repeated string; its phrase is done.
2. a phrase that occurs again is repeated with all the strings in it.
3. dictionary: where a trigger has several different phrases, one copy of each enters a sparse suffix array: one suffix for each block of ``size``
   strings at the same distances from the trigger, from the start of their common bytes. Range-partitioned sorting puts these suffixes into the order of
   their bytes; neighbours are compared. A block whose neighbour agrees in all its bytes is repeated; one whose common bytes no neighbour has holds no repeat.
4. where blocks agree in their common bytes only, their strings, named by a digest of their common bytes and the few bytes around, are sorted the same
   way; strings equal to a neighbour are repeated.

Equal suffixes may lie in several partitions, as many as sorting deals them to, so none grows with a frequent passage: only a partition's first and
last rows don't know a neighbour. Blocks there go to step 4, and strings there are compared among themselves.

So highly repetitive text costs a row for each phrase, about 2 / (length - TRIGGER + 2) of its bytes, and single strings are only
looked at around the ends of repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flexspark.llm import hashing as H
from flexspark.sources.scratch import stage

TRIGGER = 64
CHUNK = 1 << 19  # bytes looked at together: a few dozen numbers of eight bytes stand for each


class Parser:
    """Phrases of one chunk of texts for strings of ``length`` bytes."""

    def __init__(self, length: int, trigger: int):
        self.length, self.trigger = length, min(trigger, max(1, length // 2))
        self.roll = H.Rolling(int(H.stream(1, 301)[0]), H.stream(256, 302))
        self.salt = H.stream(2, 303)

    def phrases(self, c: H.Chunk):
        """(document, first string's start in it, strings, trigger's distance from that start, trigger hash, phrase hash) of every phrase."""
        n, g = len(c.data), self.trigger
        none = (*[np.zeros(0, np.int64)] * 4, *[np.zeros(0, H.U64)] * 2)
        if n < self.length:
            return none
        sums = self.roll.sums(c.data)
        grams = np.arange(n - g + 1)
        gram = H.mix(self.roll.between(sums, grams, grams + g))
        # smallest hash of each window of grams, the last of equal ones
        wide = self.length - g + 1
        rank = (gram & H.U64(0xFFFFFFFF00000000)) | (H.U64(0xFFFFFFFF) - grams.astype(H.U64))
        pad = -len(rank) % wide
        block = np.concatenate([rank, np.full(pad, np.iinfo(np.uint64).max, H.U64)]).reshape(-1, wide)
        after = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
        before = np.minimum.accumulate(block, axis=1).ravel()
        strings = n - self.length + 1
        at = (H.U64(0xFFFFFFFF) - (np.minimum(after[:strings], before[wide - 1 : wide - 1 + strings]) & H.U64(0xFFFFFFFF))).astype(np.int64)
        # strings that lie in one document
        room = np.maximum(np.diff(c.offsets) - self.length + 1, 0)
        doc = np.repeat(np.arange(c.count), room)
        start = c.offsets[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(room) - room, room)
        if not len(start):
            return none
        trig = at[start]
        new = np.ones(len(start), bool)
        new[1:] = (trig[1:] != trig[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(start)))
        lo, of = start[first], doc[first]
        end = lo + count - 1 + self.length
        phrase = H.mix(self.roll.between(sums, lo, end) + self.salt[0] * count.astype(H.U64))
        return of, lo - c.offsets[of], count, trig[first] - lo, gram[trig[first]], phrase


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == H.U64 else x, pa.int64())


def parse(docs: DataFrame, length: int, trigger: int = TRIGGER) -> DataFrame:
    """(key, lo, n, d, trig, phrase) of docs (key, text): n strings from byte lo on share the trigger, which stands at lo + d."""

    return docs.mapInArrow(_phrases(length, trigger), "key binary, lo int, n int, d int, trig long, phrase long")


def _phrases(length: int, trigger: int):
    """Function from keyed texts to their phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(length, trigger)
        for batch in batches:
            at = 0
            for c in H.chunks(batch["text"], CHUNK):
                doc, lo, n, d, trig, phrase = parser.phrases(c)
                small = [pa.array(x, pa.int32()) for x in (lo, n, d)]
                yield pa.RecordBatch.from_arrays([batch["key"].take(pa.array(doc + at)), *small, _longs(trig), _longs(phrase)], names=["key", "lo", "n", "d", "trig", "phrase"])
                at += c.count

    return run


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the ranges [lo, hi)."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    first = np.flatnonzero(new)
    return lo[first], hi[np.append(first[1:] - 1, len(hi) - 1)]


def packed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, packed): texts compressed before they are shuffled."""
    return docs.select("key", "doc_id", F.col("text").cast("binary").alias("data")).mapInArrow(_packed, "key binary, doc_id long, packed binary")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = (pack(t.as_buffer()) if t.is_valid else None for t in batch["data"])
        yield pa.RecordBatch.from_arrays([batch["key"], batch["doc_id"], pa.array(texts, pa.binary(), size=len(batch))], names=["key", "doc_id", "packed"])


def _unpacked(column: pa.Array) -> Iterator[bytes]:
    """The texts one by one; a batch of them is never held unpacked."""
    unpack = zstandard.ZstdDecompressor().decompress
    return (unpack(z.as_buffer()) for z in column)


def repeats(docs: DataFrame, length: int = 200, trigger: int = TRIGGER) -> tuple[DataFrame, DataFrame]:
    """Keyed documents (key, doc_id, text), and the repeated ranges of each key: (k, ranges array of (lo, hi)).

    The key is the MD5 of doc_id and text: rows equal in both have the same ranges. Every such row counts as an occurrence.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text)))
    keyed = docs.select(key.alias("key"), "doc_id", text.alias("text"))
    long = keyed.where(F.octet_length("text") >= length)
    parsed = parse(long.select("key", "text"), length, trigger)
    # grouped by a struct, so that the join below has its own two shuffles and a hot trigger's partition can be split
    seen = parsed.groupBy(F.struct(F.col("trig").alias("t")).alias("x")).agg(F.count("*").alias("c"), F.min("phrase").alias("p"), F.max("phrase").alias("q"))
    again = seen.where("c > 1").select("x.t", (F.col("p") != F.col("q")).alias("mixed"))
    hit = stage(parsed.join(again, F.col("trig") == F.col("t")).drop("t"), "phrases")
    pure, mixed = hit.where("not mixed"), hit.where("mixed")
    kinds = stage(mixed.groupBy("trig", "phrase").agg(F.count("*").alias("c"), F.min(F.struct("key", "lo", "n", "d")).alias("one")), "dictionary")
    status = kinds.join(_dictionary(long, kinds, length).withColumnsRenamed({"trig": "t", "phrase": "p"}), (F.col("trig") == F.col("t")) & (F.col("phrase") == F.col("p")), "left")
    status = stage(status.select("trig", "phrase", (F.col("c") > 1).alias("whole"), "runs").where("whole or runs is not null").withColumnsRenamed({"trig": "t", "phrase": "p"}), "status")
    tagged = mixed.join(status, (F.col("trig") == F.col("t")) & (F.col("phrase") == F.col("p")))
    full = F.array(F.struct(F.lit(0).alias("a"), (F.col("n") - 1).alias("b")))
    spans = pure.select("key", "lo", full.alias("runs")).unionByName(tagged.select("key", "lo", F.when(F.col("whole"), full).otherwise(F.col("runs")).alias("runs")))
    spans = spans.select("key", F.explode("runs").alias("r"), "lo").select("key", (F.col("lo") + F.col("r.a")).alias("lo"), (F.col("lo") + F.col("r.b") + length).alias("hi"))
    ranges = spans.groupBy(F.col("key").alias("k")).agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    return keyed, stage(ranges, "ranges")


def _dictionary(long: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """(trig, phrase, runs): which strings of a phrase, by offsets (a, b), other phrases of its trigger hold too."""
    one = kinds.select(F.col("one.key").alias("k"), F.struct("one.lo", "one.n", "one.d", "trig", "phrase").alias("x"))
    wanted = stage(one.groupBy("k").agg(F.collect_list("x").alias("x")), "wanted")
    held = packed(long).join(wanted, F.col("key") == F.col("k")).dropDuplicates(["key"]).select("packed", "x")
    texts = stage(held.mapInArrow(_cut(length), "trig long, phrase long, n int, d int, data binary"), "phrase-texts")
    size = max(1, min(16, length // 4))
    blocks = texts.mapInArrow(_blocks(length, size), "trig long, phrase long, a int, b int, inner binary, right binary, left binary")
    blocks = blocks.repartitionByRange("inner", "right", "left", "trig", "phrase").sortWithinPartitions("inner", "right", "left")
    found = stage(blocks.mapInArrow(_matched, "trig long, phrase long, a int, b int, whole boolean, name binary, around binary, before int"), "blocks")
    strings = found.where("name is not null").mapInArrow(_strings(size), "trig long, phrase long, a int, s binary")
    strings = strings.repartitionByRange("s", "trig", "phrase").sortWithinPartitions("s")
    ranked = stage(strings.mapInArrow(_repeated, "trig long, phrase long, a int, twice boolean, edge binary"), "strings")
    at = F.struct("trig", "phrase", "a", "twice")
    edges = ranked.where("edge is not null").groupBy("edge").agg(F.collect_list(at).alias("x")).where("size(x) > 1")  # two rows of a partition at most
    edges = edges.select(F.explode("x").alias("x")).where("not x.twice").select("x.*")
    single = ranked.where("twice").drop("edge").unionByName(edges).select("trig", "phrase", "a", F.col("a").alias("b"))
    runs = found.where("whole").select("trig", "phrase", "a", "b").unionByName(single)
    return runs.groupBy("trig", "phrase").agg(F.collect_set(F.struct("a", "b")).alias("runs"))  # length at most


def _cut(length: int):
    """Function from texts and their wanted phrases to the phrases' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, x in zip(_unpacked(batch["packed"]), batch["x"]):
                x = x.values
                lo, n = (x.field(f).to_pylist() for f in ("lo", "n"))
                data = pa.array([text[i : i + k - 1 + length] for i, k in zip(lo, n)], pa.binary())
                yield pa.RecordBatch.from_arrays([x.field("trig"), x.field("phrase"), x.field("n"), x.field("d"), data], names=["trig", "phrase", "n", "d", "data"])

    return run


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix of bytes."""
    n, k = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(k)), pa.py_buffer(np.ascontiguousarray(rows))])


def _slices(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of data in the ranges [start, end)."""
    n = end - start
    at = np.concatenate([[0], np.cumsum(n)])
    pick = np.arange(at[-1]) + np.repeat(start - at[:-1], n)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data[pick])])


def _blocks(length: int, size: int):
    """Function from phrases to their blocks, strings whose distance from the trigger has the same quotient by ``size``: the strings' offsets a to b,
    the bytes that a whole block of strings has in common, and those right and left of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for c in H.chunks(batch["data"], CHUNK):
                part = batch.slice(at, c.count)
                at += c.count
                n, d = (part[f].to_numpy().astype(np.int64) for f in ("n", "d"))
                low, high = (d - n + 1) // size, d // size
                of = np.repeat(np.arange(c.count), high - low + 1)
                block = np.arange(len(of)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[of]
                a = d[of] - np.minimum(d[of], block * size + size - 1)
                b = d[of] - np.maximum(d[of] - n[of] + 1, block * size)
                base = c.offsets[of]
                common = base + d[of] - block * size
                after = common - size + 1 + length
                inner = np.lib.stride_tricks.sliding_window_view(c.data, length - size + 1)[common]
                pick = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [part["trig"].take(pick), part["phrase"].take(pick), pa.array(a, pa.int32()), pa.array(b, pa.int32()), _binary(inner), _slices(c.data, after, base + b + length), _slices(c.data, base + a, common)],
                    names=["trig", "phrase", "a", "b", "inner", "right", "left"],
                )

    return run


def _adjacent(batches: Iterator[pa.RecordBatch], *levels: list[str]) -> Iterator[tuple]:
    """(rows, for each level whether a row equals the one before and the one after in that level's columns and those of the levels above, whether it is
    the first or last) of a sorted partition, batch by batch; a batch's last row waits for the next batch."""
    held, before, first = None, [False] * len(levels), True
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
        equal, flags = np.ones(len(rows) - 1, bool), []
        for k, level in enumerate(levels):
            for name in level:
                equal = equal & pc.equal(rows[name].slice(1), rows[name].slice(0, len(rows) - 1)).to_numpy(zero_copy_only=False)
            back = np.concatenate([[before[k]], equal])
            flags.append((back[:-1].astype(bool), equal))
            before[k] = bool(back[-1])
        held, edge = rows.slice(len(rows) - 1), np.zeros(len(rows) - 1, bool)
        if len(edge):
            edge[0], first = first, False
            yield rows.slice(0, len(edge)), flags, edge
    if held is not None:
        yield held, [(np.array([x]), np.zeros(1, bool)) for x in before], np.ones(1, bool)


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted blocks those that may hold a repeat: whether all their strings are repeated, and, where strings are to be compared one by one, the digest of
    the common bytes, the bytes left and right of them, and the number of those on the left.

    Strings are compared of blocks that share their common bytes with others but not all bytes. Of blocks equal in all bytes the first and the last stand
    for the others there.
    """
    for rows, ((near, near_next), (same, same_next)), edge in _adjacent(batches, ["inner"], ["right", "left"]):
        whole, compare = same | same_next, (near & ~same) | (near_next & ~same_next) | edge
        keep = np.flatnonzero(whole | compare)
        rows, whole, compare = rows.take(pa.array(keep)), whole[keep], compare[keep]
        texts = [(hashlib.md5(x).digest(), y + z, len(y)) if c else None for c, x, y, z in zip(compare, *(rows[f].to_pylist() for f in ("inner", "left", "right")))]
        more = [pa.array([t and t[i] for t in texts], k) for i, k in enumerate((pa.binary(), pa.binary(), pa.int32()))]
        yield pa.RecordBatch.from_arrays([*(rows[f] for f in ("trig", "phrase", "a", "b")), pa.array(whole), *more], names=["trig", "phrase", "a", "b", "whole", "name", "around", "before"])


def _strings(size: int):
    """Function from blocks to their strings: the name of the common bytes, how many bytes stand left of them, and the bytes around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for c in H.chunks(batch["around"], CHUNK):
                part = batch.slice(at, c.count)
                at += c.count
                a, b, before = (part[f].to_numpy().astype(np.int64) for f in ("a", "b", "before"))
                n = b - a + 1
                of = np.repeat(np.arange(len(n)), n)
                i = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                name = np.frombuffer(b"".join(part["name"].to_pylist()), np.uint8).reshape(-1, 16)
                around = c.data[(c.offsets[of] + i)[:, None] + np.arange(size - 1)]
                s = np.concatenate([name[of], (before[of] - i).astype(np.uint8)[:, None], around], axis=1)
                pick = pa.array(of)
                yield pa.RecordBatch.from_arrays([part["trig"].take(pick), part["phrase"].take(pick), pa.array(a[of] + i, pa.int32()), _binary(s)], names=["trig", "phrase", "a", "s"])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted strings those that equal a neighbour, and the partition's first and last, whose neighbours may lie in other partitions."""
    for rows, ((back, forth),), edge in _adjacent(batches, ["s"]):
        twice = back | forth
        keep = np.flatnonzero(twice | edge)
        rows, twice, edge = rows.take(pa.array(keep)), twice[keep], edge[keep]
        yield pa.RecordBatch.from_arrays(
            [*(rows[f] for f in ("trig", "phrase", "a")), pa.array(twice), pc.if_else(pa.array(edge), rows["s"], pa.scalar(None, pa.binary()))],
            names=["trig", "phrase", "a", "twice", "edge"],
        )


def remove_repeats(docs: DataFrame, length: int = 200, trigger: int = TRIGGER, texts: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) for every row of docs (doc_id, text).

    Removed is every byte in a string of ``length`` bytes that starts anywhere else in the corpus too. ``spans``: the maximal removed byte
    ranges (start, end); ``kept``: the bytes left (a cut may fall inside a character), null with ``texts=False``. Null and empty
    texts are empty. Rows equal in doc_id and text repeat each other. An empty table gives no rows. Spark holds no text above 2 GB, so offsets are ints.
    """
    keyed, ranges = repeats(docs, length, trigger)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(_unpacked(batch["packed"]), batch["ranges"]):
                cuts, rest = [], text
                if ranges.is_valid and len(ranges.values):
                    lo, hi = merged(*(ranges.values.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("lo", "hi")))
                    cuts = list(zip(lo.tolist(), hi.tolist()))
                    rest = b"".join(text[i:j] for i, j in zip([0, *hi.tolist()], [*lo.tolist(), len(text)]))
                rows.append((len(text), len(text) - len(rest), len(cuts), hashlib.sha256(rest).hexdigest(), [{"start": i, "end": j} for i, j in cuts], rest if texts else None))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(span), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    joined = packed(keyed).join(ranges, F.col("key") == F.col("k"), "left")
    return joined.select("doc_id", "packed", "ranges").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>, kept binary")
