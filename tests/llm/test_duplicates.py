"""Near duplicates and repeated byte strings against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flexspark.llm import graph, minhash, suffix

from .conftest import ODD, odd_rows

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets_of(rows, n):
    out = []
    for d, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER))
        out.append((d, frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    return out


def groups(rows, n, percent):
    """(doc_id, size, component, kept) of every row, by comparing all rows."""
    sets = sets_of(rows, n)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    post = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        met = Counter(j for g in s for j in post[g])
        for j, k in met.items():
            if 100 * k >= percent * len(s | sets[j][1]):
                root[max(find(i), find(j))] = min(find(i), find(j))
        for g in s:
            post[g].append(i)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted([(d, len(s), (least.get(find(i)) if s else d), not s or d == least.get(find(i))) for i, (d, s) in enumerate(sets)], key=str)


def near(df, n=4, percent=80):
    rows = minhash.near_duplicates(df, n, percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("n", [4, 5])
def test_near_documents(documents, n):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert near(documents, n) == groups(rows, n, 80)


def test_near_odd(odd, nothing):
    assert near(odd) == groups([r[:2] for r in odd_rows()], 4, 80)
    assert near(nothing) == []


def test_hubs_lose_no_link(spark, monkeypatch):
    """A large group of different near copies goes through hub rounds; all groups still agree with brute force."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for d in range(150):
        w = list(base)
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(60)] = f"v{rng.randrange(1000)}"
        rows.append((d, " ".join(w)))
    monkeypatch.setattr(minhash, "LINEAR", 0.5)
    assert near(spark.createDataFrame(rows, "doc_id long, text string")) == groups(rows, 4, 80)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def without_repeats(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        end = 0
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                a = max(i, end)
                end = i + length
                gone[a:end] = b"\1" * (end - a)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def stripped(df, length, trigger=64):
    rows = suffix.remove_repeats(df, length, trigger)
    return sorted(map(tuple, rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_repeats_documents(documents):
    rows = [tuple(r) for r in documents.where(F.length("text") < 6000).select("doc_id", "text").collect()]
    assert stripped(documents.where(F.length("text") < 6000), 200) == without_repeats(rows, 200)


@pytest.mark.parametrize("length,trigger", [(8, 4), (20, 64), (50, 10)])
def test_repeats_small_alphabet(spark, length, trigger):
    """Periodic and random texts over few letters, so that repeats overlap, touch and nest."""
    rng = random.Random(length)
    rows = [(d, "".join(rng.choice("ab" if d % 2 else "abcé") for _ in range(rng.randrange(0, 300)))) for d in range(30)]
    rows += [(90, "ab" * 200), (91, "a" * 333), (92, None), (93, ""), (94, rows[3][1]), (94, rows[3][1]), (None, "xyz" * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert stripped(df, length, trigger) == without_repeats(rows, length)


def test_repeats_across_partitions(spark):
    """Equal suffixes dealt over more partitions than there are texts: partitions of one row, and runs that go on in the next partition."""
    rng = random.Random(9)
    common = "".join(rng.choice("abcd") for _ in range(120))
    rows = [(d, "".join(rng.choice("abcd") for _ in range(40 + d % 3)) + common[d % 5 : 120 - d % 7] + chr(97 + d % 4) * (d % 11)) for d in range(60)]
    conf = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert stripped(spark.createDataFrame(rows, "doc_id long, text string"), 60, 16) == without_repeats(rows, 60)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_repeats_odd(spark, odd, nothing):
    short = [r for r in odd_rows() if len(r[1] or "") < 100_000]
    assert stripped(spark.createDataFrame(short, ODD), 30) == without_repeats([r[:2] for r in short], 30)
    assert suffix.remove_repeats(odd).count() == len(odd_rows())
    assert suffix.remove_repeats(nothing).count() == 0


def test_kept_and_spans(spark):
    text = "head " + "repeated part of some length " * 2 + "tail"
    df = spark.createDataFrame([(1, text), (2, "other " + "repeated part of some length " * 2)], "doc_id long, text string")
    for r in suffix.remove_repeats(df, 20).collect():
        whole = (text if r.doc_id == 1 else "other " + "repeated part of some length " * 2).encode()
        gone = set()
        for s in r.spans:
            gone |= set(range(s.start, s.end))
        assert bytes(r.kept) == bytes(b for i, b in enumerate(whole) if i not in gone)


def test_tasks_hold_little_at_once():
    """A task's arrays stand for half a megabyte of text, and texts are packed and unpacked one by one."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdefgh \n", k=4000)) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"key": [b"k"] * len(texts), "doc_id": list(range(len(texts))), "text": texts, "data": [t.encode() for t in texts]})
    peak = {}
    for name, run in (("phrases", suffix._phrases(200, 64)), ("packed", suffix._packed)):
        tracemalloc.start()
        out = list(run(iter([batch]))) if name == "packed" else sum(len(b) for b in run(iter([batch])))
        peak[name] = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
    assert peak["phrases"] < 90 and peak["packed"] < 10, peak
    assert list(suffix._unpacked(out[0]["packed"])) == [t.encode() for t in texts]


def test_signatures_hold_little_at_once():
    """Near duplicates: a task's arrays stand for a part of a batch, and the signatures are those of each text alone."""
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdefgh \n", k=4000)) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "digest": [b"d"] * len(texts), "text": texts})
    tracemalloc.start()
    whole = pa.Table.from_batches(list(minhash._described(5)(iter([batch]))))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < 40, peak
    alone = pa.Table.from_batches(list(minhash._described(5)(batch.slice(i, 1) for i in range(0, 2000, 100))))
    assert alone.equals(whole.take(list(range(0, 2000, 100))))
