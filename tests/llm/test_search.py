"""Ranked search against brute force in plain Python."""

import math
import re
from collections import Counter, defaultdict

import pytest

from flexspark.llm import lexical

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    big_n, big_l = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    queries = defaultdict(Counter)
    for i, t in dict.fromkeys(items):
        queries[i].update(terms(t))
    out = {}
    for i, q in queries.items():
        scored = []
        for d, b in bags:
            if b:
                m = 25 + 75 * sum(b.values()) * big_n // big_l
                s = sum(c * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t, c in q.items() if t in b)
                if s > 0:
                    scored.append((-s, d is not None, d or 0))
        if scored:
            out[i] = [(d if known else None, -s) for s, known, d in sorted(scored)[:k]]
    return out


def got(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (str(r.item_id), r.rank)):
        assert r.rank == len(out[r.item_id]) + 1
        out[r.item_id].append((r.doc_id, r.score))
    return dict(out)


ITEMS = "item_id long, text string, score int, bucket string"


@pytest.mark.parametrize("docs_in, bundle, pairs", [(2048, 256, 1 << 20), (16, 3, 1 << 20), (64, 2, 40)])
def test_equals_brute_force(spark, documents, monkeypatch, docs_in, bundle, pairs):
    """Whatever the buckets, bundles and passes: the same ranks and scores."""
    for name, v in (("DOCS", docs_in), ("BUNDLE", bundle), ("PAIRS", pairs)):
        monkeypatch.setattr(lexical, name, v)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(9)
    want = brute([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
    assert got(lexical.search(documents.repartition(5), items, 10)) == want


def test_odd_rows_ties_and_ids(spark, odd, nothing):
    """Null, empty, long and repeated texts; equal scores by id, null first; ids of several rows, rows that repeat; clashing columns."""
    rows = [(1, "One twenty W5X5", 0, "x"), (1, "end", 0, "x"), (2, "two three two", 0, None), (2, "two three two", 0, None), (3, None, 1, "y"), (4, " .,", 1, "y"), (None, "a É é b", 2, "z"), (5, "nowhere", 0, "")]
    items = spark.createDataFrame(rows, ITEMS)
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(lexical.search(odd, items, 3)) == brute(docs, [r[:2] for r in rows], 3)
    assert lexical.search(odd, items.limit(0), 3).count() == 0
    assert lexical.search(nothing, items, 3).count() == 0
    assert lexical.search(odd, items, 3).columns == ["item_id", "rank", "doc_id", "score"]


def test_a_frequent_term_and_copies(spark):
    """A term in every text weighs less than others, and thousands of copies tie by id."""
    docs = spark.createDataFrame([(i, "all same words here" if i % 3 else f"all rare{i} words") for i in range(3000)], "doc_id long, text string").repartition(6)
    items = spark.createDataFrame([(0, "same all"), (1, "rare6 all"), (2, "all")], "item_id long, text string")
    found = got(lexical.search(docs, items, 10))
    assert [d for d, _ in found[0]] == [i for i in range(16) if i % 3][:10]
    assert found[1][0][0] == 6
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()], [(0, "same all"), (1, "rare6 all"), (2, "all")], 10)


def test_string_keys(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y")], "name string, text string")
    items = spark.createDataFrame([("q", "x x z")], "q string, text string")
    rows = lexical.search(docs, items, 5, key="name", item="q").collect()
    assert [(r.q, r.rank, r.name) for r in sorted(rows, key=lambda r: r.rank)] == [("q", 1, None), ("q", 2, "a"), ("q", 3, "b")]
