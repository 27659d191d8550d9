"""Document quality by hierarchical empirical Bayes: a classifier's evidence, and posteriors of hosts and their paths.

1. A logistic regression on style figures of the whole text (FIGURES) gives each document's probability. It is fitted on a bounded sample of
   labelled rows, at most SAMPLE, those with the smallest key hashes.
2. Sites: every document adds its label where it may be learned, else its probability, to its host and its path; counts and sums
   come from grouped aggregation over all documents. The spread of the rates around their parent, less what chance alone
   would give, says how many documents the parent's rate is worth (moments of a Beta prior), first hosts in the whole,
   then paths in their hosts. A site's posterior is (sum + worth * parent's posterior) / (n + worth): sparse sites go to the
   host's rate, sparse hosts to the global one.
3. A document's log odds are those of the classifier plus what its path's posterior differs from the global rate.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flexspark.llm import hashing as H
from flexspark.sources.scratch import stage

SAMPLE = 8000
FIGURES = ("words", "word length", "distinct words", "most frequent word", "repeated neighbours", "symbols", "digits", "capitals", "lines", "line ends", "punctuation", "bars")
WORTH = (1.0, 1e6)


def figures(words: H.WordHasher, c: H.Chunk) -> np.ndarray:
    """A row of FIGURES for each document of a chunk."""
    w = words(c)
    size = np.maximum(np.diff(c.offsets), 1)
    n = np.maximum(w.per_doc, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[c.offsets[1:]] - total[c.offsets[:-1]]) / size

    def of(values: list[int] | bytes) -> np.ndarray:
        table = np.zeros(256, bool)
        table[list(values)] = True
        return share(table[c.data])

    order = np.lexsort((w.hash, w.doc))
    h, d = w.hash[order], w.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(h)))
    distinct = np.bincount(d[first], minlength=c.count)
    most = np.zeros(c.count)
    np.maximum.at(most, d[first], count)
    again = np.zeros(len(w.hash), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    cols = [
        np.log1p(w.per_doc),
        np.bincount(w.doc, weights=w.end - w.start, minlength=c.count) / n,
        distinct / n,
        most / n,
        np.bincount(w.doc, weights=again, minlength=c.count) / n,
        of(b"#$%&*@^~<>{}[]=+_\\/"),
        of(b"0123456789"),
        of(bytes(range(65, 91))),
        of(b"\n"),
        of(b".\n"),
        of(b".,;:!?"),
        of(b"|"),
    ]
    return np.stack(cols, axis=1)


class Logistic(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return self.beta[0] + np.concatenate([z, z * z], axis=1) @ self.beta[1:]


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> Logistic:
    """Ridge logistic regression on the figures and their squares, by Newton steps. Without rows of both labels: the constant rate."""
    k = len(FIGURES)
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return Logistic(np.zeros(k), np.ones(k), np.append(np.log(rate / (1 - rate)), np.zeros(2 * k)))
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.clip((x - mean) / scale, -8, 8)
    a = np.concatenate([np.ones((len(y), 1)), z, z * z], axis=1)
    beta, ridge = np.zeros(a.shape[1]), np.full(a.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (y - p) - ridge * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, beta)


def described(df: DataFrame, keep: list[str], model: Logistic | None = None) -> DataFrame:
    """The kept columns, with ``__figures``, or the model's ``__odds``, of ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(None if model is None else tuple(model))  # plain arrays: tasks read them without this package
    fields = ", ".join(f"`{n}` {t}" for n, t in df.select(*keep).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, m = H.WordHasher(H.spaces()), None if shared.value is None else Logistic(*shared.value)
        for batch in batches:
            x = np.concatenate([np.zeros((0, len(FIGURES))), *[figures(words, c) for c in H.chunks(batch["__text"])]])
            value = pa.array(list(x), pa.list_(pa.float64())) if m is None else pa.array(m.log_odds(x))
            yield pa.RecordBatch.from_arrays([*[batch[k] for k in keep], value], names=[*keep, "__value"])

    kind = "array<double>" if model is None else "double"
    return df.select(*keep, F.col("text").alias("__text")).mapInArrow(run, f"{fields}, __value {kind}")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Logistic:
    """The classifier from at most SAMPLE labelled keys; of rows that repeat a key, the text with the smallest hash is its one example."""
    taken = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).cast("int").alias("y"))
    taken = stage(taken.orderBy(F.xxhash64(F.col(key), F.lit(5)), key).limit(SAMPLE).select(F.col(key).alias("k"), "y"), "sample")
    picked = docs.select(F.col(key).alias("id"), "text").join(F.broadcast(taken), F.col("id") == F.col("k"))
    one = picked.groupBy("id").agg(F.max("y").alias("y"), F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = sorted(described(one.select("id", "y", "text"), ["id", "y"]).collect(), key=lambda r: r["id"])  # SAMPLE rows at most
    return logistic(np.array([r["__value"] for r in rows]).reshape(-1, len(FIGURES)), np.array([r["y"] for r in rows], float))


def _worth(sites: DataFrame) -> float:
    """How many documents a parent's rate is worth, from (n, s, parent): moments of the rates around it."""
    m, n = F.col("parent"), F.col("n")
    sq = n * F.pow(F.col("s") / n - m, 2)
    row = sites.agg(F.sum(sq).alias("sq"), F.sum(m * (1 - m)).alias("chance"), F.sum(n * m * (1 - m)).alias("var"), F.count("*").alias("k")).first()
    if not row["k"] or row["k"] < 2 or not row["var"]:
        return 100.0
    # E[sum n (rate - m)^2] = sum m (1 - m) (1 + (n - 1) / (worth + 1))
    excess = (row["sq"] - row["chance"]) / max(row["var"] - row["chance"], 1e-9)
    return float(min(max(1 / excess - 1, WORTH[0]), WORTH[1])) if excess > 0 else WORTH[1]


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """(key, host, path, evidence, host_rate, path_rate, score): the document's own probability, its sites' posteriors (of all their other documents) and the combined score.

    ``labels`` are those that may be learned. Null hosts and paths are sites of their own. Null and empty texts have figures of 0.
    Rows that repeat are scored each. An empty table gives no rows; no labels: evidence of one half.
    """
    model = fit(docs, labels, key, label)
    told = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("__k")).agg(F.min(label).cast("double").alias("__y"))
    odds = described(docs.select(key, host.cast("string").alias("host"), path.cast("string").alias("path"), "text"), [key, "host", "path"], model)
    odds = odds.select(key, "host", "path", F.col("__value").alias("odds"))
    p = 1 / (1 + F.exp(-F.col("odds")))
    rows = stage(odds.join(told, F.col(key) == F.col("__k"), "left").select(key, "host", "path", "odds", F.coalesce("__y", p).alias("q")), "evidence")
    paths = stage(rows.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum("q").alias("s")), "paths")
    total = paths.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum("s"), F.lit(0.0))).first()
    rate = (total[1] + 0.5) / (total[0] + 1)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).withColumn("parent", F.lit(rate))
    a = _worth(hosts)
    hosts = hosts.select(F.col("host").alias("__h"), F.col("n").alias("hn"), F.col("s").alias("hs"), ((F.col("s") + a * F.col("parent")) / (F.col("n") + a)).alias("parent"))
    nested = stage(paths.join(hosts, F.col("host").eqNullSafe(F.col("__h"))), "hosts")
    b = _worth(nested)
    sites = nested.select(F.col("host").alias("__h"), F.col("path").alias("__p"), "n", "s", "hn", "hs")
    # each document meets the rates of its sites without itself
    without = lambda s, n, prior, worth: (F.col(s) - F.col("q") + worth * prior) / (F.col(n) - 1 + worth)
    out = rows.join(sites, F.col("host").eqNullSafe(F.col("__h")) & F.col("path").eqNullSafe(F.col("__p")))
    out = out.withColumn("host_rate", without("hs", "hn", F.lit(rate), a)).withColumn("path_rate", without("s", "n", F.col("host_rate"), b))
    logit = lambda x: F.log(x / (1 - x))
    clip = lambda x: F.least(F.greatest(x, F.lit(1e-9)), F.lit(1 - 1e-9))
    all_odds = F.col("odds") + logit(clip(F.col("path_rate"))) - F.lit(float(np.log(rate / (1 - rate))))
    return out.select(key, "host", "path", p.alias("evidence"), "host_rate", "path_rate", (1 / (1 + F.exp(-all_odds))).alias("score"))
