"""Nearest neighbours by inner product: a forest of random-projection trees, one shared priority queue, exact reranking.

Vectors are scaled by the largest norm and given one more component that makes all norms 1; queries get 0 there. The nearest by
angle are then the largest inner products. Each tree splits at the median along the line between two random
sampled vectors, down to LEAF sampled vectors. Trees are fitted on at most SAMPLE vectors, those with the smallest hashes;
every vector is indexed.

A query's queue holds nodes of all trees, ordered by the smallest margin on the way to them; leaves are taken until they hold a share of
all vectors (counted with repeats over trees) and one tree alone gives ``k`` candidates. The share follows from the table at hand: HELD sampled vectors search the
sample, and the least share that finds RECALL of their true neighbours there is taken. Vectors close to random need nearly all of it, clustered
ones little. Candidates are ranked by the exact inner product; those below the k + 1st best of the sampled vectors in a query's own leaves
can't be among its nearest and are let go at once.

Equal vectors are one entry with their k + 1 smallest ids: more can never be among k nearest. Neighbouring leaves of a tree are searched together, in
blocks of about BLOCK entries by QUERIES queries; a larger leaf is cut into such blocks. A block gives each query's k + 1 best of the leaves it asked for.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flexspark.sources.scratch import stage

SAMPLE, TREES, LEAF = 20_000, 6, 100
HELD, RECALL = 64, 0.96
BLOCK, QUERIES = 4096, 4096


class Tree(NamedTuple):
    """Inner nodes: normal, offset, children; a child below 0 is leaf -1 - child."""

    normal: np.ndarray
    offset: np.ndarray
    child: np.ndarray
    leaves: int


def grow(x: np.ndarray, seed: int, leaf: int = LEAF) -> Tree:
    rng = np.random.default_rng(seed)
    normals, offsets, children, leaves = [], [], [], 0

    def node(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            for _ in range(5):
                a, b = rng.choice(rows, 2, replace=False)
                n = x[a] - x[b]
                if (size := np.linalg.norm(n)) > 0:
                    p = x[rows] @ (n / size)
                    cut = float(np.median(p))
                    left = p <= cut
                    if 0 < left.sum() < len(rows):
                        me = len(normals)
                        normals.append(n / size)
                        offsets.append(cut)
                        children.append([0, 0])
                        children[me][0] = node(rows[left])
                        children[me][1] = node(rows[~left])
                        return me
        leaves += 1
        return -leaves

    root = node(np.arange(len(x)))
    if root < 0:
        return Tree(np.zeros((0, x.shape[1])), np.zeros(0), np.zeros((0, 2), np.int64), 1)
    return Tree(np.array(normals), np.array(offsets), np.array(children), leaves)


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf of each row."""
    at = np.zeros(len(x), np.int64) if len(tree.normal) else np.full(len(x), -1)
    while (live := np.flatnonzero(at >= 0)).size:
        n = at[live]
        right = (x[live] * tree.normal[n]).sum(axis=1) > tree.offset[n]
        at[live] = tree.child[n, right.astype(np.int64)]
    return -1 - at


def search(trees: list[Tree], counts: list[np.ndarray], q: np.ndarray, want: float, least: int) -> list[tuple[int, int]]:
    """(tree, leaf) of the leaves to look at for one query, nearest first."""
    sides = [t.normal @ q - t.offset for t in trees]
    queue = [(-np.inf, i, 0 if len(t.normal) else -1) for i, t in enumerate(trees)]
    heapq.heapify(queue)
    out, total, per = [], 0, [0] * len(trees)
    while queue and (total < want or max(per) < least):
        margin, i, n = heapq.heappop(queue)
        while n >= 0:  # down the near side; the far side waits in the queue
            side = sides[i][n]
            right = int(side > 0)
            heapq.heappush(queue, (max(margin, abs(side)), i, int(trees[i].child[n, 1 - right])))
            n = int(trees[i].child[n, right])
        leaf = -1 - n
        if counts[i][leaf]:
            out.append((i, leaf))
            total += counts[i][leaf]
            per[i] += counts[i][leaf]
    return out


def share_for(trees: list[Tree], x: np.ndarray, k: int) -> float:
    """The least share of all rows (counted with repeats over trees) at which HELD of the rows find RECALL of their k nearest others among the rows."""
    rows = np.random.default_rng(99).permutation(len(x))[:HELD]
    leaves = [leaf_of(t, x) for t in trees]
    counts = [np.bincount(a, minlength=t.leaves) for a, t in zip(leaves, trees)]
    # as a query a row has its first components alone, at unit length
    q = np.concatenate([x[rows, :-1] / np.maximum(np.linalg.norm(x[rows, :-1], axis=1), 1e-300)[:, None], np.zeros((len(rows), 1))], axis=1)
    needed = []
    for i, own in enumerate(rows.tolist()):
        s = x @ q[i]
        s[own] = -np.inf
        nearest = np.argsort(-s, kind="stable")[: min(k, len(x) - 1)]
        seen, met = 0, np.full(len(nearest), np.inf)
        for t, leaf in search(trees, counts, q[i], np.inf, 0):
            seen += counts[t][leaf]
            met = np.where(leaves[t][nearest] == leaf, np.minimum(met, seen), met)
        needed.append(met)
    every = np.sort(np.concatenate([np.zeros(0), *needed]))
    return float(every[int(np.ceil(RECALL * len(every))) - 1]) / len(x) if len(every) else 1.0


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def nearest(df: DataFrame, key: str, vector: str, is_query, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that ``is_query``, ties to the smaller id.

    Vectors that are null, zero, hold null or non-finite components, or have another length than most take no part, as rows without
    a key. A key that repeats stands for all its vectors, with the best score; a row is never its own key's neighbour. With k
    candidates or fewer all are returned. An empty table gives no rows.
    """
    spark = df.sparkSession
    v = F.col(vector).cast("array<double>")
    good = F.col(vector).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(key).cast("long").alias("id"), v.alias("v"), is_query.alias("q")).where(F.col("id").isNotNull() & F.coalesce(good, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return none
    dim = sizes["d"]
    rows = rows.where(F.size("v") == dim)
    # one entry for equal vectors; a window's partial limit keeps a hot vector's rows in their tasks
    few = Window.partitionBy("v").orderBy("id")
    ids = rows.select("id", "v").withColumn("r", F.rank().over(few)).where(F.col("r") <= k + 1).groupBy("v").agg(F.slice(F.sort_array(F.collect_set("id")), 1, k + 1).alias("ids"))
    entries = stage(ids.select(F.xxhash64("v").alias("h"), "ids", "v"), "entries")
    total = entries.count()
    top = entries.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] ** 0.5
    picked = entries.select(F.col("h").alias("p")).orderBy("p").limit(SAMPLE)
    sample = entries.join(F.broadcast(picked.distinct()), F.col("h") == F.col("p"), "left_semi").select("h", "v").toArrow().sort_by("h")
    x = _matrix(sample["v"].combine_chunks(), dim) / top
    x = np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))[:, None]], axis=1)
    trees = [grow(x, 1000 + i) for i in range(TREES)]
    forest = spark.sparkContext.broadcast([tuple(t) for t in trees])  # SAMPLE / LEAF * 2 nodes a tree at most

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(*t) for t in forest.value]
        for batch in batches:
            m = _matrix(batch["v"], dim)
            y = m / top
            y = np.concatenate([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))[:, None]], axis=1)
            for i, t in enumerate(trees):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), i), pa.int32()), pa.array(leaf_of(t, y), pa.int32()), batch["h"], pc.list_element(batch["ids"], 0), batch["v"]], names=["tree", "leaf", "h", "first", "v"])

    index = stage(entries.mapInArrow(place, "tree int, leaf int, h long, first long, v array<double>"), "forest")
    counts = [np.zeros(t.leaves, np.int64) for t in trees]
    for r in index.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect():  # a row for each leaf of the forest
        counts[r["tree"]][r["leaf"]] = r["n"]
    # neighbouring leaves make a group of about BLOCK entries
    groups = [np.cumsum(n) // BLOCK for n in counts]
    shared = spark.sparkContext.broadcast((counts, groups))
    known = spark.sparkContext.broadcast((x, [leaf_of(t, x) for t in trees]))  # SAMPLE vectors at most
    want = share_for(trees, x, k) * total

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(*t) for t in forest.value]
        for batch in batches:
            y = _matrix(batch["v"], dim)
            y = np.concatenate([y / np.linalg.norm(y, axis=1)[:, None], np.zeros((len(y), 1))], axis=1)
            counts, groups = shared.value
            sampled, places = known.value
            tree, group, of, leaves, floors = [], [], [], [], []
            for i, (q, size) in enumerate(zip(y, np.linalg.norm(_matrix(batch["v"], dim), axis=1))):
                by: dict[tuple[int, int], list[int]] = {}
                chosen = [np.zeros(n.shape, bool) for n in counts]
                for t, leaf in search(trees, counts, q, want, k + 1):
                    by.setdefault((t, int(groups[t][leaf])), []).append(leaf)
                    chosen[t][leaf] = True
                met = np.flatnonzero(np.any([c[p] for c, p in zip(chosen, places)], axis=0))
                floor = np.partition(sampled[met] @ q, len(met) - k - 1)[len(met) - k - 1] * size * top if len(met) > k else -np.inf
                floors += [floor - 1e-9 * abs(floor) - 1e-300 if np.isfinite(floor) else -np.inf] * len(by)
                tree += [t for t, _ in by]
                group += [g for _, g in by]
                leaves += by.values()
                of += [i] * len(by)
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(group, pa.int32()), batch["qn"].take(of), pa.array(leaves, pa.list_(pa.int32())), batch["v"].take(of), pa.array(floors, pa.float64())], names=["tree", "grp", "qn", "leaves", "qv", "floor"])

    queries = stage(rows.where("q").select("id", "v", F.xxhash64("v").alias("qn")).distinct(), "queries")
    asked = stage(queries.select("v", "qn").distinct().mapInArrow(ask, "tree int, grp int, qn long, leaves array<int>, qv array<double>, floor double"), "asked")
    load = asked.groupBy("tree", "grp").agg(F.count("*").alias("n")).collect()  # at most a row for each leaf
    held = [np.bincount(g, weights=n) for g, n in zip(groups, counts)]
    blocks = [(r["tree"], r["grp"], -(-int(held[r["tree"]][r["grp"]]) // (2 * BLOCK)), -(-r["n"] // QUERIES)) for r in load]
    if not blocks:
        return none
    plan = F.broadcast(spark.createDataFrame(blocks, "t int, g int, vs int, qs int"))
    numbered = spark.createDataFrame([(t, leaf, int(g)) for t, of in enumerate(groups) for leaf, g in enumerate(of)], "t int, l int, grp int")
    placed = index.join(F.broadcast(numbered), (F.col("tree") == F.col("t")) & (F.col("leaf") == F.col("l"))).select("tree", "grp", "leaf", "h", "first", "v")
    on = (F.col("tree") == F.col("t")) & (F.col("grp") == F.col("g"))
    left = asked.join(plan, on).withColumn("qb", F.pmod(F.col("qn"), F.col("qs")).cast("int")).withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("vs") - 1)))
    right = placed.join(plan, on).withColumn("vb", F.pmod(F.xxhash64(F.col("h"), F.lit(1)), F.col("vs")).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)))

    def rank(one: pa.Table, two: pa.Table) -> pa.Table:
        q, m = (_matrix(t[c].combine_chunks(), dim) if len(t) else np.zeros((0, dim)) for t, c in ((one, "qv"), (two, "v")))
        who, what = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(q) and len(m):
            here, place = np.unique(two["leaf"].to_numpy(), return_inverse=True)
            asked = np.zeros((len(q), len(here)), bool)
            wanted = one["leaves"].combine_chunks()
            row = np.repeat(np.arange(len(q)), np.diff(wanted.offsets.to_numpy()))
            flat = wanted.flatten().to_numpy()
            at = np.minimum(np.searchsorted(here, flat), len(here) - 1)
            asked[row[here[at] == flat], at[here[at] == flat]] = True
            n, least = min(k + 1, len(m)), one["floor"].to_numpy()
            for a in range(0, len(q), 256):
                s = np.where(asked[a : a + 256][:, place], q[a : a + 256] @ m.T, -np.inf)
                floor = np.partition(s, len(m) - n, axis=1)[:, len(m) - n, None]
                i, j = np.nonzero((s >= np.maximum(floor - 1e-12, least[a : a + 256, None])) & (s > -np.inf))
                who.append(i + a)
                what.append(j)
        who, what = np.concatenate(who), np.concatenate(what)
        return pa.table({"qn": one["qn"].take(pa.array(who)), "h": two["h"].take(pa.array(what)), "first": two["first"].take(pa.array(what)), "score": pa.array((q[who] * m[what]).sum(axis=1), pa.float64())})

    by = ["tree", "grp", "vb", "qb"]
    hits = left.select(*by, "qn", "leaves", "qv", "floor").groupBy(*by).cogroup(right.select(*by, "leaf", "h", "first", "v").groupBy(*by)).applyInArrow(rank, "qn long, h long, first long, score double")
    best = Window.partitionBy("qn").orderBy(F.desc("score"), "first")
    near = hits.groupBy("qn", "h", "first").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("qn", "h", "first", "score")
    near = stage(near, "near")
    listed = entries.select(F.col("h").alias("eh"), F.col("ids")[0].alias("ef"), "ids")
    named = near.join(listed, (F.col("h") == F.col("eh")) & (F.col("first") == F.col("ef"))).select("qn", "ids", "score")
    pairs = queries.select(F.col("id").alias("query_id"), "qn").join(named, "qn").select("query_id", F.explode("ids").alias("vec_id"), "score").where("query_id <> vec_id")
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
