"""Whitening against dense eigenvalue solutions and exact whole numbers."""

from fractions import Fraction

import numpy as np
import pytest

from flexspark.llm import queries_vectors, whiten

SCHEMA = "vec_id long, embedding array<float>, x string, key int, whitened double"


def spectrum(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T, q


@pytest.mark.parametrize("values", [
    list(range(40, 0, -1)),
    [5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0] + [1.0] * 20,
    [1e9, 1.0, 1.0 - 1e-9, 1e-3] + [0.0] * 30,
    [3.0, 2.0],
    [1.0] * 25,
    [7.0] + [0.0] * 9,
    list(1 + 1e-7 * np.arange(64)[::-1]),
])
def test_components(values):
    """Falling values, unit vectors with residuals at rounding, none missed: distinct, repeated, clustered, vanishing spectra."""
    v, _ = spectrum(values)
    v = (v + v.T) / 2
    want = np.linalg.eigvalsh(v)[::-1]
    e, u = whiten.components(v, 4)
    assert len(e) == min(4, (np.array(values) > 5e-13 * max(values)).sum())
    assert np.allclose(e, want[: len(e)], rtol=0, atol=1e-13 * want[0] * len(values))
    assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12)
    assert np.linalg.norm(v @ u - u * e, axis=0).max() <= 1e-13 * want[0] * len(values)


def test_inertia():
    v, _ = spectrum([-3, -1, 0.5, 2, 2, 7])
    assert [whiten.above(v, s) for s in (-4, -2, 0, 1, 3, 8)] == [6, 5, 4, 3, 1, 0]
    assert whiten.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0) == 1
    assert whiten.above(np.zeros((3, 3)), 0) == 0


def brute(vectors):
    """n, S, covariance of the distinct integer vectors, in fractions."""
    xs = sorted({tuple(int(np.floor(256 * float(c))) for c in v) for v in vectors})
    n, d = len(xs), len(xs[0])
    s = [sum(x[i] for x in xs) for i in range(d)]
    v = [[float(Fraction(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in xs), n**3)) for j in range(d)] for i in range(d)]
    return xs, n, s, np.array(v)


def test_whole_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    xs, n, s, v = brute([r.embedding for r in rows])
    e, u = np.linalg.eigh(v)
    got = {}
    for r in queries_vectors.op12_feast_whitening(spark, folder).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    assert got.keys() == {r.vec_id for r in rows} and all(g.keys() == {1, 2, 3, 4} for g in got.values())
    x = {r.vec_id: [int(np.floor(256 * float(c))) for c in r.embedding] for r in rows}
    for k in range(1, 5):
        want = {i: float((np.array(x[i]) - np.array([float(Fraction(t, n)) for t in s])) @ u[:, -k] / e[-k] ** 0.5) for i in x}
        sign = np.sign(sum(want[i] * got[i][k].whitened for i in x))
        assert max(abs(sign * want[i] - got[i][k].whitened) for i in x) < 1e-9
    assert all(g[1].deviation == sum((n * a - t) ** 2 for a, t in zip(x[i], s)) and g[1].n == n for i, g in got.items())
    one = got[rows[0].vec_id]
    assert all(abs(one[k].explained - e[-k] / np.trace(v)) < 1e-12 for k in one)
    assert one[1].identity_error < 1e-10


def test_odd_vectors(spark):
    """Nulls, non-finite entries, other lengths, repeats, huge offsets, clashing names, no rows."""
    nan, inf = float("nan"), float("inf")
    plain = [[1.0, 0.5, -3.0], [1.0, 0.25, 2.0], [0.0, 0.0, 0.1], [7.0, -1.0, 1.0]]
    odd = [None, [], [1.0, None, 2.0], [nan, 1.0, 1.0], [inf, 0.0, 0.0], [-inf, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, "x", 1, 0.5) for i, v in enumerate([*plain, *odd, plain[0], plain[0]])] + [(None, plain[1], "x", None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out, w = whiten.whiten(df, k=4)
    xs, n, s, v = brute(plain)
    assert (w.n, w.sums) == (n, s) and np.array_equal(w.covariance, v) and len(w.values) == 3
    got = out.collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(["0", "1", "2", "3", "11", "12", "None"]) and out.columns == ["vec_id", "deviation", "whitened"]
    assert len({tuple(r.whitened) for r in got}) == 4 and all(len(r.whitened) == 3 for r in got)
    none, w = whiten.whiten(df.where("vec_id > 3 and vec_id < 10"), k=4)
    assert none.count() == 0 and w is None
    same, w = whiten.whiten(df.where("vec_id in (0, 11)"), k=4)
    assert [r.whitened for r in same.collect()] == [[], []] and w.n == 1 and not len(w.values)
    far = spark.createDataFrame([(i, [1e15 + 1e8 * a for a in v], "x", 1, 0.5) for i, v in enumerate(plain)], SCHEMA.replace("float", "double"))
    out, w = whiten.whiten(far, k=2)
    assert np.array_equal(w.covariance, brute([[1e15 + 1e8 * a for a in v] for v in plain])[3]) and w.identity_error < 1e-9
    assert [r.deviation for r in out.collect()] == [None] * 4
    past = spark.createDataFrame([(0, [1e30, 1.0], "x", 1, 0.5), (1, [2.0, 1.0], "x", 1, 0.5)], SCHEMA)
    out, w = whiten.whiten(past, k=2)
    assert out.count() == 2
