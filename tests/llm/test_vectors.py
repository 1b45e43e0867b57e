"""Centroid clustering and whitening against brute-force versions."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from loglynx.llm import centroids, queries, whitening

DATA = "/root/testdata/sf0.001"


def brute_clusters(rows, k, rounds, dim, scale, seed):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cent = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cent))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for i in range(len(cent)):
            mine = [v for (_, v), c in zip(kept, of) if c == i]
            if mine:
                cent[i] = [sum(col) // len(mine) for col in zip(*mine)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    total = sum(d for *_, d in out)
    return [(i, c, d, sum(e for _, b, e in out if b == c), total, cent[c]) for i, c, d in out]


def said(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("spread", [3, 400])
def test_threshold_walk_equals_full_search(spread):
    rng = np.random.default_rng(spread)
    for k, dim in ((1, 1), (2, 3), (40, 64), (7, 2)):
        x, c = rng.integers(-spread, spread, (300, dim)), rng.integers(-spread, spread, (k, dim))
        at, d = centroids.nearest(x, c)
        full = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (d == full.min(1)).all() and (at == full.argmin(1)).all()  # ties: the smaller number


def test_clusters_equal_brute_force(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").limit(200)
    rows = [(r[0], list(r[1])) for r in df.collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in centroids.cluster(df, k=9, rounds=3).collect()]
    assert said(got) == said(brute_clusters(rows, 9, 3, 64, 256, 2))


def test_clusters_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5]), (2, [0.5, -0.5]), (2, [0.5, -0.5]), (3, None), (4, []), (5, [1.0]), (6, [nan, 1.0]), (7, [1.0, -inf]),
            (8, [None, 1.0]), (None, [3.0, 4.0]), (None, None), (9, [-0.001, 0.001]), (10, [0.25, 0.0]), (10, [0.0, 0.25])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, `key` string")
    for k, rounds in ((3, 0), (3, 2), (40, 1)):
        got = [tuple(r) for r in centroids.cluster(df, k=k, rounds=rounds, dim=2).collect()]
        assert said(got) == said(brute_clusters(rows, k, rounds, 2, 256, 2))
    empty = centroids.cluster(df.where("false"), dim=2)
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    with pytest.raises(Exception, match="not supported"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 1.0])], "vec_id long, embedding array<double>"), dim=2).collect()


def brute_whitening(m):
    x = np.floor(64 * m.astype(np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), [int(t) for t in x.astype(object).sum(0)]
    dev = [sum((n * int(a) - b) ** 2 for a, b in zip(r, s)) for r in x]
    z = x - np.array(s, np.float64) / n
    e, u = np.linalg.eigh(z.T @ z / n)
    return dev, z, e[::-1], u[:, ::-1]


def test_whitening_equals_eigh(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    dev, z, e, u = brute_whitening(np.array([r["embedding"] for r in rows]))
    got = queries.op12_embedding_whitening(spark, DATA).orderBy("vec_id", "component").toPandas()
    assert len(got) == 32 * len(rows) and (got.component.to_numpy().reshape(-1, 32) == np.arange(1, 33)).all()
    assert got.deviation.to_numpy()[::32].tolist() == dev and (got.n == len(rows)).all()
    assert np.allclose(got.explained.to_numpy()[:32], e[:32] / e.sum(), rtol=1e-10)
    w = got.whitened.to_numpy().reshape(-1, 32)
    want = z @ u[:, :32] / np.sqrt(e[:32])
    assert np.allclose(w * np.sign((w * want).sum(0)), want, atol=1e-6)
    cov = w.T @ w / len(w) - np.outer(w.mean(0), w.mean(0))
    assert got.identity_error.nunique() == 1 and abs(got.identity_error[0] - np.abs(cov - np.eye(32)).max()) < 1e-12 and got.identity_error[0] < 1e-10


def test_whitening_of_graded_and_deficient_scatter():
    rng = np.random.default_rng(1)
    b = rng.normal(size=(12, 7)) * 10.0 ** -np.arange(7)
    a = (b @ b.T).astype(np.longdouble)
    g = whitening.pivoted_cholesky(a)
    values, u = whitening.jacobi(g)
    want = np.linalg.svd(b, compute_uv=False) ** 2
    assert np.allclose(values[:7].astype(float), want, rtol=1e-6) and len(values) < 12
    assert np.allclose((u.T @ u).astype(float), np.eye(len(values)), atol=1e-12)
    z = rng.integers(-(1 << 32), 1 << 32, (50, 4))
    assert (whitening.gram(z) == z.astype(object).T @ z.astype(object)).all()
    assert (whitening.gram(z >> 20) == (z >> 20).T @ (z >> 20)).all()


def test_whitening_of_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [0.5, -0.5, 2.0]), (1, [0.5, -0.5, 2.0]), (2, None), (3, [nan, 1.0, 0.0]), (4, [None, 1.0, 0.0]), (None, [1.0, 3.0, 2.0]),
            (5, [7.0, 1.0, 2.0]), (6, [1.0]), (7, []), (8, [9.0, float("inf"), 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, component int")
    got = whitening.whiten(df).orderBy("vec_id", "component").collect()
    assert [(r["vec_id"], r["component"]) for r in got] == [(None, 1), (None, 2), (1, 1), (1, 1), (1, 2), (1, 2), (5, 1), (5, 2)]  # one dimension does not vary
    dev, z, e, u = brute_whitening(np.array([v for i, v in rows if i in (1, None, 5)]))
    assert sorted(r["deviation"] for r in got[::2]) == sorted(dev) and got[0]["identity_error"] < 1e-12
    for some in (df.where("false"), df.where("vec_id = 1"), df.where("vec_id = 5"), df.where("vec_id = 7")):
        assert whitening.whiten(some).count() == 0
    far = spark.createDataFrame([(1, [3e7, 0.0]), (2, [-3e7, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    told = whitening.whiten(far).orderBy("vec_id", "component").collect()
    assert [r["deviation"] for r in told[::2]] == [None, None, (2 * 64) ** 2 + 0] and told[0]["identity_error"] < 1e-4
