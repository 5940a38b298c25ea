import math
import random

import numpy as np
import pytest

from duelframe.llm import queries
from duelframe.llm import whitening as W

SF = "/root/testdata/sf0.01"


def brute(rows, k=8):
    """{(vec_id, component): (n, deviation, whitened, explained)} with whole covariances, sign of largest entry positive."""
    rows = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(rows), len(rows[0][1])
    s = [sum(x[j] for _, x in rows) for j in range(d)]
    y = np.array([[(n * x[j] - s[j]) / n for j in range(d)] for _, x in rows])
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    u = u * np.sign(u[np.abs(u).argmax(axis=0), np.arange(d)])
    w = y @ u / np.sqrt(e)
    return {(i, c + 1): (n, sum((n * x[j] - s[j]) ** 2 for j in range(d)), w[r, c], e[c] / e.sum())
            for r, (i, x) in enumerate(rows) for c in range(min(k, d))}


def same(got, want):
    got = {(r["vec_id"], r["component"]): r for r in got}
    assert sorted(got) == sorted(want)
    for key, (n, dev, white, explained) in want.items():
        r = got[key]
        assert (r["n"], r["deviation"]) == (n, dev)
        assert abs(r["whitened"] - white) < 1e-8 and abs(r["explained"] / explained - 1) < 1e-10
        assert r["identity_error"] < 1e-10


def test_query_matches_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same(queries.op13_embedding_whitening(spark, SF).collect(), brute(rows))


def test_odd_rows(spark):
    rng = random.Random(3)
    good = [(i, [rng.gauss(0, 1 + j) for j in range(5)]) for i in range(60)]
    good += [good[0], (None, good[1][1])]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [1.0, math.nan, 2.0, 3.0, 4.0]), (103, [math.inf] * 5),
           (104, []), (105, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 7, 8.0) for i, v in good + bad], "vec_id long, embedding array<double>, n int, component double")
    got = W.whiten(df).collect()
    assert len(got) == len(good) * 5
    ids = [i for i, _ in good]
    want = brute([(k, v) for k, (_, v) in enumerate(good)])
    seen = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["component"], round(r["whitened"], 8), r["deviation"]) for r in got)
    assert seen == sorted((-1 if ids[k] is None else ids[k], c, round(w, 8), dev) for (k, c), (_, dev, w, _) in want.items())
    assert W.whiten(df.where("vec_id > 99")).count() == 2  # the one vector of two entries is left
    assert W.whiten(df.limit(0)).count() == 0
    clash = W.whiten(df.selectExpr("vec_id as n", "embedding"), id_col="n")
    assert clash.columns[0] == "n_" and clash.count() == len(got)
    with pytest.raises(Exception, match="exceeds"):
        W.whiten(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")).collect()


def test_dimensions_without_variance(spark):
    rng = random.Random(4)
    rows = []
    for i in range(40):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, [a, b, 0.25, float(round(a * 1024) / 1024), 1.0]))
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    by = {c: [r for r in got if r["component"] == c] for c in range(1, 6)}
    assert all(r["whitened"] is None and r["explained"] == 0 for c in (4, 5) for r in by[c])
    assert all(r["whitened"] is not None for r in by[1]) and got[0]["identity_error"] < 1e-9
    one = W.whiten(spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r["whitened"], r["explained"], r["deviation"]) for r in one] == [(None, 0.0, 0)] * 2


@pytest.mark.parametrize("gap", [1e-3, 1e-9, 1e-13, 0.0])
def test_clustered_eigenvalues_are_refined(gap):
    rng = np.random.default_rng(5)
    d = 24
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    q = q.astype(np.longdouble)
    for _ in range(4):  # orthonormal in long double
        q = q @ (1.5 * np.eye(d, dtype=np.longdouble) - 0.5 * (q.T @ q))
    values = np.array([3.0, 1 + 2 * gap, 1 + gap, 1.0, *np.linspace(0.5, 1e-6, d - 4)], np.longdouble)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = W.components(a)
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-17
    assert np.abs(x.T @ a @ x - np.diag(got)).max() < 1e-17
    assert np.abs(got - values).max() < 1e-17
    if gap > 1e-12:
        assert np.abs(np.abs((x * q).sum(axis=0)) - 1).max() < 1e-12
    plain = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(np.longdouble)
    assert np.abs(plain.T @ a @ plain - np.diag(np.diag(plain.T @ a @ plain))).max() > 1e-9  # where it started


def test_exact_sums_of_large_entries(spark):
    rows = [(i, [2.0 ** 39 + i, -2.0 ** 38 * (i % 3), i / 7]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    m = W.moments(df)
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    assert m.n == 9 and m.sums == [sum(c) for c in zip(*x)]
    from fractions import Fraction
    mean = [Fraction(t, 9) for t in m.sums]
    for i in range(3):
        for j in range(3):
            want = sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / 9
            assert abs(float(m.covariance[i, j]) - float(want)) <= 1e-15 * abs(float(want))
    big = {r["vec_id"]: r["deviation"] for r in W.whiten(df).collect()}
    for (i, _), r in zip(rows, x):
        want = sum((9 * v - t) ** 2 for v, t in zip(r, m.sums))
        assert big[i] == (want if want < 1 << 63 else None)
