import math
from fractions import Fraction

import numpy as np
import pytest

from rentscope.llm import catalog
from rentscope.llm import whiten_qdwh as W

SCHEMA = "vec_id bigint, embedding array<double>"


@pytest.mark.parametrize("name", ["wide", "equal", "near", "graded", "low rank", "diagonal", "one", "swap"])
def test_eigenpairs(name):
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    x = rng.standard_normal((12, 40))
    a = {"wide": x.T @ x + np.eye(40), "equal": q @ np.diag([1e6] * 10 + [5.0] * 20 + [0.0] * 10) @ q.T,
         "near": q @ np.diag(1 + 1e-13 * np.arange(40)) @ q.T, "graded": q @ np.diag(10.0 ** -np.arange(40)) @ q.T,
         "low rank": x.T @ x, "diagonal": np.diag([3.0, 1, 1, 2, 0]), "one": np.array([[4.0]]), "swap": np.array([[0, 1.0], [1, 0]])}[name]
    values, vectors = W.eigenpairs(a)
    size, n = np.abs(a).max(), len(a)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * size * n
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() <= 1e-13 * n
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * size * n
    assert (np.diff(values) <= 0).all()


def test_polar_factor_is_the_sign_of_the_spectrum():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((9, 9)))
    u = W.polar_factor(q @ np.diag([5, 3, 1e-3, -1e-6, -2, -7, 4, -1, 1e-9]) @ q.T)
    assert np.abs(u - q @ np.diag([1, 1, 1, -1, -1, -1, 1, -1, 1]) @ q.T).max() < 1e-6


def expected(rows, k=8):
    """Exact integers and Fractions; numpy's eigenvalues."""
    ok = [(i, [math.floor(1024 * float(c)) + 100_000 for c in v]) for i, v in rows
          if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(ok), len(ok[0][1])
    s = [sum(x[j] for _, x in ok) for j in range(d)]
    centred = [[Fraction(n * x[j] - s[j], n) for j in range(d)] for _, x in ok]
    cov = np.array([[float(sum(c[i] * c[j] for c in centred) / n) for j in range(d)] for i in range(d)])
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    dev = [(i, sum((n * x[j] - s[j]) ** 2 for j in range(d))) for i, x in ok]
    return n, dev, e, v, np.array([[float(c) for c in r] for r in centred]), cov


def test_whitening_equals_exact_arithmetic(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 10)) @ rng.standard_normal((10, 10)) * 0.1
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(3, base[3].tolist())]
    bad = [(100, None), (101, [float("nan")] * 10), (102, [1.0] * 9 + [None]), (103, [float("-inf")] + [0.0] * 9), (104, []),
           (105, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, SCHEMA).selectExpr("*", "1 as x", "'y' as id", "2 as n").repartition(4)
    got = W.whiten(df).collect()
    n, dev, e, v, centred, cov = expected(rows)
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert sorted((r.vec_id, r.deviation) for r in got if r.component == 1) == sorted(dev)
    assert {r.deviation == int(r.deviation_exact) for r in got} == {True}
    for r in got:
        assert abs(r.explained - e[r.component - 1] / np.trace(cov)) < 1e-12
        assert r.identity_error < 1e-9
    mine = {(r.vec_id, r.component): r.whitened for r in got}
    want = centred @ v[:, :8] / np.sqrt(e[:8])
    for c in range(8):
        a = np.array([mine[i, c + 1] for i in range(60)])
        assert min(np.abs(a - want[:60, c]).max(), np.abs(a + want[:60, c]).max()) < 1e-9


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert W.whiten(empty).count() == 0 and W.whiten(empty).columns[:7] == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, SCHEMA)).count() == 0        # no variance
    got = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [3.0, 2.0]), (None, [3.0, 2.0])], SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in got) == [("1", 1, 3), ("None", 1, 3), ("None", 1, 3)]
    assert {round(r.explained, 9) for r in got} == {1.0}
    # large entries: exact beyond 64 bits
    big = [(1, [2.0 ** 50, 1.0]), (2, [-2.0 ** 50, 2.0]), (3, [0.5, 3.0]), (4, [2.0 ** 60, 0.0])]
    got = {r.vec_id: r for r in W.whiten(spark.createDataFrame(big, SCHEMA)).collect() if r.component == 1}
    n, dev, *_ = expected(big[:3])
    assert sorted(got) == [1, 2, 3] and {i: int(got[i].deviation_exact) for i in got} == dict(dev)
    assert got[1].deviation is None


def test_query_equals_exact_arithmetic(spark):
    got = catalog.queries()["op12_whitening"](spark, "/root/testdata/sf0.001").collect()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    n, dev, e, v, centred, cov = expected(rows)
    assert sorted((r.vec_id, r.deviation) for r in got if r.component == 1) == sorted(dev) and len(got) == 8 * n
    assert max(r.identity_error for r in got) < 1e-9
    for r in got:
        assert abs(r.explained * np.trace(cov) / e[r.component - 1] - 1) < 1e-9
