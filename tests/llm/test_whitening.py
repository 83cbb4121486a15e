"""Whitening against exact fractions, a double-precision solver and matrices with clustered eigenvalues."""

import math
import os
import random
from fractions import Fraction

import numpy as np
import pytest

from starloom.llm import suite, whitening
from starloom.llm.whitening import eigen, fit, fixed_point, identity_error, product_sums, squared_deviation, whiten

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def made(values, seed=0):
    """A symmetric matrix with about these eigenvalues."""
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    q = q.astype(np.longdouble)
    for _ in range(3):  # orthogonal to extended precision
        q = q + q @ (np.eye(len(q), dtype=np.longdouble) - q.T @ q) / 2
    a = (q * np.array(values, dtype=np.longdouble)) @ q.T
    return (a + a.T) / 2, q


def wrong(a, values, x):
    size = np.abs(a).max()
    return float(np.abs(a @ x - x * values).max() / size), float(np.abs(x.T @ x - np.eye(len(a))).max())


@pytest.mark.parametrize(
    "values",
    [
        [10.0 - 0.3 * k for k in range(24)],
        [2.0**-k for k in range(24)],
        [3.0] * 5 + [1.0] * 7,
        [1 + 1e-9 * k for k in range(10)] + [0.5, 0.5, 0.0, 0.0],
        [1.0, 1.0 - 1e-14, 1.0 - 2e-14, 0.25, 0.25 - 1e-12, 1e-8, 0.0],
        [5.0],
        [0.0] * 4,
        [1.0] * 6,
    ],
)
def test_eigen(values):
    a, _ = made(values)
    found, x = eigen(a)
    residual, turned = wrong(a, found, x) if max(values) else (0.0, 0.0)
    assert residual < 2e-17 and turned < 2e-17
    assert np.allclose(found.astype(float), sorted(values, reverse=True), rtol=0, atol=1e-16 * max(1, max(values)) * 8)


def test_close_values_keep_their_vectors():
    """Vectors of values 1e-6 apart are right to double precision, which a solver in doubles does not reach."""
    values = [1 + 1e-6 * k for k in range(8)][::-1]
    a, q = made(values)
    _, x = eigen(a)
    assert float(np.abs(np.abs((q * x).sum(axis=0)) - 1).max()) < 1e-16
    turned = np.abs(x - q * np.sign((q * x).sum(axis=0)))
    assert float(turned.max()) < 1e-12


@pytest.mark.parametrize("top", [100, 2**27, 2**44, 2**61])
def test_product_sums_are_exact(top):
    rng = random.Random(top)
    z = np.array([[rng.randint(-top, top) for _ in range(3)] for _ in range(50)], dtype=np.int64)
    want = [[sum(int(r[i]) * int(r[j]) for r in z) for j in range(3)] for i in range(3)]
    assert [[int(v) for v in row] for row in product_sums(z)] == want


def exact(points):
    """Sums, and the covariance times n squared."""
    n, d = len(points), len(points[0])
    sums = [sum(p[i] for p in points) for i in range(d)]
    return n, sums, [[n * sum(p[i] * p[j] for p in points) - sums[i] * sums[j] for j in range(d)] for i in range(d)]


def test_fit_and_whiten(spark):
    rng = random.Random(4)
    points = [[rng.randint(-300, 300) * (1 + i) + 10**6 for i in range(6)] for _ in range(500)]
    points += points[:20]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "vec_id long, point array<long>").repartition(7)
    model = fit(frame, components=4)
    n, sums, v = exact(points)
    assert (model.n, model.sums) == (n, sums)
    assert math.isclose(model.trace, float(Fraction(sum(v[i][i] for i in range(6)), n * n)), rel_tol=1e-15)
    values, vectors = np.linalg.eigh(np.array([[float(Fraction(x, n * n)) for x in r] for r in v]))
    assert np.allclose(model.eigenvalues, values[::-1][:4], rtol=1e-13)
    out = {r.vec_id: r for r in whiten(frame, model).withColumn("deviation", squared_deviation("point", model)).collect()}
    y = np.array([[float(Fraction(n * p[i] - sums[i], n)) for i in range(6)] for p in points])
    want = y @ vectors[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    for i, p in enumerate(points):
        assert np.allclose(np.abs(out[i].whitened), np.abs(want[i]), atol=1e-11)
        assert out[i].deviation == sum((n * p[k] - sums[k]) ** 2 for k in range(6))
    assert identity_error(whiten(frame, model), "whitened", 4) < 1e-12
    again = fit(frame.repartition(3), components=4)
    assert (again.sums, again.trace) == (model.sums, model.trace) and (again.components == model.components).all()


def test_large_entries(spark):
    """Products that leave a long stay exact; a deviation that leaves one is null."""
    rng = random.Random(5)
    points = [[rng.randint(-(2**60), 2**60) for _ in range(3)] for _ in range(60)]
    frame = spark.createDataFrame([(p,) for p in points], "point array<long>")
    model = fit(frame, components=3)
    n, sums, v = exact(points)
    assert model.sums == sums and math.isclose(model.trace, float(Fraction(sum(v[i][i] for i in range(3)), n * n)), rel_tol=1e-15)
    assert {r[0] for r in frame.select(squared_deviation("point", model)).collect()} == {None}


def test_fixed_point_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, -0.01]), (2, None), (3, []), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [1.0, -inf]), (7, [1e30, 0.0]),
        (8, [1.0, 2.0, 3.0]), (None, [0.25, 0.75]), (1, [0.5, -0.01]),
    ]
    frame = spark.createDataFrame([(d, v, "x") for d, v in rows], "vec_id long, embedding array<float>, whitened string")
    got = sorted(((r.vec_id, r.point) for r in fixed_point(frame, "embedding", 64, 1000).collect()), key=repr)
    assert got == sorted([(1, [1032, 999]), (1, [1032, 999]), (None, [1016, 1048])], key=repr)
    assert fixed_point(frame.where("vec_id = 2"), "embedding").count() == 0
    assert fit(fixed_point(frame.where("vec_id = 2"), "embedding")) is None


def test_few_dimensions(spark):
    """Equal vectors have no component; those on a line have one."""
    same = spark.createDataFrame([([5, 7],)] * 3, "point array<long>")
    model = fit(same)
    assert len(model.eigenvalues) == 0 and [r.whitened for r in whiten(same, model).collect()] == [[]] * 3
    line = spark.createDataFrame([([k, 2 * k, 3 * k],) for k in range(10)], "point array<long>")
    model = fit(line)
    assert len(model.eigenvalues) == 1 and identity_error(whiten(line, model), "whitened", 1) < 1e-14


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables absent")
def test_query(spark):
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    points = {d: [math.floor(64 * c) + 10**6 for c in v] for d, v in table}
    n, sums, v = exact(list(points.values()))
    values, vectors = np.linalg.eigh(np.array([[float(Fraction(x, n * n)) for x in r] for r in v]))
    values, vectors = values[::-1], vectors[:, ::-1]
    got = {}
    for r in suite.queries()["op12_whitening"](spark, SF_DIR).collect():
        assert r.n == n and r.identity_error <= 1e-10
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-10)
        assert r.deviation == sum((n * x - s) ** 2 for x, s in zip(points[r.vec_id], sums))
        got[r.vec_id, r.component] = r.whitened
    assert sorted(got) == [(d, k) for d in sorted(points) for k in range(1, 33)]
    y = np.array([[float(Fraction(n * x - s, n)) for x, s in zip(points[d], sums)] for d in sorted(points)])
    want = y @ vectors[:, :32] / np.sqrt(values[:32])
    have = np.array([[got[d, k] for k in range(1, 33)] for d in sorted(points)])
    assert np.allclose(have * np.sign((have * want).sum(axis=0)), want, atol=1e-9)


def test_empty_query(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert suite.queries()["op12_whitening"](spark, str(tmp_path)).count() == 0


def test_limit_bits():
    assert whitening.LIMB_BITS * 2 < 53
