"""Whitening against exact fractions and numpy; the polynomial against a plain expansion; ties and odd rows."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tellake.llm import queries, whitening

D = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def integers(v):
    return [math.floor(64 * float(c)) + 1_000_000 for c in v]


def check(rows, fitted, most=32):
    """Every column of a result against exact integers and numpy's eigenvectors."""
    xs = [integers(v) for _, v in fitted]
    n, d = len(xs), len(xs[0])
    s = [sum(c) for c in zip(*xs)]
    y = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(x, s)] for x in xs])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(most, int((values > 1e-9 * values[0]).sum()))
    by = {}
    for r in rows:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    assert len(rows) == n * count
    whitened = np.array([[by[i, sum((n * a - b) ** 2 for a, b in zip(x, s))][k + 1].whitened for k in range(count)] for (i, _), x in zip(fitted, xs)])
    assert np.abs(whitened.T @ whitened / n - np.eye(count)).max() < 1e-10 and rows[0].identity_error < 1e-10
    for k in range(count):
        part = rows[0].explained if k + 1 == rows[0].component else next(r.explained for r in rows if r.component == k + 1)
        assert math.isclose(part, values[k] / values.sum(), rel_tol=1e-9)
        alone = all(abs(values[k] - v) > 1e-6 * values[0] for j, v in enumerate(values) if j != k)
        if alone:
            want = y @ vectors[:, k] / math.sqrt(values[k])
            assert min(np.abs(whitened[:, k] - want).max(), np.abs(whitened[:, k] + want).max()) < 1e-7
    assert {r.n for r in rows} == {n}


def test_query_against_numpy(spark):
    fitted = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{D}/embeddings.parquet").collect()]
    rows = queries.op13_whitening(spark, D).collect()
    check(rows, fitted)
    assert max(r.component for r in rows) == 32


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(k if k % 7 else None, [float(v) for v in rng.normal(50, 3, 5).astype(np.float32)]) for k in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [float("nan")] * 5), (104, [1.0, float("inf"), 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [1e30] * 5)]
    df = spark.createDataFrame(good + bad + good[:4], SCHEMA).selectExpr("*", "1 AS n", "'x' AS component", "2 AS `a.b`")
    check(whitening.whiten(df).collect(), good + good[:4])
    few = whitening.whiten(df, most=2)
    assert {r.component for r in few.collect()} == {1, 2} and [f.name for f in few.schema] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], good[:1], good[:1] * 5, bad):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_equal_and_zero_eigenvalues(spark):
    """A square of points: two equal eigenvalues, a dimension without spread and one that repeats another."""
    points = [(k, [a, b, 7.0, 0.0, 0.0]) for k, (a, b) in enumerate([(1.0, 1.0), (1.0, -1.0), (-1.0, 1.0), (-1.0, -1.0)])]
    rows = whitening.whiten(spark.createDataFrame(points, SCHEMA)).collect()
    assert len(rows) == 8 and all(math.isclose(r.explained, 0.5) for r in rows)
    check(rows, points)
    twice = [(k, [v[0], v[0], 3 * v[1]]) for k, v in points]
    check(whitening.whiten(spark.createDataFrame(twice, SCHEMA)).collect(), twice)


def test_wide_integers_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(np.float32(v)) for v in rng.normal(0, 1, 3) * [1e12, 1e3, 1.0]]) for k in range(30)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    xs = [integers(v) for _, v in rows]
    s = [sum(c) for c in zip(*xs)]
    want = {k: sum((30 * a - b) ** 2 for a, b in zip(x, s)) for (k, _), x in zip(rows, xs)}
    assert all(r.deviation == (want[r.vec_id] if want[r.vec_id] < 1 << 63 else None) for r in got)
    assert all(r.identity_error < 1e-6 for r in got) and len(got) == 90
    y = np.array([[a + (1 << 40) for a in x] for x in xs], np.int64)
    assert (whitening.exact_gram(y) == sum(np.outer(v.astype(object), v.astype(object)) for v in y)).all()


@pytest.mark.parametrize("d", [1, 2, 3, 7])
def test_polynomial(spark, d):
    """Coefficients against power sums of traces, in fractions; counts of roots against numpy."""
    rng = np.random.default_rng(d)
    a = rng.integers(-9, 10, (d, 4 if d == 7 else d))  # the last is of rank 4
    m = [[int(v) for v in row] for row in a @ a.T]
    powers, p = [], np.eye(d, dtype=object)
    for _ in range(d):
        p = p.dot(np.array(m, object))
        powers.append(int(np.trace(p)))
    c = [Fraction(1)]
    for k in range(1, d + 1):
        c.append(-sum(c[k - i] * powers[i - 1] for i in range(1, k + 1)) / k)
    poly = whitening.characteristic_polynomial(spark, m)
    assert poly == [int(v) for v in c]
    values = np.linalg.eigvalsh(np.array(m, float))
    for point in (0, 1, 37, 100):
        near = np.abs(values - point).min() < 1e-6
        assert near or whitening.roots_above(poly, point, 0) == int((values > point).sum())


def test_primes():
    small = [p for p in range(2, 2000) if all(p % q for q in range(2, int(p**0.5) + 1))]
    assert [p for p in range(2000) if whitening.is_prime(p)] == small
    assert whitening.primes_above(1 << 100)[0] == (1 << 31) - 1
