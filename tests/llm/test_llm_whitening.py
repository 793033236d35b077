import numpy as np
import pytest
from llm_frames import empty
from pyspark.sql import functions as F

from tablewright.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component string, key string, n long"


def brute(rows, components=4):
    """Whole integers, a covariance of Python's integers, eigenvectors of another method."""
    used = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v, *_ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    lists = sorted({tuple(x) for _, x in used})
    n, size = len(lists), len(lists[0])
    sums = [sum(x[d] for x in lists) for d in range(size)]
    far = np.array([[n * v - s for v, s in zip(x, sums, strict=True)] for x in lists], float) / n
    values, vectors = np.linalg.eigh(far.T @ far / n)
    order = np.argsort(-values)[:components]
    out = {}
    for i, x in used:
        own = np.array([n * v - s for v, s in zip(x, sums, strict=True)], float) / n
        for k, at in enumerate(order, 1):
            out[i, k] = (n, sum((n * v - s) ** 2 for v, s in zip(x, sums, strict=True)), own @ vectors[:, at] / np.sqrt(values[at]), values[at] / values.sum())
    return out


def check(frame, rows):
    got, want = whitening.whiten(frame).collect(), brute(rows)
    assert len(got) == sum(1 for i, v, *_ in rows for k in range(1, 5) if (i, k) in want and v is not None)
    signs = {}
    for row in got:
        n, deviation, white, share = want[row.key, row.component]
        assert (row.n, int(row.deviation)) == (n, deviation)
        assert row.explained == pytest.approx(share, rel=1e-9)
        assert abs(row.whitened) == pytest.approx(abs(white), rel=1e-7, abs=1e-7)
        if abs(white) > 1e-6:
            signs.setdefault(row.component, set()).add(np.sign(row.whitened) == np.sign(white))
        assert row.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 12)) @ np.diag(np.linspace(2, 0.5, 12)) + 3
    vectors[40:90] = vectors[40]  # copies count once
    rows = [(k, [float(x) for x in np.float32(vectors[k])], "x", "y", 1) for k in range(300)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(7), rows)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0, 0.5], "x", None, 1), (1, [-1.0, 0.25, 7.0], "x", "k", 1), (2, None, "x", "k", 1), (3, [float("nan"), 1.0, 0.0], "x", "k", 1),
        (4, [None, 1.0, 0.0], "x", "k", 1), (5, [3.0, -2.0, 0.125], "x", "k", 1), (None, [0.0, -0.0, 1.0], "x", "k", 1), (7, [float("inf"), 0.0, 0.0], "x", "k", 1),
        (8, [2.0, 2.0, 2.0], "x", "k", 1), (8, [2.0, 2.0, 2.0], "x", "k", 1),
    ]
    rows_of_3 = spark.createDataFrame(rows, SCHEMA)
    got = whitening.whiten(rows_of_3)
    assert {(r.key, r.component) for r in got.collect()} == {(k, c) for k in (0, 1, 5, 8, None) for c in (1, 2, 3)}
    assert got.where("key = 8").count() == 6
    # another length is a space of its own; one vector alone has no component
    more = spark.createDataFrame([(20, [1.0], "x", "k", 1), (21, [2.0], "x", "k", 1), (22, [], "x", "k", 1), (23, [1.0] * 5, "x", "k", 1)], SCHEMA)
    both = {(r.key, r.component, r.n) for r in whitening.whiten(rows_of_3.unionByName(more)).collect()}
    assert {x for x in both if x[0] and x[0] >= 20} == {(20, 1, 2), (21, 1, 2)}
    assert {x[2] for x in both if x[0] is None or x[0] < 20} == {5}


def test_no_rows(spark):
    assert whitening.whiten(empty(spark, SCHEMA)).collect() == []
    same = spark.createDataFrame([(k, [1.0, 2.0], "x", "y", 1) for k in range(5)], SCHEMA)
    assert whitening.whiten(same).collect() == []


def test_deviation_beyond_doubles_is_exact(spark):
    rows = [(k, [float(k * 2**26), float(5 * k * k - 2**28)], "x", "y", 1) for k in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("embedding", F.col("embedding").cast("array<double>"))
    exact = [(i, [float(np.float32(x)) for x in v]) for i, v, *_ in rows]
    want = brute(exact, 2)
    got = {(r.key, r.component): int(r.deviation) for r in whitening.whiten(frame).collect()}
    assert got == {k: v[1] for k, v in want.items()}
    assert max(got.values()) > 2**63


@pytest.mark.parametrize("spectrum", [
    [9, 4, 3, 1, 0.5, 0.2], [5, 5, 5, 1, 1, 1], [1, 1, 1, 1, 1, 1], [7, 7 - 1e-9, 2, 2 - 1e-13, 1, 0], [1e12, 1, 1e-3, 0, 0, 0], [3, 0, 0, 0, 0, 0],
])
def test_spectrum(spectrum):
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    matrix = turn @ np.diag(spectrum) @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading(matrix, 4)
    wanted = sum(x > 1e-14 * sum(spectrum) for x in spectrum[:4])
    assert len(values) == wanted
    np.testing.assert_allclose(values, spectrum[:wanted], rtol=1e-9, atol=1e-13 * sum(spectrum))
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(wanted), atol=1e-12)
    np.testing.assert_allclose(matrix @ vectors, vectors * values, atol=1e-11 * max(spectrum))


def test_counts_are_those_of_eigenvalues():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 20, 64):
        a = rng.normal(size=(size, size))
        a = a + a.T
        a[rng.random((size, size)) < 0.3] = 0
        a = np.tril(a) + np.tril(a, -1).T
        for shift in (-2.0, 0.0, 0.1, 3.0):
            assert whitening.negative_pivots(a - shift * np.eye(size)) == (np.linalg.eigvalsh(a) < shift).sum()
