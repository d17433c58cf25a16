"""Exact cross-products against Python's numbers, whitening against numpy on the same vectors."""

import math
import random

import numpy as np
import pytest

from deposit_analytics.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x int, size string, component int"


def run(spark, rows):
    frame = spark.createDataFrame([(*row, 1, "s", 2) for row in rows], SCHEMA)
    return whitening.whiten(frame).collect()


def whole(vector):
    if vector is None or any(one is None or not math.isfinite(one) for one in vector):
        return None
    return tuple(math.floor(256 * one) for one in vector)


def check(got, rows, rank=4):
    """All rows of one length against sums in whole numbers and numpy's eigenvalues."""
    kept = [(vec_id, whole(vector)) for vec_id, vector in rows if whole(vector) is not None]
    fit = sorted({x for _, x in kept})
    n, size = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(size)]
    centred = np.array([[float(one - total / n) for one, total in zip(x, sums, strict=True)] for x in fit])
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1][:rank]
    assert len(got) == len(kept) * rank
    assert {row.n for row in got} == {n}
    deviation = {x: sum((n * one - total) ** 2 for one, total in zip(x, sums, strict=True)) for x in fit}
    want = sorted((-1 if vec_id is None else vec_id, deviation[x]) for vec_id, x in kept for _ in range(rank))
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.deviation) for r in got) == want
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(covariance), rel=1e-6)
        assert r.identity_error <= 1e-4
    # Distances in the whitened space do not depend on signs.
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r.whitened
    vectors = np.linalg.eigh(covariance)[1][:, ::-1][:, :rank]
    for vec_id, x in kept:
        plain = (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values)
        mine = np.array([by_id[vec_id][k + 1] for k in range(rank)])
        assert np.abs(plain) == pytest.approx(np.abs(mine), rel=1e-5, abs=1e-6)


@pytest.mark.parametrize("most", [1, 300, 1 << 30, 1 << 62])
def test_cross_products_are_exact(most):
    rng = random.Random(most)
    rows = [[rng.randrange(-most, most + 1) for _ in range(5)] + [7] for _ in range(130)]
    want = [[sum(row[i] * row[j] for row in rows) for j in range(6)] for i in range(6)]
    assert whitening.cross_products(np.array(rows, np.int64)) == want


def test_whitened_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(1)
    scales = np.array([4, 2, 1, 0.5, 0.1, 0.05])
    rows = [(k, [float(one) for one in rng.standard_normal(6) * scales]) for k in range(200)]
    rows += [(200 + k, rows[0][1]) for k in range(150)]
    check(run(spark, rows), rows)


def test_embeddings(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    check(whitening.whiten(frame).collect(), [(r.vec_id, r.embedding) for r in frame.collect()])


def test_directions_of_very_different_scales(spark):
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((3, 3)))[0]
    rows = []
    for k in range(120):
        small = turn @ (rng.standard_normal(3) * [3, 2, 1])
        rows.append((k, [float(rng.standard_normal() * 1e9), *map(float, small)]))
    got = run(spark, rows)
    assert len(got) == 480
    assert max(r.identity_error for r in got) <= 1e-4
    assert [r.component for r in got if r.vec_id == 0] == [1, 2, 3, 4]
    shares = [r.explained for r in got if r.vec_id == 0]
    x = np.array([whole(vector) for _, vector in rows], float)
    values = sorted(np.linalg.eigvalsh(np.cov(x[:, 1:].T, bias=True)), reverse=True)
    trace = np.trace(np.cov(x.T, bias=True))
    # The large direction takes from the small ones what it shares with them, at most.
    assert all(a <= b / trace * (1 + 1e-6) for a, b in zip(shares[1:], values, strict=True))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0, 0.5]), (2, [-0.0, 1.0, 0.5]), (None, [2.0, 1.0, 0.5]), (3, [1.0, -1.0, 0.5]), (3, [1.0, -1.0, 0.5]), (4, [0.001, 0.25, 0.5]),
            (5, None), (6, [None, 1.0, 1.0]), (7, [nan, 1.0, 1.0]), (8, [inf, 0.0, 0.0]), (9, [])]
    good = [one for one in rows if one[1]]
    got = run(spark, [*rows, (10, [1e300, 0.0, 0.0])])
    assert sorted({r.component for r in got}) == [1, 2]
    check(got, good, rank=2)
    # Lengths are fitted for themselves, and without variance there is no component.
    more = run(spark, [*rows, (11, [1.0, 2.0]), (12, [3.0, 2.0]), (13, [1.0])])
    assert {(r.vec_id, r.component, r.n) for r in more if (r.vec_id or 0) > 10} == {(11, 1, 2), (12, 1, 2)}
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert run(spark, []) == []


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(1, [2.0**50, 0.0]), (2, [-(2.0**50), 3.0])]
    got = run(spark, rows)
    assert [r.deviation for r in got] == [None, None]
    assert [abs(r.whitened) for r in got] == pytest.approx([1, 1])
