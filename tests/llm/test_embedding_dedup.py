import random

import numpy as np
import pytest

import brute
from deposit_analytics.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<double>, node string, kept int"


def unit(x):
    x = x / np.abs(x).max()
    return x / np.linalg.norm(x)


def plain(rows):
    good = [
        (k, np.array(x, float))
        for k, (v, x) in enumerate(rows)
        if v is not None and x and all(one is not None and np.isfinite(one) for one in x) and any(x)
    ]
    groups, links = brute.Groups(range(len(rows))), [0] * len(rows)
    for at, (a, x) in enumerate(good):
        for b, y in good[at + 1 :]:
            if len(x) == len(y) and unit(x) @ unit(y) >= 0.95:
                links[a] += 1
                links[b] += 1
                groups.tie(a, b)
    least = {}
    for k, _ in good:
        root = groups.find(k)
        least[root] = min(least.get(root, rows[k][0]), rows[k][0])
    out = []
    for k, (vec_id, _) in enumerate(rows):
        component = least.get(groups.find(k), vec_id)
        out.append((vec_id, links[k], component, vec_id is not None and vec_id == component))
    return sorted(out, key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(v, x, "n", 1) for v, x in rows], SCHEMA)
    return sorted(map(tuple, embedding_dedup.near_vectors(frame).collect()), key=str)


@pytest.mark.parametrize("block", [1024, 7])
def test_links_equal_comparing_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "CELL", 32)
    rng = np.random.default_rng(block)
    centres = rng.standard_normal((12, 16))
    rows = []
    for k in range(220):
        x = centres[rng.integers(12)] + rng.standard_normal(16) * rng.choice([0, 0.02, 0.1, 0.25, 1.0])
        rows.append((k, [float(np.float32(one)) for one in x]))
    got, want = run(spark, rows), plain(rows)
    # Pairs right at the threshold may be missed one time in a thousand.
    assert sum(one[1] for one in got) >= 0.995 * sum(one[1] for one in want)
    assert [one[0] for one in got] == [one[0] for one in want]


def test_embeddings(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got = sorted(map(tuple, embedding_dedup.near_vectors(frame).collect()), key=str)
    assert got == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, 0.125]),
            (None, [1.0, 0.0]), (8, [1.0, 0.0]), (8, [0.0, 1.0]), (9, []), (10, [1.0, 0.0, 0.0]), (11, [-inf, 1.0]), (12, [1.0, 0.375])]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []


def test_counts_are_calibrated():
    rng = random.Random(1)
    needed = embedding_dedup.least_count(0.999)
    reached = 0
    for _ in range(2000):
        hits = sum(abs(rng.gauss(0, 1)) <= embedding_dedup.REACH for _ in range(embedding_dedup.LINES))
        reached += hits >= needed
    assert reached >= 0.995 * 2000
    assert embedding_dedup.deals_for(8, 0.95, 0.999) == 13


def test_very_large_and_very_small_numbers(spark):
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2.1e200]), (3, [1e-200, 1e-200]), (4, [1.0, 1.0]), (5, [5e-324, 0.0]), (6, [1e308, 0.0]),
            (7, [1e308, -1e308]), (8, [1e-300, -1e-300]), (9, [0.0, -1.0])]
    got = run(spark, rows)
    assert got == plain(rows)
    assert [row[1] for row in got] == [3, 3, 3, 3, 1, 1, 1, 1, 0]


@pytest.mark.parametrize("needed", [0, 5, 25, 32])
def test_pairs_collide_as_often_as_windows_say(needed):
    rng = np.random.default_rng(needed)
    left, right = rng.standard_normal((40, 6)), rng.standard_normal((60, 6))
    lines = embedding_dedup._lines(embedding_dedup.LINES, 6, 1)
    counts = (np.abs((left @ lines)[:, None, :] - (right @ lines)[None, :, :]) <= 1.5).sum(axis=2)
    i, j = embedding_dedup.collided(left, right, 1.5, needed)
    want = {(a, b) for a, b in zip(*np.nonzero((counts >= needed) & (counts > 0)), strict=True)}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) >= {(int(a), int(b)) for a, b in want}
    assert all(counts[a, b] >= needed for a, b in zip(i, j, strict=True))
    assert len(i) == len(set(zip(i.tolist(), j.tolist(), strict=True)))
    assert len(embedding_dedup.collided(left[:0], right, 1.5, needed)[0]) == 0


def test_recall_at_the_threshold(spark):
    """Pairs whose cosine is just above the threshold, the hardest to find."""
    rng = np.random.default_rng(9)
    rows = []
    for k in range(400):
        x = rng.standard_normal(24)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(24)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        rows += [(2 * k, x.tolist()), (2 * k + 1, (0.9505 * x + np.sqrt(1 - 0.9505**2) * y).tolist())]
    got, want = run(spark, rows), plain(rows)
    assert sum(one[1] for one in want) >= 800
    assert sum(one[1] for one in got) >= 0.99 * sum(one[1] for one in want)
