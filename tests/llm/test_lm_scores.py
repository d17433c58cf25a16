import random

import numpy as np
import pytest

import brute
from deposit_analytics.llm import lm_scores

SCHEMA = "doc_id long, text string, n_words string, part int"


def run(spark, rows, **options):
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA)
    return [(r.doc_id, r.n_words, round(r.log_score, 6)) for r in lm_scores.score(docs, **options).collect()]


def want(rows, **options):
    return sorted(((d, n, round(s, 6)) for d, n, s in brute.backoff_scores(rows, **options)), key=str)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_the_plain_version(spark, order, monkeypatch):
    # Small chunks and parts, so that counts meet from many of them.
    monkeypatch.setattr(lm_scores, "CHUNK_BYTES", 500)
    monkeypatch.setattr(lm_scores, "PART_GRAMS", 300)
    rng = random.Random(order)
    rows = [(k, " ".join(f"w{int(rng.expovariate(0.1))}" for _ in range(rng.randrange(40)))) for k in range(120)]
    rows += rows[:10]
    assert sorted(run(spark, rows, order=order), key=str) == want(rows, order=order)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.log_score for r in lm_scores.score(docs).collect()}
    for doc_id, _, score in brute.backoff_scores(rows):
        assert abs(got[doc_id] - score) <= 1e-6 * max(1, abs(score))


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (4, "a b a b"), (4, "a b a b"), (None, "b a"), (5, "zz  yy\nb"), (6, "a " * 20000)]
    assert sorted(run(spark, rows), key=str) == want(rows)
    assert run(spark, []) == []
    means = lm_scores.score(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()
    assert (means.mean_score, means.backed_off) == (None, None)


def test_hashes_come_back_whole():
    rng = np.random.default_rng(6)
    every = rng.integers(0, 1 << 64, 5000, dtype=np.uint64, endpoint=False)
    edges = np.array([0, 1, 1 << 40, (1 << 40) - 1, (1 << 64) - 1], np.uint64)
    for hashes in (np.unique(np.concatenate([every, edges])), edges[:1], edges[-1:], edges[:0]):
        hashes = np.sort(hashes)
        assert (lm_scores._unpacked(lm_scores._packed(hashes), len(hashes)) == hashes).all()
        assert (lm_scores._numbers(lm_scores._planes(hashes), len(hashes)) == hashes).all()
