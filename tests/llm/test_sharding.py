import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import brute
from deposit_analytics.llm import sharding


def run(spark, rows, shards=8):
    docs = spark.createDataFrame([(*row, "x", 7) for row in rows], "doc_id long, text string, shard string, key int")
    text = F.col("text")
    return sharding.assign(docs, sharding.text_key(text), sharding.text_size(text), shards).select(
        "doc.doc_id", "doc.text", "size", "shard", "slot"
    ).collect()


def check(out, rows, shards=8):
    assert Counter((r.doc_id, r.text) for r in out) == Counter(rows)
    sizes = Counter()
    for _, text in rows:
        sizes[brute.text_key(text)] += len((text or "").encode()) + 1
    keys = sorted(sizes)
    _, numbers = brute.greedy_shards([sizes[key] for key in keys], shards)
    want = dict(zip(keys, numbers or [], strict=True))
    assert all(r.shard == want[brute.text_key(r.text)] for r in out)
    for number, slots in brute.grouped((r.shard, r.slot) for r in out).items():
        assert sorted(slots) == list(range(len(slots))), number


@pytest.mark.parametrize("seed", range(2))
def test_least_capacity_as_by_the_plain_version(spark, seed, monkeypatch):
    # Few first ranges, so that ranges must be split several times.
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)
    monkeypatch.setattr(sharding, "MORE_BITS", 1)
    rng = random.Random(seed)
    rows = [(k, rng.choice(["hot" * 50, f"t{k}" * rng.randrange(1, 60), f"u{k % 9}"])) for k in range(400)]
    check(run(spark, rows), rows)


def test_bounds_equal_the_plain_search(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 4)
    rng = random.Random(5)
    for many in (1, 3, 50, 2000):
        rows = sorted({rng.getrandbits(60): rng.randrange(1, 200) for _ in range(many)}.items())
        groups = spark.createDataFrame(rows, "key long, size long")
        capacity, starts = sharding.bounds(groups)
        least, numbers = brute.greedy_shards([size for _, size in rows])
        assert capacity == max(least, -(-sum(size for _, size in rows) // 8))
        got = [sum(key >= start for start in starts) for key, _ in rows]
        assert got == numbers


def test_query(spark):
    out = entry.queries()["op8_contiguous_shards"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r.doc_id for r in out} == set(texts)
    for r in out:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    for same in brute.grouped((texts[r.doc_id], r.shard) for r in out).values():
        assert len(set(same)) == 1


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (1, ""), (2, None), (3, "é" * 1000), (4, "a"), (4, "a")]
    check(run(spark, rows), rows)
    assert run(spark, []) == []
