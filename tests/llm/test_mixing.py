import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
import check_oracle
from deposit_analytics.llm import mixing
from deposit_analytics.llm.common import word_count

SCHEMA = "doc_id long, source string, text string, size string, target int, label string"


def run(spark, rows):
    docs = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], SCHEMA)
    return mixing.mix(docs, word_count(F.col("text")))


def test_query_equals_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        same, note = check_oracle.compare(spark, check_oracle.connect(sf), sf, "op1_source_mix")
        assert same, note


@pytest.mark.parametrize("seed", range(3))
def test_mix_equals_the_plain_version(spark, seed):
    rng = random.Random(seed)
    sources = [None, "a", "b", "é", "z", ""]
    rows = [(k, rng.choice(sources[: 2 + 2 * seed]), "w " * rng.choice([0, 1, 5, 40, 300])) for k in range(80)]
    got = [(r.doc_id, r.size, r.taken, r.copies) for r in run(spark, rows).select("doc.doc_id", "size", "taken", "copies").collect()]
    assert sorted(got) == sorted(brute.mix(rows))


def test_targets_are_met_and_bounded(spark):
    rows = [(k, "hot" if k % 3 else f"s{k % 7}", "w " * (k % 50)) for k in range(300)]
    out = run(spark, rows).select("doc.source", "size", "source_size", "target", "taken").collect()
    taken = Counter()
    for row in out:
        assert row.taken <= 3 * row.size
        assert row.target <= 3 * row.source_size + 1e-6
        taken[row.source] += row.taken
    for row in out:
        assert abs(taken[row.source] - row.target) <= 0.5 + 1e-6
    assert abs(sum(taken.values()) - sum(row.size for row in out)) <= len(taken)


def test_nulls_empty_texts_and_repeated_rows(spark):
    rows = [(None, None, None), (1, None, ""), (1, "a", "x y"), (1, "a", "x y"), (2, "a", " \t\n"), (3, "b", "q " * 50)]
    out = run(spark, rows).select("doc.*", "taken", "copies").collect()
    assert len(out) == len(rows)
    assert all(row.label == "y" for row in out)
    assert [row.taken for row in out if row.source is None] == [0, 0]


def test_empty_table_and_whole_copies(spark):
    assert run(spark, []).count() == 0
    rows = [(k, f"s{k % 3}", "w " * (1 + k % 9)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    whole = mixing.mixed(docs, word_count(F.col("text")))
    assert whole.columns == docs.columns
    assert Counter(r.doc_id for r in whole.collect()) == Counter(
        {doc_id: copies for doc_id, _, _, copies in brute.mix(rows) if copies}
    )
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, mixing.mixed(docs, word_count(F.col("text"))).collect()))
