import random

import pytest

import brute
from deposit_analytics.llm import chosen_path


def table(spark, rows):
    return spark.createDataFrame([(*row, 1, "n") for row in rows], "doc_id long, text string, n_links int, node string")


def variants(seed, many=60):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 40, 120]))] for _ in range(many // 6)]
    rows = []
    for k in range(many):
        tokens = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            tokens[rng.randrange(len(tokens))] = f"x{rng.randrange(50)}"
        rows.append((k, " ".join(tokens)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_groups_equal_comparing_all_pairs(spark, seed, monkeypatch):
    # Small limits, so that nodes are split and compared in blocks.
    if seed:
        monkeypatch.setattr(chosen_path, "SMALL", 4)
        monkeypatch.setattr(chosen_path, "BLOCK", 3)
    rows = variants(seed)
    got = sorted(map(tuple, chosen_path.near_groups(table(spark, rows)).collect()))
    assert got == sorted(brute.near_groups(rows))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute.near_groups(rows)
    assert sorted(map(tuple, chosen_path.near_groups(docs).collect())) == sorted(want)
    kept = chosen_path.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(doc_id for doc_id, _, first in want if doc_id == first)


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(30000))
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (3, "a  b c\nd e f"), (1, None), (2, ""), (4, " \t"), (7, "one"),
            (6, "one"), (8, long), (9, long + " x"), (9, long + " x"), (10, "é ü"), (11, "é ü x y z")]
    got = sorted(map(tuple, chosen_path.near_groups(table(spark, rows)).collect()), key=str)
    assert got == sorted(brute.near_groups(rows), key=str)
    docs = table(spark, rows)
    assert sorted((r.doc_id for r in chosen_path.without_copies(docs).collect()), key=str) == sorted(
        [3, 1, 2, 4, 6, 8, 10, 11], key=str
    )
    assert chosen_path.near_groups(docs.limit(0)).count() == 0
    assert chosen_path.without_copies(docs.limit(0)).count() == 0


def test_rows_are_told_apart_by_id_and_text(spark):
    def kept(rows):
        return sorted(((r.doc_id, r.text) for r in chosen_path.without_copies(table(spark, rows)).collect()), key=str)

    a, b = "a b c d e f g", "p q r s t u v"
    assert kept([(3, b), (5, b), (5, a), (7, a)]) == [(3, b), (5, a)]
    # Without ids too, one row of each class stays; of rows that are alike, one.
    assert kept([(None, a), (None, a), (None, b), (2, b)]) == sorted([(None, a), (2, b)], key=str)
    assert kept([(1, a), (1, a), (1, b), (1, b), (1, None), (1, None), (1, "")]) == sorted([(1, a), (1, b), (1, None), (1, None), (1, "")], key=str)


def test_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5), (2, "a b", "y", 6)], "doc_id long, text string, row string, first int")
    assert [tuple(r) for r in chosen_path.without_copies(docs).collect()] == [(1, "a b", "x", 5)]


def edited(rng, base, edits):
    words = list(base)
    for place in rng.sample(range(len(words)), edits):
        words[place] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


def test_a_hot_group_equals_comparing_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "DENSE", 20)
    monkeypatch.setattr(chosen_path, "BLOCK", 64)
    rng = random.Random(5)
    base, other = ([f"{name}{k}" for k in range(120)] for name in "ab")
    texts = [edited(rng, base, rng.choice([0, 1, 1, 2, 2, 3])) for _ in range(160)]
    texts += [edited(rng, other, rng.choice([1, 2])) for _ in range(60)]
    # Some at the border of the group, some that share a passage, some alone.
    texts += [edited(rng, base, 6) for _ in range(20)] + [" ".join(base[:30] + [f"y{k}_{i}" for i in range(90)]) for k in range(30)]
    texts += [" ".join(f"z{k}_{i}" for i in range(30)) for k in range(30)] + texts[:5]
    rows = list(enumerate(texts))
    want = brute.near_groups(rows)
    got = sorted(map(tuple, chosen_path.near_groups(table(spark, rows)).collect()))
    assert abs(sum(one[1] for one in got) - sum(one[1] for one in want)) <= 0.002 * sum(one[1] for one in want)
    assert [one[::2] for one in got] == [one[::2] for one in sorted(want)]


def test_near_copies_leave_the_search(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "DENSE", 20)
    rng = random.Random(6)
    base = [f"a{k}" for k in range(120)]
    rows = [(k, edited(rng, base, rng.choice([0, 1, 2]))) for k in range(200)]
    batches = table(spark, rows).selectExpr("doc_id", "text", "0L AS row")
    sets = batches.mapInArrow(lambda b: chosen_path._sets(b, 5), "doc_id long, row long, set_id long, n long, signature binary")
    classes = sets.dropDuplicates(["set_id"])
    nodes, taken = chosen_path._dense(classes, chosen_path.least_agreeing())
    # One node holds them all, and none is sent on by the runs.
    assert taken.count() >= 0.95 * classes.count()
    assert nodes.count() == classes.count()
    assert chosen_path._dense(classes.limit(10), chosen_path.least_agreeing()) is None


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.8, 0.95])
def test_recall_at_other_thresholds(spark, threshold):
    rng = random.Random(int(100 * threshold))
    rows = []
    for k in range(60):
        words = [f"w{k}_{i}" for i in range(104)]
        # One cut from the end: so many of 100 shingles stay, and no others come.
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[: round(100 * threshold) + rng.randrange(3) + 4]))]
    want = brute.near_groups(rows, threshold)
    got = sorted(map(tuple, chosen_path.near_groups(table(spark, rows), threshold=threshold).collect()))
    assert sum(one[1] for one in want) == 120
    assert sum(one[1] for one in got) >= 0.99 * 120


def test_runs_reach_the_recall():
    assert chosen_path.runs_needed(0.8, 0.999) >= chosen_path.runs_needed(0.8, 0.99) >= 1
    assert chosen_path.runs_needed() == 16
    assert chosen_path.least_agreeing() == 39
    # A pair at the threshold, over many drawn signatures.
    rng = random.Random(1)
    for threshold in (0.5, 0.8):
        least = chosen_path.least_agreeing(threshold)
        low = sum(sum(rng.random() < threshold for _ in range(64)) < least for _ in range(20000))
        assert low <= 20
