import random

import pytest

import brute
from deposit_analytics.llm import decontamination

SF = "/root/testdata/sf0.001"


def run(spark, rows, items):
    docs = spark.createDataFrame([(*row, 1.0, 2) for row in rows], "doc_id long, text string, similarity double, item int")
    bench = spark.createDataFrame([(*item, "t") for item in items], "item_id long, text string, doc_id string")
    return {(r.doc_id, r.item_id): round(r.similarity, 6) for r in decontamination.contained_items(docs, bench).collect()}


def want(rows, items):
    return {pair: round(share, 6) for pair, share in brute.leaks(rows, items).items()}


@pytest.mark.parametrize("many", [1, 3, 6, 17, 40, 90])
def test_items_at_any_place_and_with_edits(spark, many):
    rng = random.Random(many)
    items = [(k, " ".join(f"i{k}w{rng.randrange(60)}" for _ in range(many + k))) for k in range(4)]
    rows = []
    for k in range(60):
        _, text = rng.choice(items)
        tokens = text.split()
        if k % 3 == 0:
            tokens[rng.randrange(len(tokens))] = "edit"
        before = [f"f{rng.randrange(500)}" for _ in range(rng.choice([0, 1, 2, 3, 9, 30, 4090]))]
        after = [f"f{rng.randrange(500)}" for _ in range(rng.randrange(20))] if many > 4 else []
        rows.append((k, " ".join((before if many > 4 else []) + tokens + after)))
    assert run(spark, rows, items) == want(rows, items)


def test_parts_of_an_item_that_lie_apart_add_up(spark):
    item = [f"w{k}" for k in range(44)]
    fill = [f"f{k}" for k in range(5000)]
    rows = [
        (1, " ".join(item[:22] + fill[:60] + item[22:])),
        (2, " ".join(["x", *item[:22], *fill, *item[22:], "y"])),
        (3, " ".join(item[:22] + fill[:60])),
        (3, " ".join(item[22:] + fill[:60])),
    ]
    items = [(1, " ".join(item))]
    assert run(spark, rows, items) == {(1, 1): 0.9, (2, 1): 0.9} == {**want(rows[:2], items)}


@pytest.mark.parametrize("many", [9, 10, 20])
def test_short_runs_at_odd_and_even_places(spark, many):
    """Edge words changed, words inserted in the middle: runs of eight shingles at any place."""
    items, rows = [], []
    for k in range(12):
        tokens = [f"i{k}w{place}" for place in range(many + 4)]
        items.append((k, " ".join(tokens)))
        edits = [["edit", *tokens[1:]], [*tokens[:-1], "edit"]]
        if many != 9:
            edits += [["edit", "edit", *tokens[2:]], [*tokens[:-2], "edit", "edit"], ["edit", *tokens[1:-1], "edit"]]
        if many == 20:
            edits.append([*tokens[:12], "in", "serted", *tokens[12:]])
        for edit in edits:
            for before in range(4):
                rows.append((len(rows), " ".join([f"f{len(rows)}x{place}" for place in range(before)] + edit + ["tail"] * 9)))
    assert run(spark, rows, items) == want(rows, items)
    assert len(want(rows, items)) == len(rows)


def test_few_heavy_shingles_tell_an_item(spark):
    """Four shingles of its own outweigh those that an item shares with a hundred others."""
    common = "the answer to the question that was asked above is one of"
    items = [(k, f"{common} own{k}a own{k}b own{k}c own{k}d") for k in range(100)]
    rows = [(k, f"{'x ' * k}was asked above is one of own{k}a own{k}b own{k}c own{k}d y") for k in range(0, 100, 9)]
    assert run(spark, rows, items) == want(rows, items)
    assert len(want(rows, items)) == len(rows)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = want([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    found = decontamination.contained_items(docs, bench).collect()
    assert {(r.doc_id, r.item_id): round(r.similarity, 6) for r in found} == expected
    clean = decontamination.without_items(docs, bench)
    assert clean.columns == docs.columns
    leaked = {doc_id for doc_id, _ in expected}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in leaked)


def test_odd_rows(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my"
    rows = [(None, item), (1, None), (2, ""), (3, f"x {item} y"), (3, f"x {item} y"), (4, " \n"), (5, "short one"),
            (6, f"{item} " * 3), (7, "w " * 40000 + item)]
    items = [(1, item), (1, item), (2, None), (3, ""), (4, "short one"), (None, "nobody has this text in any document")]
    assert run(spark, rows, items) == {(3, 1): 1.0, (5, 4): 1.0, (6, 1): 1.0, (7, 1): 1.0}
    assert run(spark, rows, []) == {}
    assert run(spark, [], items) == {}


def test_classes_hold_a_grid_window_wherever_a_copy_begins():
    for size in decontamination.CLASSES:
        step = decontamination.stride(size)
        shortest = size + step - 1
        for begin in range(3 * step):
            first = -(-begin // step) * step
            assert first + size <= begin + shortest


def test_every_row_is_judged_by_its_own_text(spark):
    item = " ".join(f"w{k}" for k in range(30))
    leaked, clean = f"x {item} y", "nothing of the kind is said in this text"
    rows = [(1, leaked), (1, clean), (None, leaked), (None, clean), (2, leaked), (2, leaked), (3, None)]
    docs = spark.createDataFrame([(*row, "a", 1) for row in rows], "doc_id long, text string, row string, doc int")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept = decontamination.without_items(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, clean), (None, clean), (3, None)], key=str)
    assert sorted((r.doc_id, r.item_id) for r in decontamination.contained_items(docs, bench).collect()) == [(1, 7), (2, 7)]
    assert decontamination.without_items(docs.limit(0), bench).count() == 0
    assert decontamination.without_items(docs, bench.limit(0)).count() == 7


def test_windows_alone_reach_the_recall(spark):
    """Items with random edits, insertions and losses, at all sizes and places: windows are the only way to be found."""
    rng = random.Random(11)
    items = [(k, [f"i{k}w{place}" for place in range(rng.randrange(9, 160))]) for k in range(40)]
    rows = []
    for k in range(400):
        tokens = list(rng.choice(items)[1])
        for _ in range(rng.randrange(5)):
            place = rng.randrange(len(tokens))
            kind = rng.randrange(3)
            tokens[place : place + (kind > 0)] = [] if kind == 1 else [f"e{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 4))]
        fill = [f"f{rng.randrange(10**6)}" for _ in range(rng.randrange(40))]
        rows.append((k, " ".join([*fill, *tokens, *fill[:9]])))
    expected = want(rows, [(k, " ".join(words)) for k, words in items])
    got = run(spark, rows, [(k, " ".join(words)) for k, words in items])
    assert len(expected) > 150
    assert set(got) <= set(expected)
    assert len(got) >= 0.99 * len(expected)
