"""The trie against one built in memory, with limits small enough to cut it up."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

import brute
from deposit_analytics.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, length string, a string, words int, place int"


def plain(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    original = {
        conv_id: [one[2:] for one in sorted(turns, key=lambda x: (*x[:3], x[3][:32], hashlib.md5(x[3].encode()).hexdigest()))]
        for conv_id, turns in convs.items()
    }
    rebuilt = {}
    for conv_id, turns in original.items():
        shared = zlib.crc32(str(conv_id).encode()) % 4
        family = conv_id - (abs(conv_id) % 20) * (1 if conv_id >= 0 else -1)
        rebuilt[conv_id] = tuple(original.get(family, [])[:shared] + turns[shared:])
    members = defaultdict(list)
    for conv_id, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv_id)
    out = []
    for node, ids in members.items():
        below = [other for other in members if other[: len(node)] == node]
        children = [other for other in below if len(other) == len(node) + 1]
        leaves = [one for one in below if not any(len(x) == len(one) + 1 and x[: len(one)] == one for x in members)]
        ends = ",".join(str(one) for one in sorted(ids) if rebuilt[one] == node)
        out.append(
            (
                min(ids),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(ids),
                len(children),
                len(leaves),
                sum((len(members[one]) - 1) * len(brute.words(one[-1][1])) for one in below if one),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*row, 1, "x", "y", 2, 3) for row in rows], SCHEMA)
    return sorted(map(tuple, prefix_trie.trie(frame, **options).collect()), key=str)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv_id in rng.sample(range(-25, 70), 50):
        for turn in range(rng.choice([1, 2, 3, 5, 9])):
            text = rng.choice(["a", "a b", "b  c\nd", "", None])
            rows.append((conv_id, None if rng.random() < 0.05 else turn * 3, rng.choice(["user", "user", None]), text))
    return rows + rng.sample(rows, 10)


@pytest.mark.parametrize(
    "limits", [{}, {"subtree_nodes": 6, "shard_nodes": 20, "queue_messages": 2}, {"subtree_nodes": 0, "queue_messages": 1}]
)
def test_nodes_equal_the_plain_trie(spark, limits, monkeypatch):
    if limits:
        monkeypatch.setattr(prefix_trie, "TURN_BLOCK", 4)
        monkeypatch.setattr(prefix_trie, "END_BLOCK", 3)
    rows = conversations(len(limits))
    assert run(spark, rows, **limits) == plain(rows)


def test_hot_conversations_and_hot_turns(spark):
    # One opening for all, many equal conversations, one very long one.
    rows = [(k, 0, "user", "hello there") for k in range(300)]
    rows += [(k, 1, "bot", f"answer {k % 7}") for k in range(0, 300, 2)]
    rows += [(400, k, "user", "more of it") for k in range(3000)]
    limits = {"subtree_nodes": 200, "shard_nodes": 500, "queue_messages": 16}
    got = {row[:2]: row for row in run(spark, rows, **limits)}
    small = rows[:450]
    want = {row[:2]: row for row in plain(small + [(400, k, "user", "more of it") for k in range(30)])}
    assert got[400, 3000][4:6] == (0, 1)
    assert len([key for key in got if key[0] != 400]) == len([key for key in want if key[0] != 400])
    for key, row in want.items():
        if key[0] != 400 or key[1] == 0:
            assert got[key] == row


def test_odd_rows(spark):
    long = "w " * 60000
    rows = [(None, 1, "user", "lost"), (1, None, None, None), (2, 5, "user", long), (2, 5, "user", long), (22, 5, "user", long),
            (2, 5, "bot", "x" * 32 + "b"), (2, 5, "bot", "x" * 32 + "a"), (3, -4, "é", "ü"), (9, 1, "user", "  x")]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, rows[:1]) == []


def test_queue_spills_and_keeps_the_order():
    rng = random.Random(3)
    queue, want = prefix_trie.SpillingQueue(5), []
    for _ in range(400):
        if want and rng.random() < 0.4:
            assert queue.least() == min(want)
            assert queue.pop() == min(want)
            want.remove(min(want))
        else:
            one = tuple(rng.randrange(-3, 3) for _ in range(5))
            queue.push(one)
            want.append(one)
    assert [queue.pop() for _ in want] == sorted(want)
    assert queue.least() is None
