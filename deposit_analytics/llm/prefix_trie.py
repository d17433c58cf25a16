"""The trie of conversation prefixes, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns. It is named by its depth and by
two 64-bit numbers: the XOR over its turns of hashes of place, role and text. So a
parent's name is the child's without its last turn, and names of a long
conversation are running XORs that are computed in blocks of turns.

Totals over subtrees are passed from children to parents. Nodes are sorted by
falling depth; a node takes from a priority queue what its children left for it,
and leaves its own totals for its parent, whose place in the order comes later.
The queue holds what lies between, and spills sorted runs beyond a bound. Subtrees
of bounded size are dealt to shards, which do this side by side; their roots'
totals are then added up by parent, and the nodes above, few by the bound, are
processed in the same way.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deposit_analytics.llm.common import stored, word_count

FAMILY = 20
SHARED_TURNS = 4
TURN_BLOCK = 1024
END_BLOCK = 1024
SUBTREE_NODES = 1 << 14
SHARD_NODES = 1 << 15
QUEUE_MESSAGES = 1 << 18
MESSAGE = "<5q"


class SpillingQueue:
    """A priority queue of tuples of five 64-bit numbers that keeps at most ``most`` in memory.

    Runs beyond that go to unnamed temporary files of the task, which nobody else
    reads and which end with it.
    """

    def __init__(self, most: int = QUEUE_MESSAGES):
        self.most, self.held, self.runs, self.spilled = most, [], [], 0

    def push(self, message: tuple[int, ...]) -> None:
        heapq.heappush(self.held, message)
        if len(self.held) > self.most:
            file = tempfile.TemporaryFile()  # noqa: SIM115
            file.writelines(struct.pack(MESSAGE, *one) for one in sorted(self.held))
            file.seek(0)
            self.held, self.spilled = [], self.spilled + 1
            self._advance(iter(lambda: file.read(struct.calcsize(MESSAGE)), b""), self.spilled)

    def _advance(self, run: Iterator[bytes], number: int) -> None:
        if raw := next(run, None):
            heapq.heappush(self.runs, (struct.unpack(MESSAGE, raw), number, run))

    def least(self) -> tuple[int, ...] | None:
        return min([*self.held[:1], *[run[0] for run in self.runs[:1]]], default=None)

    def pop(self) -> tuple[int, ...]:
        if not self.runs or self.held and self.held[0] <= self.runs[0][0]:
            return heapq.heappop(self.held)
        message, number, run = heapq.heappop(self.runs)
        self._advance(run, number)
        return message


def _forward(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """a, b, depth, n_children, n_leaves, saved of nodes that come by falling depth, then by name.

    ``own`` is what a node saves itself, ``children``, ``leaves`` and ``saved`` what
    was passed to it before; a ``root`` passes nothing on.
    """
    queue = SpillingQueue(most)
    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        out: tuple[list, list, list] = ([], [], [])
        for row in range(batch.num_rows):
            key = (-columns["depth"][row], columns["a"][row], columns["b"][row])
            children, leaves, saved = (columns[name][row] for name in ("children", "leaves", "saved"))
            saved += columns["own"][row]
            while (message := queue.least()) and message[:3] == key:
                queue.pop()
                children, leaves, saved = children + 1, leaves + message[3], saved + message[4]
            leaves = leaves if children else 1
            if not columns["root"][row]:
                queue.push((key[0] + 1, columns["above_a"][row], columns["above_b"][row], leaves, saved))
            for values, value in zip(out, (children, leaves, saved), strict=True):
                values.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), batch.column("depth"), *[pa.array(values, pa.int64()) for values in out]],
            ["a", "b", "depth", "n_children", "n_leaves", "saved_tokens"],
        )


_FORWARD = "a long, b long, depth long, n_children long, n_leaves long, saved_tokens long"
_NAME = ("depth", "a", "b")


def _passed(nodes: DataFrame, shards: int, most: int) -> DataFrame:
    """Totals of ``nodes``, of which those of one ``shard`` share a task."""
    columns = ("a", "b", "depth", "above_a", "above_b", "own", "root", "children", "leaves", "saved")
    dealt = nodes.repartition(shards, "shard").sortWithinPartitions(F.desc("depth"), "a", "b")
    return dealt.select(*columns).mapInArrow(lambda batches: _forward(batches, most), _FORWARD)


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), turn_a, turn_b, words for the turns of each conversation in order.

    A conversation is numbered in blocks of turn numbers and the blocks are added
    up, so that one with very many turns is spread over tasks. No text is moved.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, 32).alias("begin"),
        F.md5(text).alias("digest"),
        F.xxhash64(F.lit(1), role, text).alias("turn_a"),
        F.xxhash64(F.lit(2), text, role).alias("turn_b"),
        word_count(text).alias("words"),
    )
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / TURN_BLOCK), F.lit(-(1 << 62))))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "role", "begin", "digest")
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1)
    sizes = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return ranked.join(offsets, ["conv_id", "block"]).select(
        "conv_id", (F.col("offset") + F.col("rank")).alias("place"), "turn_a", "turn_b", "words"
    )


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns (conv_id, depth, turn_a, turn_b, words)."""
    lengths = stored(turns.groupBy("conv_id").agg((F.max("place") + 1).alias("length")), "lengths")
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED_TURNS))
    own = lengths.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), shared.alias("shared"), "length"
    )
    first = lengths.select(F.col("conv_id").alias("family"), F.col("length").alias("first_length"))
    plans = own.join(first, "family", "left").select(
        "conv_id", "family", "shared", "length", F.least("shared", F.coalesce("first_length", F.lit(0))).alias("taken")
    )
    plans = stored(plans, "plans")
    taken = (
        turns.where(F.col("place") < SHARED_TURNS - 1)
        .withColumnRenamed("conv_id", "family")
        .join(plans.select("conv_id", "family", "shared"), "family")
        .where(F.col("place") < F.col("shared"))
        .select("conv_id", (F.col("place") + 1).alias("depth"), "turn_a", "turn_b", "words")
    )
    rest = (
        turns.join(plans.select("conv_id", "shared", "taken"), "conv_id")
        .where(F.col("place") >= F.col("shared"))
        .select("conv_id", (F.col("place") - F.col("shared") + F.col("taken") + 1).alias("depth"), "turn_a", "turn_b", "words")
    )
    length = F.col("taken") + F.greatest(F.col("length") - F.col("shared"), F.lit(0))
    return plans.select("conv_id", length.alias("length")), taken.unionByName(rest)


def _paths(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, a node on its path (depth, a, b), the node above, words of its last turn, turns that follow."""
    steps = turns.select(
        "conv_id",
        "depth",
        F.floor(F.col("depth") / TURN_BLOCK).alias("block"),
        F.xxhash64("depth", "turn_a").alias("step_a"),
        F.xxhash64("turn_b", "depth").alias("step_b"),
        "words",
    )
    steps = stored(steps, "steps")
    blocks = steps.groupBy("conv_id", "block").agg(*[F.bit_xor(f"step_{x}").alias(f"sum_{x}") for x in "ab"])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv_id", "block", *[F.coalesce(F.bit_xor(f"sum_{x}").over(earlier), F.lit(0)).alias(f"sum_{x}") for x in "ab"]
    )
    upto = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = steps.select("*", *[F.bit_xor(f"step_{x}").over(upto).alias(f"upto_{x}") for x in "ab"])

    def node(x: str) -> Column:
        return F.col(f"upto_{x}").bitwiseXOR(F.col(f"sum_{x}"))

    named = running.join(blocks, ["conv_id", "block"]).select(
        "conv_id",
        "depth",
        node("a").alias("a"),
        node("b").alias("b"),
        node("a").bitwiseXOR(F.col("step_a")).alias("above_a"),
        node("b").bitwiseXOR(F.col("step_b")).alias("above_b"),
        "words",
    )
    zero = F.lit(0).cast("long")
    roots = conversations.select(
        "conv_id", *[zero.alias(name) for name in ("depth", "a", "b", "above_a", "above_b", "words")], "length"
    )
    paths = named.join(conversations, "conv_id").unionByName(roots)
    return paths.withColumn("rest", F.col("length") - F.col("depth")).drop("length")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order, one node after the other."""
    names, last, digest = ("depth", "a", "b"), None, None
    schema = pa.schema([*[(name, pa.int64()) for name in names], ("ends_sha256", pa.string())])

    def ended() -> dict:
        return {**dict(zip(names, last, strict=True)), "ends_sha256": digest.hexdigest()}

    for batch in batches:
        rows = []
        for *key, piece in zip(*[batch.column(name).to_pylist() for name in (*names, "ids")], strict=True):
            if key == last:
                digest.update(b"," + piece.encode())
                continue
            if last is not None:
                rows.append(ended())
            last, digest = key, hashlib.sha256(piece.encode())
        yield pa.RecordBatch.from_pylist(rows, schema=schema)
    if last is not None:
        yield pa.RecordBatch.from_pylist([ended()], schema=schema)


def _ends(paths: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256 of the nodes at which conversations end.

    The digest of a node reads its ids in order, so one task has to; ids come to
    it in pieces of neighbours, put together elsewhere, and none is held.
    """
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda one: one.cast("string")), ",")
    pieces = (
        paths.where("rest = 0")
        .groupBy(*_NAME, F.floor(F.col("conv_id") / END_BLOCK).alias("piece"))
        .agg(ids.alias("ids"))
    )
    ordered = pieces.repartition(*_NAME).sortWithinPartitions(*_NAME, "piece").select(*_NAME, "ids")
    return ordered.mapInArrow(_digests, "depth long, a long, b long, ends_sha256 string")


def _shard_roots(paths: DataFrame, heavy: DataFrame) -> DataFrame:
    """conv_id, root_a, root_b: the first node on a conversation's path whose subtree is small."""
    above = paths.join(heavy.select(*_NAME), list(_NAME), "left_semi").groupBy("conv_id").agg(F.count("*").alias("first"))
    return (
        paths.select("conv_id", "depth", "a", "b")
        .join(above, "conv_id", "left")
        .where(F.col("depth") == F.coalesce("first", F.lit(0)))
        .select("conv_id", F.col("a").alias("root_a"), F.col("b").alias("root_b"))
    )


def trie(
    conversations: DataFrame,
    *,
    subtree_nodes: int = SUBTREE_NODES,
    shard_nodes: int = SHARD_NODES,
    queue_messages: int = QUEUE_MESSAGES,
) -> DataFrame:
    """Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per node.

    ``conversations`` has conv_id, turn, role and text. Turns go by number, NULL
    first; of one number, by role, the first 32 characters of the text and its MD5.
    Rows that are repeated are turns of their own. NULL roles and texts are empty;
    rows without conv_id are left out. Every conversation is rebuilt: its first
    turns, 0 to 3 by the CRC-32 of its id, are replaced by as many of the first
    conversation of its family of twenty (the remainder has the sign of the id). The
    root is the node of depth 0, without parent. Subtrees of at most
    ``subtree_nodes`` turns are processed whole, some to a shard. An empty table
    gives no rows. Other columns are ignored.
    """
    turns = stored(numbered(conversations), "turns")
    convs, rebuilt = _rebuilt(turns)
    paths = stored(_paths(convs, rebuilt), "conversation_paths")
    nodes = paths.groupBy(*_NAME).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("above_a").alias("above_a"),
        F.max("above_b").alias("above_b"),
        ((F.count("*") - 1) * F.max("words")).alias("own"),
        # All turns from here on, shared or not: no less than the nodes of the subtree.
        (F.sum("rest") + 1).alias("weight"),
    )
    nodes = stored(nodes, "trie_nodes")
    heavy = nodes.where(F.col("weight") > subtree_nodes)
    small = nodes.where(F.col("weight") <= subtree_nodes)
    zero = F.lit(0).cast("long")
    nothing = {name: zero for name in ("children", "leaves", "saved")}
    shards = max(1, (paths.count() or 0) // shard_nodes)
    roots = _shard_roots(paths, heavy)
    placed = (
        small.join(roots, "conv_id")
        .withColumns({"root": (F.col("a") == F.col("root_a")) & (F.col("b") == F.col("root_b")), **nothing})
        .withColumn("shard", F.xxhash64("root_a", "root_b"))
    )
    placed = stored(placed, "shards")
    below = stored(_passed(placed, shards, queue_messages), "shard_totals")
    # What the shards' roots leave for the same parent is added up before it moves on.
    left = (
        below.join(placed.where("root").select(*_NAME, "above_a", "above_b"), list(_NAME))
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("above_a").alias("a"), F.col("above_b").alias("b"))
        .agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    )
    top = (
        heavy.join(left, list(_NAME), "left")
        .withColumns({name: F.coalesce(name, zero) for name in nothing})
        .withColumns({"root": F.col("depth") == 0, "shard": zero})
    )
    totals = below.unionByName(_passed(top, 1, queue_messages))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("above_a"), F.col("b").alias("above_b"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        nodes.join(totals, list(_NAME))
        .join(_ends(paths), list(_NAME), "left")
        .join(parents, ["depth", "above_a", "above_b"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
