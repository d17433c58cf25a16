"""Jaccard join over word shingles by chosen paths.

Every document is the set of its five-word shingles. Documents with equal sets
form one class, which the search sees once. A class is described by a signature
of minima, each of which is a sampled token; two sets share one with the
probability of their Jaccard similarity.

The search is a recursion: a node holds the sets that share the tokens on the
path to it. It picks each of the signature's places with probability 1 over
(threshold x places), alike for all its sets, and sends every set to the child
named by the token there. So a pair at the threshold meets in one child on
average. Nodes with few sets are compared pair by pair; others are split again,
and those that are still large at the deepest level are compared in blocks. The
first comparison is of signatures, and asks for as many equal places as a pair at
the threshold has almost always. Sets with a partner are then compared exactly.
Runs with other random choices repeat until a pair at the threshold is missed with
less than the stated probability, the screen's misses included.

A large group of near copies would not shrink from level to level, and every run
would send it on again. Such groups are taken out first: sets that agree in a few
places and are very many share a centre, the commonest token of each place. A set
near the centre can only have partners that are near enough to it too, as places
that differ obey the triangle inequality; so centre and partners are one node,
compared once in blocks, and the sets near the centre need no search.

No pair leaves a task: a comparison returns links per set, counted in the first
node that both sets reach, and a star per connected group for the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deposit_analytics.llm import shingles
from deposit_analytics.llm.common import row_key, stored, without_rows
from deposit_analytics.llm.components import components, local_stars

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.999
PLACES = 64
DEPTH = 3
SMALL = 64
BLOCK = 1024
BLOCK_TOKENS = 1 << 21
COLUMNS = 4096
# Misses are shared out: so much of them falls to the comparison of signatures.
SCREEN_SHARE = 0.2
DENSE = 256
TRIALS = 4
TOGETHER = 3
SAMPLE = 64
LEAST_NEAR = 8

_SEEDS = shingles.mixed(np.arange(1, 1 + 2 * PLACES, dtype=np.uint64)) | np.uint64(1)


def _agreeing_odds(threshold: float) -> list[float]:
    """How likely a pair at the threshold agrees in 0, 1, ... places."""
    return [math.comb(PLACES, k) * threshold**k * (1 - threshold) ** (PLACES - k) for k in range(PLACES + 1)]


def least_agreeing(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Places in which a pair at the threshold agrees but for the screen's share of the misses."""
    missed, odds = 0.0, _agreeing_odds(threshold)
    for k, odd in enumerate(odds):
        missed += odd
        if missed > (1 - recall) * SCREEN_SHARE:
            return k
    return PLACES


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met, and passed the screen, with probability ``recall``.

    In one run it survives a level when one of the places it agrees in is chosen and
    it survives below. Those places are the same in all runs, so the chance to miss
    all runs is averaged over their number.
    """
    least = least_agreeing(threshold, recall)
    odds = _agreeing_odds(threshold)
    alive = [1.0] * (PLACES + 1)
    for _ in range(depth):
        alive = [1 - (1 - one / (threshold * PLACES)) ** k for k, one in enumerate(alive)]
    runs = 1
    while sum(odds[:least]) + sum(odds[k] * (1 - alive[k]) ** runs for k in range(least, PLACES + 1)) > 1 - recall:
        runs += 1
    return runs


def _set_hash(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One hash per set of distinct tokens; ``at`` says where each set begins."""
    with np.errstate(over="ignore"):
        return np.add.reduceat(shingles.mixed(tokens + _SEEDS[0]), at)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """doc_id, row, a hash of the set, its size, its signature."""
    for batch in batches:
        for first, last, hashes, offsets in shingles.shingles(batch.column("text"), width):
            tokens, offsets = shingles.distinct(hashes, offsets)
            sizes = np.diff(offsets)
            some = np.flatnonzero(sizes)
            at = offsets[:-1][some]
            ids = np.zeros(last - first, np.uint64)
            minima = np.zeros((PLACES, last - first), np.uint32)
            if len(some):
                ids[some] = _set_hash(tokens, at)
                with np.errstate(over="ignore"):
                    for k in range(PLACES):
                        spread = (tokens ^ _SEEDS[PLACES + k]) * _SEEDS[k]
                        spread ^= spread >> np.uint64(29)
                        spread *= _SEEDS[k]
                        minima[k, some] = np.minimum.reduceat(spread >> np.uint64(32), at)
            rows = np.ascontiguousarray(minima.T)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, last - first),
                    batch.column("row").slice(first, last - first),
                    pa.array(ids.view(np.int64)),
                    pa.array(sizes.astype(np.int64)),
                    pa.array([row.tobytes() for row in rows], pa.binary()),
                ],
                ["doc_id", "row", "set_id", "n", "signature"],
            )


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), PLACES)


def _children(batches: Iterator[pa.RecordBatch], runs: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """path, set_id, n of the next level; without a path, the first level of every run."""
    chance = np.uint64(min(2**64 - 1, int(2**64 / (threshold * PLACES))))
    places = shingles.mixed(np.arange(1, PLACES + 1, dtype=np.uint64) << np.uint64(20))
    for whole in batches:
        for start in range(0, whole.num_rows, 4096):
            batch = whole.slice(start, 4096)
            ids = batch.column("set_id").to_numpy(zero_copy_only=False)
            sizes = batch.column("n").to_numpy(zero_copy_only=False)
            minima = _signatures(batch.column("signature")).astype(np.uint64)
            if "path" in batch.schema.names:
                above = [batch.column("path").to_numpy(zero_copy_only=False).view(np.uint64)]
            else:
                roots = shingles.mixed(np.arange(1, runs + 1, dtype=np.uint64) << np.uint64(40))
                above = [np.full(len(ids), root) for root in roots]
            with np.errstate(over="ignore"):
                for path in above:
                    row, place = np.nonzero(shingles.mixed(path[:, None] ^ places[None, :]) < chance)
                    child = shingles.mixed(shingles.mixed(path[row] + places[place]) + minima[row, place])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(child.view(np.int64)), pa.array(ids[row]), pa.array(sizes[row])],
                        ["path", "set_id", "n"],
                    )


def _tokens(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """set_id, tokens of every text that has any."""
    for batch in batches:
        for _, _, hashes, offsets in shingles.shingles(batch.column("text"), width):
            tokens, offsets = shingles.distinct(hashes, offsets)
            some = np.flatnonzero(np.diff(offsets))
            if not len(some):
                continue
            raw = tokens.tobytes()
            cut = [raw[8 * offsets[k] : 8 * offsets[k + 1]] for k in some]
            ids = _set_hash(tokens, offsets[:-1][some]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(cut, pa.binary())], ["set_id", "tokens"])


def _incidence(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows and columns of the values that occur in several rows, and how many such values."""
    owner = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
    values, column, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    return owner[keep], number[column[keep]], int(shared.sum())


def shared_counts(rows: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Values in common of every left and every right row, a slice of the values at a time."""
    owner, column, count = _incidence(rows)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, count, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        dense = np.zeros((len(rows), min(COLUMNS, count - start)), np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        out += dense[left] @ dense[right].T
    return out


def _sides(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of the first and of the second block, and whether they are one block."""
    left = np.flatnonzero((group["block"] == group["first"]).to_numpy())
    right = np.flatnonzero((group["block"] == group["second"]).to_numpy())
    return left, right, bool(group["first"].iloc[0] == group["second"].iloc[0])


def _screen_unit(unit: pd.DataFrame, agreeing: int) -> pd.DataFrame:
    """node, set_id of the sets whose signature is like another's in the same node."""
    found: list[pd.DataFrame] = []
    for _, group in unit.groupby(["node", "first", "second"], sort=False):
        left, right, same = _sides(group)
        signatures = np.frombuffer(b"".join(group["signature"]), np.uint32).reshape(len(group), PLACES)
        agree = np.zeros((len(left), len(right)), np.uint8)
        for a, b in zip(signatures[left].T, signatures[right].T, strict=True):
            agree += a[:, None] == b[None, :]
        near = agree >= agreeing
        if same:
            np.fill_diagonal(near, False)
        some = np.zeros(len(group), bool)
        some[left] |= near.any(axis=1)
        some[right] |= near.any(axis=0)
        found.append(group.loc[some, ["node", "set_id"]])
    return pd.concat(found)


def _compare(group: pd.DataFrame, threshold: float) -> tuple[list, list, list]:
    """Links and stars of one node, or of two blocks of a large one."""
    ids = group.set_id.to_numpy()
    sizes = group.n.to_numpy().astype(np.float64)
    copies = group.copies.to_numpy()
    left, right, same = _sides(group)
    tokens = [np.frombuffer(one, np.uint64) for one in group.tokens]
    both = shared_counts(tokens, left, right).astype(np.float64)
    near = both >= threshold * (sizes[left][:, None] + sizes[right][None, :] - both) - 1e-9
    if same:
        np.fill_diagonal(near, False)
    if not near.any():
        return [], [], []
    stars = local_stars(near, left, right, ids)
    # A pair counts in the first node that holds both.
    own = int(group.node.iloc[0])
    nodes = [np.frombuffer(one, np.int64) for one in group.nodes]
    near &= shared_counts([one[one < own] for one in nodes], left, right) == 0
    links = np.zeros(len(ids), np.int64)
    links[left] += near @ copies[right]
    if not same:
        links[right] += near.T @ copies[left]
    some = np.flatnonzero(links)
    return (
        ids[some].tolist() + stars[0],
        links[some].tolist() + [0] * len(stars[0]),
        ids[some].tolist() + stars[1],
    )


def _compare_unit(unit: pd.DataFrame, threshold: float) -> pd.DataFrame:
    found: tuple[list, list, list] = ([], [], [])
    for _, group in unit.groupby(["node", "first", "second"], sort=False):
        for all_rows, rows in zip(found, _compare(group, threshold), strict=True):
            all_rows += rows
    return pd.DataFrame({"set_id": found[0], "links": found[1], "other": found[2]}).astype("int64")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """trial, set_id, key: sets of one key agree in the places of the trial."""
    for batch in batches:
        minima = _signatures(batch.column("signature")).astype(np.uint64)
        for trial in range(TRIALS):
            key = np.full(len(minima), np.uint64(trial + 1))
            for place in range(TOGETHER):
                key = shingles.mixed(key ^ minima[:, TOGETHER * trial + place])
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_id"), pa.array(key.view(np.int64))], ["set_id", "key"]
            )


def _centre(sample: pd.DataFrame) -> pd.DataFrame:
    """The commonest token of every place."""
    minima = np.frombuffer(b"".join(sample["signature"]), np.uint32).reshape(len(sample), PLACES)
    centre = np.empty(PLACES, np.uint32)
    for place in range(PLACES):
        values, counts = np.unique(minima[:, place], return_counts=True)
        centre[place] = values[counts.argmax()]
    return pd.DataFrame({"signature": [centre.tobytes()]})


def _near_centres(batches: Iterator[pa.RecordBatch], centres: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    """set_id, centre, agree of the sets that agree with a centre in at least ``least`` places."""
    # Who agrees in that many agrees in one of any more than the rest.
    order = np.argsort(centres, axis=0)[:, : PLACES - least + 1]
    for whole in batches:
        for start in range(0, whole.num_rows, 4096):
            batch = whole.slice(start, 4096)
            minima = _signatures(batch.column("signature"))
            row, centre = [], []
            for place, by in enumerate(order.T):
                values = centres[by, place]
                first, last = (np.searchsorted(values, minima[:, place], side) for side in ("left", "right"))
                counts = last - first
                at = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                row.append(np.repeat(np.arange(len(minima)), counts))
                centre.append(by[at])
            pairs = np.unique(np.concatenate(row) * len(centres) + np.concatenate(centre))
            row, centre = pairs // len(centres), pairs % len(centres)
            agree = np.concatenate(
                [np.zeros(0, np.int64)]
                + [
                    (minima[row[k : k + 65536]] == centres[centre[k : k + 65536]]).sum(axis=1)
                    for k in range(0, len(row), 65536)
                ]
            )
            near = agree >= least
            ids = batch.column("set_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row[near]]), pa.array(centre[near].astype(np.int64)), pa.array(agree[near].astype(np.int64))],
                ["set_id", "centre", "agree"],
            )


def _dense(classes: DataFrame, agreeing: int) -> tuple[DataFrame, DataFrame] | None:
    """Nodes (path, set_id, n) of large groups of near copies, and the sets (set_id) that need no other node.

    ``agreeing`` places are asked of a pair. A set that agrees with a centre in
    ``core`` places has only partners that agree with it in ``core + agreeing -
    PLACES``. Groups count as large from the root of all sets on, so as many
    centres as four times that root come to the driver at most. None, if there is
    no such group.
    """
    core = max(agreeing, PLACES + LEAST_NEAR - agreeing)
    least = max(DENSE, math.isqrt(classes.count()))
    together = classes.select("set_id", "signature").mapInArrow(_together, "set_id long, key long")
    large = together.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") >= least)
    large = stored(large, "large")
    if core > PLACES or large.isEmpty():
        return None
    chosen = F.pmod(F.xxhash64("key", "set_id"), F.col("members")) < SAMPLE
    sample = together.join(large, "key").where(chosen).join(classes.select("set_id", "signature"), "set_id")
    found = sample.groupBy("key").applyInPandas(_centre, "signature binary").distinct().collect()
    centres = np.stack([np.frombuffer(raw, np.uint32) for raw in sorted(bytes(row.signature) for row in found)])
    near = stored(
        classes.select("set_id", "signature").mapInArrow(
            lambda batches: _near_centres(batches, centres, core + agreeing - PLACES), "set_id long, centre long, agree long"
        ),
        "near_centres",
    )
    # Centres of one group are much the same; its sets go to the one that most are near to.
    close = near.where(F.col("agree") >= core)
    liked = close.groupBy("centre").agg(F.count("*").alias("liked"))
    taken = (
        close.join(liked, "centre")
        .groupBy("set_id")
        .agg(F.max(F.struct("liked", "centre")).alias("best"))
        .select("set_id", F.col("best.centre").alias("centre"))
    )
    taken = stored(taken, "taken")
    used = near.join(taken.select("centre").distinct(), "centre", "left_semi")
    nodes = used.join(classes.select("set_id", "n"), "set_id").select(
        F.xxhash64(F.lit("centre"), "centre").alias("path"), "set_id", "n"
    )
    return stored(nodes, "dense"), taken.select("set_id")


def _sized(rows: DataFrame) -> DataFrame:
    """(path, members, weight, sum, xor) of nodes with several members; the last two tell members apart."""
    who = F.xxhash64("set_id")
    nodes = rows.groupBy("path").agg(
        F.count("*").alias("members"),
        F.sum("n").alias("weight"),
        F.sum(who.bitwiseAND(F.lit(0xFFFFFFFF))).alias("sum"),
        F.bit_xor(who).alias("xor"),
    )
    return nodes.where(F.col("members") > 1)


def _nodes(signatures: DataFrame, runs: int, threshold: float, agreeing: int) -> DataFrame:
    """(node, set_id, members, weight) of all nodes to compare, those of the same members once.

    ``members`` and ``weight`` are the sets of the node and the tokens of all of them.
    """
    every = None
    above = signatures.select("set_id", "n", "signature")
    if dense := _dense(signatures, agreeing):
        every = stored(dense[0].drop("n").join(_sized(dense[0]), "path"), "paths")
        above = stored(above.join(dense[1], "set_id", "left_anti"), "sparse")
    searched = above
    for level in range(1, DEPTH + 1):
        rows = above.mapInArrow(lambda batches: _children(batches, runs, threshold), "path long, set_id long, n long")
        held = stored(rows.drop("n").join(_sized(rows), "path"), "paths")
        final = held if level == DEPTH else held.where(F.col("members") <= SMALL)
        every = final if every is None else every.unionByName(final)
        large = held.where(F.col("members") > SMALL).select("path", "set_id")
        above = large.join(searched, "set_id")
    same = ["members", "weight", "sum", "xor"]
    once = every.groupBy(same).agg(F.min("path").alias("path"))
    return every.join(once, [*same, "path"], "left_semi").select(
        F.col("path").alias("node"), "set_id", "members", "weight"
    )


def _units(nodes: DataFrame, sets: DataFrame, most: int) -> DataFrame:
    """Rows to compare, dealt out by unit.

    ``nodes`` has node, set_id and the node's members and weight. Small nodes go
    many to a unit. Large ones are cut into blocks of bounded rows and weight,
    and each pair of blocks is a unit.
    """
    parts = F.greatest(F.col("members") / F.lit(BLOCK), F.col("weight") / F.lit(most))
    rows = nodes.withColumn("blocks", F.ceil(parts).cast("int"))
    few = rows.where(F.col("blocks") == 1).groupBy("node").agg(F.max("weight").alias("weight"))
    units = (few.agg(F.sum("weight")).first()[0] or 0) // most + 1
    rows = rows.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    alone = F.xxhash64("node", "first", "second")
    unit = F.when(F.col("blocks") > 1, alone).otherwise(F.pmod(F.xxhash64("node"), F.lit(units)))
    return rows.select("node", "set_id", "block", "first", "second", unit.alias("unit")).join(sets, "set_id")


def _screened(nodes: DataFrame, classes: DataFrame, agreeing: int) -> DataFrame:
    """(node, set_id, members, weight) of the sets with a partner of a like signature."""
    by_rows = nodes.withColumn("weight", F.col("members"))
    kept = (
        _units(by_rows, classes.select("set_id", "signature"), 2 * BLOCK)
        .groupBy("unit")
        .applyInPandas(lambda unit: _screen_unit(unit, agreeing), "node long, set_id long")
        .distinct()
    )
    kept = stored(kept.join(classes.select("set_id", "n"), "set_id"), "screened")
    sizes = kept.groupBy("node").agg(F.count("*").alias("members"), F.sum("n").alias("weight"))
    return kept.drop("n").join(sizes, "node")


def _judged(docs: DataFrame, width: int, threshold: float, recall: float) -> DataFrame:
    """row (its key), doc_id, n_links, class_id and the key of the class's first row for each row of ``docs``.

    ``docs`` has doc_id and text. ``first`` is NULL for rows without words.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        row_key(F.col("doc_id"), F.col("text")).alias("row"),
    )
    agreeing = least_agreeing(threshold, recall)
    described = stored(
        docs.mapInArrow(
            lambda batches: _sets(batches, width), "doc_id long, row long, set_id long, n long, signature binary"
        ),
        "sets",
    )
    usable = described.where(F.col("n") > 0)
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    classes = stored(
        usable.groupBy("set_id").agg(
            F.min(row).alias("first"),
            F.count("*").alias("copies"),
            F.max("n").alias("n"),
            F.max("signature").alias("signature"),
        ),
        "classes",
    )
    nodes = stored(_nodes(classes, runs_needed(threshold, recall), threshold, agreeing), "nodes")
    nodes = stored(_screened(nodes, classes, agreeing), "screened_nodes")
    reached = nodes.groupBy("set_id").agg(F.sort_array(F.collect_set("node")).alias("list"))
    active = stored(reached.join(classes.select("set_id", "first", "n", "copies"), "set_id"), "active")
    # One row of each set tells its tokens.
    wanted = stored(active.select("first.row").distinct(), "wanted")
    texts = (
        docs.join(wanted, "row", "left_semi")
        .select("text")
        .mapInArrow(lambda batches: _tokens(batches, width), "set_id long, tokens binary")
        .dropDuplicates(["set_id"])
    )
    packed = active.select("set_id", "n", "copies", "list").mapInArrow(
        _packed, "set_id long, n long, copies long, nodes binary"
    )
    found = stored(
        _units(nodes, packed.join(texts, "set_id"), BLOCK_TOKENS)
        .groupBy("unit")
        .applyInPandas(lambda unit: _compare_unit(unit, threshold), "set_id long, links long, other long"),
        "links",
    )
    edges = found.where(F.col("set_id") != F.col("other"))
    stars = components(edges.select(F.col("set_id").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("set_id").agg(F.sum("links").alias("links"))
    tied = (
        classes.select("set_id", "first", "copies")
        .join(links, "set_id", "left")
        .join(stars.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("component", F.coalesce("component", "set_id"))
    )
    first = tied.groupBy("component").agg(F.min("first").alias("first"))
    per_set = tied.drop("first").join(first, "component").select(
        "set_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "first"
    )
    nothing = described.where(F.col("n") == 0).select(
        "row", "doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"), F.lit(None).cast("long").alias("first")
    )
    judged = usable.select("row", "doc_id", "set_id").join(per_set, "set_id")
    judged = judged.select("row", "doc_id", "n_links", F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("first"))
    return judged.unionByName(nothing)


def near_groups(docs: DataFrame, *, width: int = WIDTH, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Returns doc_id, n_links, class_id for each row of ``docs`` (doc_id, text).

    ``n_links`` counts the other rows whose shingle sets have a Jaccard
    similarity of at least ``threshold``, copies included; ``class_id`` is the
    least doc_id of the rows that links connect. A pair at the threshold is found
    with probability ``recall``, more similar ones with more. Words are runs of
    non-space characters. A text of one to four words has one shingle; texts
    without words, or NULL, link with nothing. Rows without doc_id link like others;
    a class that has only such rows has NULL as class. Rows that repeat a doc_id are
    rows of their own. An empty table gives no rows. Other columns are ignored.
    """
    return _judged(docs, width, threshold, recall).select("doc_id", "n_links", "class_id")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("list")
        nodes = [np.asarray(one.as_py(), np.int64).tobytes() for one in lists]
        yield pa.RecordBatch.from_arrays(
            [batch.column("set_id"), batch.column("n"), batch.column("copies"), pa.array(nodes, pa.binary())],
            ["set_id", "n", "copies", "nodes"],
        )


def without_copies(
    docs: DataFrame, *, width: int = WIDTH, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """One row of each class, the first by doc_id (NULL last); its columns stay as they are.

    Rows without words, or with NULL as text, are like no other and stay. Of rows of
    one doc_id that link, one stays, picked by a hash of the text; of rows alike in
    doc_id and text, one, whichever.
    """
    judged = stored(_judged(docs, width, threshold, recall).select("row", "first"), "judged")
    kept = without_rows(docs, judged.where(F.col("row") != F.col("first")))
    firsts = judged.where(F.col("row") == F.col("first"))
    again = stored(firsts.groupBy("row").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    if again.isEmpty():
        return kept.select(*docs.columns)
    key = row_key(F.col("doc_id"), F.col("text"))
    marked = kept.select(F.struct(*docs.columns).alias("doc"), key.alias("row"))
    repeated = marked.join(again, "row", "left_semi").dropDuplicates(["row"])
    return without_rows(kept, again).unionByName(repeated.select("doc.*")).select(*docs.columns)
