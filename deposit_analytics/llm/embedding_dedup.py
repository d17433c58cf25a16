"""Near duplicates among embeddings by counting collisions of projections.

Vectors are projected on many random lines. On a line, a vector's window reaches
twice the distance of a pair at the threshold to either side; a pair collides
where one lies in the window of the other. Near pairs collide on almost all
lines, others on about a third, so pairs are verified by their exact cosine only
if they collide on a number of lines that a pair at the threshold reaches with
the stated recall.

A window holds a constant share of all vectors, so counting over all pairs would
grow with their square. The vectors are first dealt into cells by the sides of
several lines on which they lie, as many as make cells of a few hundred, and
dealt again by other lines until a pair at the threshold has shared a cell with
the stated recall. Collisions are counted within cells: sorted along a line, a
window is a run of neighbours. The first lines' runs, sorted together, give the
pairs that collide there and how often, as a pair that reaches the count has to on
one of them; every further line adds to those counts and drops the pairs that
can't reach it any more. No pair leaves a task:
links are added up per vector, in the first cell that holds both, and groups
leave as stars. Vectors that are equal are searched once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deposit_analytics.llm.common import stored
from deposit_analytics.llm.components import components, stars_of

THRESHOLD = 0.95
RECALL = 0.999
LINES = 32
REACH = 2.0
CELL = 256
BLOCK = 1024
PAIRS = 1 << 17
SEED = 20


def sides_for(rows: int) -> int:
    """Lines that cut ``rows`` vectors into cells of about ``CELL``."""
    return max(1, round(math.log2(max(2.0, rows / CELL))))


def deals_for(sides: int, threshold: float, recall: float) -> int:
    """Deals after which a pair at the threshold has shared a cell with ``recall``."""
    together = (1 - math.acos(threshold) / math.pi) ** sides
    return math.ceil(math.log(1 - recall) / math.log(1 - together))


def least_count(recall: float) -> int:
    """Collisions that a pair at the threshold reaches with ``recall``.

    Its distance on a line is normal, with the pair's distance as deviation.
    """
    hit = math.erf(REACH / math.sqrt(2))
    reached = 0.0
    for count in range(LINES, -1, -1):
        reached += math.comb(LINES, count) * hit**count * (1 - hit) ** (LINES - count)
        if reached >= recall:
            return count
    return 0


def _lines(count: int, size: int, part: int) -> np.ndarray:
    return np.random.default_rng([SEED, part, size]).standard_normal((size, count))


def _dealt(batches: Iterator[pa.RecordBatch], sides: int, deals: int) -> Iterator[pa.RecordBatch]:
    """One row per vector and deal: deal, cell, node, copies, unit vector, cells of all deals."""
    powers = 1 << np.arange(sides, dtype=np.int64)
    for whole in batches:
        for start in range(0, whole.num_rows, 2048):
            batch = whole.slice(start, 2048)
            vectors = batch.column("embedding").to_numpy(zero_copy_only=False)
            lengths = np.array([len(one) for one in vectors])
            for size in np.unique(lengths):
                rows = np.flatnonzero(lengths == size)
                x = np.stack(vectors[rows]).astype(np.float64)
                # By the largest component first, so that no square is too large or too small for a double.
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                on = (x @ _lines(sides * deals, size, 0) > 0).reshape(len(rows), deals, sides)
                cells = on @ powers * (1 << 16) + size
                nodes = batch.column("node").take(pa.array(rows))
                copies = batch.column("copies").take(pa.array(rows))
                raw = pa.array([row.tobytes() for row in x], pa.binary())
                all_cells = pa.array([row.tobytes() for row in np.ascontiguousarray(cells)], pa.binary())
                for deal in range(deals):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), deal, np.int32)), pa.array(cells[:, deal]), nodes, copies, raw, all_cells],
                        ["deal", "cell", "node", "copies", "vector", "cells"],
                    )


def _runs(values: np.ndarray, centres: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the values on a line, and where each centre's window begins and ends in it."""
    order = np.argsort(values)
    ordered = values[order]
    return order, np.searchsorted(ordered, centres - reach, "left"), np.searchsorted(ordered, centres + reach, "right")


def collided(left: np.ndarray, right: np.ndarray, reach: float, needed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of left and right that collide on at least ``needed`` lines: right in the window centred on left.

    A pair misses at most so many lines, so it collides on one of any more than
    that; lines beyond those only add to the pairs that the first ones gave.
    """
    if not len(left) or not len(right):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lines = _lines(LINES, left.shape[1], 1)
    on_left, on_right = left @ lines, right @ lines
    spare = LINES - needed
    found = []
    for line in range(min(spare + 1, LINES)):
        order, first, last = _runs(on_right[:, line], on_left[:, line], reach)
        sizes = last - first
        place = np.repeat(first, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        found.append(np.repeat(np.arange(len(left)), sizes) * len(right) + order[place])
    pairs, counts = np.unique(np.concatenate(found), return_counts=True)
    i, j = pairs // len(right), pairs % len(right)
    for line in range(spare + 1, LINES):
        counts += np.abs(on_right[j, line] - on_left[i, line]) <= reach
        # What is missing is missed for good.
        may = counts + (LINES - 1 - line) >= needed
        i, j, counts = i[may], j[may], counts[may]
    return i, j


def _compare(group: pd.DataFrame, threshold: float, needed: int) -> pd.DataFrame | None:
    """Links and stars of a cell, or of two blocks of a large one."""
    deal = int(group["deal"].iloc[0])
    same = bool(group["first"].iloc[0] == group["second"].iloc[0])
    left = np.flatnonzero((group["block"] == group["first"]).to_numpy())
    right = np.flatnonzero((group["block"] == group["second"]).to_numpy())
    x = np.stack([np.frombuffer(one) for one in group["vector"]])
    distance = math.sqrt(2 - 2 * threshold)
    i, j = collided(x[left], x[right], REACH * distance, needed)
    close = np.ones(len(i), bool) if not same else i != j
    for start in range(0, len(i), PAIRS):
        part = slice(start, start + PAIRS)
        cosine = np.einsum("ij,ij->i", x[left[i[part]]], x[right[j[part]]])
        close[part] &= cosine >= threshold
    i, j = i[close], j[close]
    if not len(i):
        return None
    nodes, copies = group["node"].to_numpy(), group["copies"].to_numpy()
    stars = stars_of(left[i], right[j], nodes)
    cells = np.stack([np.frombuffer(one, np.int64) for one in group["cells"]])
    counted = np.ones(len(i), bool)
    for earlier in range(deal):
        counted &= cells[left[i], earlier] != cells[right[j], earlier]
    i, j = i[counted], j[counted]
    links = np.bincount(left[i], copies[right[j]], len(group))
    if not same:
        links += np.bincount(right[j], copies[left[i]], len(group))
    some = np.flatnonzero(links)
    return pd.DataFrame(
        {
            "node": [*nodes[some], *stars[0]],
            "links": [*links[some].astype(np.int64), *[0] * len(stars[0])],
            "other": [*nodes[some], *stars[1]],
        }
    ).astype("int64")


def _compare_unit(unit: pd.DataFrame, threshold: float, needed: int) -> pd.DataFrame:
    found = [_compare(group, threshold, needed) for _, group in unit.groupby(["deal", "cell", "first", "second"], sort=False)]
    found = [one for one in found if one is not None]
    return pd.concat(found) if found else pd.DataFrame({"node": [], "links": [], "other": []}).astype("int64")


def near_vectors(vectors: DataFrame, *, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Returns vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding).

    ``n_links`` counts the other rows with a cosine of at least ``threshold``
    that were found; ``component_id`` is the least vec_id that links reach.
    Vectors that are NULL, empty, zero or hold NULL or non-finite components
    link with nothing, nor do vectors of different lengths with one another.
    Rows without vec_id are not searched: their component is NULL and they are
    not kept. Rows that repeat a vec_id are vectors of their own. An empty table
    gives no rows. Other columns are ignored.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda one: one.isNotNull() & ~F.isnan(one) & (F.abs(one) < float("inf")))
    usable = F.coalesce(finite & F.exists(x, lambda one: one != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding"))
    rows = rows.select("vec_id", "embedding", usable.alias("usable"))
    # Two hashes name a vector; equal vectors, and only they, share both.
    named = stored(rows.select("*", F.xxhash64("embedding").alias("node"), F.hash("embedding").alias("check")), "vectors")
    good = named.where("usable")
    classes = good.groupBy("node", "check").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.max("embedding").alias("embedding")
    )
    classes = stored(classes, "vector_classes")
    count = classes.count()
    sides = sides_for(count)
    deals = deals_for(sides, threshold, recall)
    dealt = classes.select("node", "copies", "embedding").mapInArrow(
        lambda batches: _dealt(batches, sides, deals),
        "deal int, cell long, node long, copies long, vector binary, cells binary",
    )
    sizes = stored(dealt.groupBy("deal", "cell").agg(F.count("*").alias("members")).where("members > 1"), "cells")
    units = (sizes.agg(F.sum("members")).first()[0] or 0) // (4 * BLOCK) + 1
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    placed = dealt.join(sizes, ["deal", "cell"]).withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod("node", "blocks").cast("int"))
    placed = placed.withColumn("pair", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumns({"first": F.least("block", "pair"), "second": F.greatest("block", "pair")})
    alone = F.xxhash64("deal", "cell", "first", "second")
    unit = F.when(F.col("blocks") > 1, alone).otherwise(F.pmod(F.xxhash64("deal", "cell"), F.lit(units)))
    needed = least_count(recall)
    found = stored(
        placed.withColumn("unit", unit)
        .drop("members", "blocks", "pair")
        .groupBy("unit")
        .applyInPandas(lambda group: _compare_unit(group, threshold, needed), "node long, links long, other long"),
        "vector_links",
    )
    edges = found.where(F.col("node") != F.col("other")).select(F.col("node").alias("a"), F.col("other").alias("b"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    tied = (
        classes.drop("embedding")
        .join(links, "node", "left")
        .join(components(edges), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    first = tied.groupBy("component").agg(F.min("first_id").alias("component_id"))
    per_class = tied.join(first, "component").select(
        "node", "check", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    linked = good.select("vec_id", "node", "check").join(per_class, ["node", "check"]).select("vec_id", "n_links", "component_id")
    alone = named.where(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).withColumn("kept", kept)
