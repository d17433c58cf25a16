"""Connected components by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deposit_analytics.llm.common import stored


def _down(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (high, low) of different nodes."""
    high, low = F.greatest("a", "b"), F.least("a", "b")
    return pairs.where(F.col("a") != F.col("b")).select(high.alias("a"), low.alias("b")).distinct()


def _large_star(pairs: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the least of its neighbourhood."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _down(both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the least of these."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    moved = pairs.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(moved.unionByName(least.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (a, b), NULL ends left out.

    The component is its least node, which has no row of its own. Nodes with
    millions of neighbours are no trouble: minima combine before the shuffle,
    and adaptive execution splits skewed joins. Every round is written to the
    shared folder. Rounds grow with the logarithm of the longest path.
    """
    state = None
    pairs = _down(edges.select(F.col("a").cast("long"), F.col("b").cast("long")))
    while True:
        pairs = stored(_small_star(_large_star(pairs)), "stars")
        seen = pairs.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if seen == state or seen[0] == 0:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = seen


def local_stars(links: np.ndarray, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> tuple[list, list]:
    """(node, least node) of the connected groups that a block's links make."""
    i, j = np.nonzero(links)
    return stars_of(left[i], right[j], ids)


def stars_of(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> tuple[list, list]:
    """The same for links from places ``a`` to places ``b`` of ``ids``."""
    label = ids.copy()
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        if (new == label).all():
            break
        label = new
    some = np.flatnonzero(label != ids)
    return ids[some].tolist(), label[some].tolist()
