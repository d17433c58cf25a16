"""Mixes sources to target weights.

Every document gets a hash-random key. Within its source the documents are
range-sorted by that key, running totals of their sizes say where each begins,
and the mix takes them from the start until the source's budget is used up,
going through the source again as often as the budget allows.

The running totals are built in two levels: the keys' range is cut into buckets,
as many as the root of the number of rows. Bucket sums are added up per source,
and documents within their bucket. So no task holds a source, however large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deposit_analytics.llm.common import bucket_of, hashed_key, root_buckets

WEIGHTS = (1, 2, 3)
CEILING = 3
SEED = "mix"


def mix_key(doc_id: Column, seed: str = SEED) -> Column:
    """The random place of a document in its source; the same on every run."""
    return hashed_key(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def source_label(source: Column) -> Column:
    """A name that is never NULL: '' for the NULL source, '=' and the source otherwise."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, ceiling: int = CEILING, share: float = 1.0
) -> DataFrame:
    """Adds ``target`` to (label, source_size), one row per source.

    Sources in order of code points, NULL last, take ``weights`` in turn. Their
    targets share ``share`` of all sizes by weight; none exceeds ``ceiling``
    times its source's size, and what that leaves goes to the others by weight.
    A source at its ceiling is one whose ceiling the common level (words per
    unit of weight) reaches: sources are sorted by ceiling over weight, and the
    words placed at each of those levels tell which lie below the real one.

    One row per source passes through one task; sources are named by people.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("label") == "", "label")
    below = Window.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    given = F.array(*[F.lit(float(weight)) for weight in weights])
    ranked = (
        sizes.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(given, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("most", (F.col("source_size") * ceiling).cast("double"))
        .withColumn("level", F.col("most") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything).cast("double") * share)
    )
    placed = F.sum("most").over(below) + F.col("level") * (
        F.sum("weight").over(everything) - F.sum("weight").over(below)
    )
    full = ranked.withColumn("full", placed <= F.col("budget"))
    left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everything)
    among = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    return full.select(
        "label",
        "source_size",
        F.when(F.col("full"), F.col("most")).otherwise(F.try_divide(left, among) * F.col("weight")).alias("target"),
    )


def mix(
    docs: DataFrame,
    size: Column,
    *,
    weights: Sequence[float] = WEIGHTS,
    ceiling: int = CEILING,
    share: float = 1.0,
    seed: str = SEED,
    ties: Sequence[Column] = (),
) -> DataFrame:
    """Returns doc (the whole input row), size, source_size, target, taken, copies.

    ``docs`` needs ``doc_id`` and ``source``; other columns stay inside ``doc``,
    whatever their names. ``taken`` counts the words the mix takes of the
    document: all of them for every full pass, and in the last pass up to the
    exact budget, the target rounded to whole words, so one document per source
    is cut. ``copies`` is the same for whole documents: that one document
    counts when at least half of it lies within the budget.

    NULL sources form a source of their own. A source without words has target
    0. Rows that repeat a doc_id are ordered by size and ``ties``; rows equal in
    all of these are alike. An empty table gives no rows.
    """
    buckets = root_buckets(docs.count())
    key = mix_key(F.col("doc_id"), seed)
    keyed = docs.select(
        F.struct("*").alias("doc"),
        source_label(F.col("source")).alias("label"),
        size.cast("long").alias("size"),
        key.alias("key"),
        bucket_of(key, buckets).alias("bucket"),
        F.col("doc_id").alias("id"),
        F.array(*[F.xxhash64(tie) for tie in ties]).alias("ties"),
    )
    sums = keyed.groupBy("label", "bucket").agg(F.sum("size").alias("words"))
    sources = targets(sums.groupBy("label").agg(F.sum("words").alias("source_size")), weights, ceiling, share)
    earlier = Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(sources, "label")
    within = (
        Window.partitionBy("label", "bucket")
        .orderBy("key", "id", "size", "ties")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = keyed.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        starts.select("label", "bucket", "start", "source_size", "target"), ["label", "bucket"]
    )
    budget = F.floor(F.col("target") + 0.5).cast("long")
    passes = F.when(F.col("source_size") > 0, F.expr("cast(floor(target + 0.5) as bigint) div source_size")).otherwise(0)
    before = F.col("start") + F.col("within")
    cut = placed.withColumn("passes", passes).withColumn("before", before)
    cut = cut.withColumn("rest", budget - F.col("passes") * F.col("source_size"))
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    whole = (2 * F.col("before") + F.col("size") <= 2 * F.col("rest")) & (F.col("rest") > 0)
    return cut.select(
        "doc",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + last).cast("long").alias("taken"),
        (F.col("passes") + whole.cast("long")).alias("copies"),
    )


def mixed(docs: DataFrame, size: Column, **options) -> DataFrame:
    """The documents of the mix, whole, each as often as the mix takes it."""
    taken = mix(docs, size, **options).where(F.col("copies") > 0)
    return taken.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
