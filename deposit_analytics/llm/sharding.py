"""Minimax contiguous shards over groups that stay together.

Groups (equal texts) are ordered by a hash of the text. The smallest capacity
for which a greedy pass fills at most the given number of shards is found by
binary search, and the greedy cuts of that capacity are the shards' bounds.

The driver never sees the groups. It holds sums over ranges of the hash: a few
thousand ranges first, then only the ranges that a cut can fall into are split
further, by one grouped scan a round, until every range a cut can touch is a
single group. The search over the ranges then equals the search over the groups.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deposit_analytics.llm.common import KEY_BITS, bucket_of, hashed_key, root_buckets, stored

SHARDS = 8
FIRST_BITS = 12
MORE_BITS = 5


@dataclass(frozen=True)
class Range:
    """Groups whose keys, shifted right by ``shift``, equal ``number``."""

    number: int
    shift: int
    size: int
    groups: int

    @property
    def first_key(self) -> int:
        return self.number << self.shift


class Ranges:
    """Ranges in key order, with the greedy passes over them."""

    def __init__(self, ranges: list[Range]):
        self.ranges = sorted(ranges, key=lambda one: one.first_key)
        self.ends = list(accumulate((one.size for one in self.ranges), initial=0))
        self.total = self.ends[-1]

    def cuts(self, capacity: int, shards: int) -> list[int]:
        """Places of the greedy cuts when no range may be divided."""
        places, at = [], 0
        for _ in range(shards):
            at = self.ends[bisect.bisect_right(self.ends, at + capacity) - 1]
            places.append(at)
        return places

    def loose_cuts(self, capacity: int, shards: int) -> list[int]:
        """The same when a range of several groups may be divided anywhere."""
        places, at = [], 0
        for _ in range(shards):
            at = min(at + capacity, self.total)
            k = bisect.bisect_right(self.ends, at) - 1
            if k < len(self.ranges) and self.ranges[k].groups == 1:
                at = max(self.ends[k], places[-1] if places else 0)
            places.append(at)
        return places

    def least(self, passes, shards: int) -> int:
        """The smallest capacity with which ``passes`` reaches the end."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if passes(middle, shards)[-1] == self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def open(self, shards: int) -> list[Range]:
        """Ranges of several groups that a cut may still fall into."""
        low, high = self.least(self.loose_cuts, shards), self.least(self.cuts, shards)
        found = []
        # The last place is the end of the table, not a cut.
        for first, last in zip(self.cuts(low, shards)[:-1], self.loose_cuts(high, shards)[:-1], strict=True):
            k = bisect.bisect_right(self.ends, first) - 1
            while k < len(self.ranges) and self.ends[k] < last:
                if self.ranges[k].groups > 1:
                    found.append(self.ranges[k])
                k += 1
        return sorted(set(found), key=lambda one: one.first_key)


def _sums(groups: DataFrame, shift: int) -> list[Range]:
    number = F.shiftrightunsigned(F.col("key"), shift)
    rows = groups.groupBy(number.alias("number")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    return [Range(row.number, shift, row.size, row.n) for row in rows.collect()]


def bounds(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[int]]:
    """The least capacity, and the first key of each shard but the first.

    ``groups`` has one row per group: key (60 bits), size. At most 2 to the
    power of 12 sums come to the driver at first, and later 32 for each of the
    ranges around the cuts, of which there are a few hundred at most.
    """
    shift = KEY_BITS - FIRST_BITS
    state = Ranges(_sums(groups, shift))
    while around := state.open(shards):
        # Ranges once left out stay out: the span of a cut only narrows.
        inside = F.shiftrightunsigned(F.col("key"), shift).isin([one.number for one in around])
        keep = [one for one in state.ranges if one not in set(around)]
        shift = max(0, shift - MORE_BITS)
        state = Ranges(keep + _sums(groups.where(inside), shift))
    capacity = state.least(state.cuts, shards)
    places = state.cuts(capacity, shards)[:-1]
    starts = {end: one.first_key for end, one in zip(state.ends, state.ranges, strict=False)}
    return capacity, [starts.get(place, 1 << KEY_BITS) for place in places]


def text_key(text: Column) -> Column:
    """Equal texts have equal keys; NULL counts as the empty text."""
    return hashed_key(F.coalesce(text, F.lit("")))


def text_size(text: Column) -> Column:
    """UTF-8 bytes and one more, so that empty documents count too."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def assign(docs: DataFrame, key: Column, size: Column, shards: int = SHARDS) -> DataFrame:
    """Returns doc (the whole input row), size, shard, slot.

    Rows of equal ``key`` share a shard. Slots number the rows of a shard from
    0 without gaps, by a hash of doc_id and key: rows of one hot group are
    numbered by many tasks. Rows equal in doc_id and key are alike, and which
    of them gets which slot is open. An empty table gives no rows; more shards
    than groups leave shards empty.
    """
    rows = docs.select(F.struct("*").alias("doc"), key.alias("key"), size.cast("long").alias("size"), "doc_id")
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    groups = stored(groups, "groups")
    total = groups.agg(F.sum("n")).first()[0] or 0
    starts = bounds(groups, shards)[1] if total else []
    shard = sum((F.col("key") >= F.lit(start)).cast("int") for start in starts) if starts else F.lit(0)
    names = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("doc_id", "key")]
    place = hashed_key(F.concat_ws(":", F.lit("slot"), *names))
    placed = rows.withColumn("shard", shard).withColumn("place", place)
    placed = placed.withColumn("bucket", bucket_of(F.col("place"), root_buckets(total)))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "bucket").orderBy("place", "doc_id", "key")
    return (
        placed.withColumn("row", F.row_number().over(within))
        .join(offsets, ["shard", "bucket"])
        .select("doc", "size", "shard", (F.col("offset") + F.col("row") - 1).cast("long").alias("slot"))
    )
