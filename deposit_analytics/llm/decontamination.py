"""Finds benchmark items inside documents.

Texts become five-word shingle hashes. Documents are covered by windows of as many
shingles as the items have, in size classes that double, and each window gets a
64-bit SimHash: bit by bit the majority of its shingles' hashes. An item is
described by the windows of its class at every offset, so wherever a copy begins in
a document, the document's grid holds a window that lies on one of the item's. It
is also described by the windows of a small class, at every place of the document:
of an item cut up by edits and insertions, some run stays whole that is at least
as long. How long is counted from the weight that a match may lack and from the
shingles that a cut costs.

A document that holds no shingle of any item can't match, whatever its
fingerprints; windows are made for the others only.

Counting 64 majorities for every window is done on whole words of bits: the
counters of all 64 bits are kept as planes (all lowest bits in one number, all
second bits in the next), and two windows' counters are added by a few AND, OR
and XOR. Large windows are sums of smaller ones.

Fingerprints are cut into four blocks of 16 bits. The index holds every item
block with every single bit flipped, so two fingerprints that differ in at most
seven bits agree with it in some block: no pair within that radius is lost.
Candidates are then checked exactly, on the weights of the item's shingles that
the whole document holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deposit_analytics.llm.common import SPACES, row_key, stored, without_rows

WIDTH = 5
THRESHOLD = 0.8
RADIUS = 7
BLOCKS = 4
BLOCK_BITS = 16
CLASSES = (1, 4, 8, 16, 32, 64)
SMALLEST = 8
SEGMENT = 4096
# Rows of some numbers each: tens of megabytes at most.
BROADCAST_ROWS = 2_000_000

# The ASCII space characters that separate words.
_TRIMMED = " \t\n\x0b\f\r"


def stride(size: int) -> int:
    """Shingles between the windows of a class; those of the smallest classes lie at every place."""
    return 1 if size <= SMALLEST else size // 2


def item_class(shingles: Column) -> Column:
    """The largest class of which an item holds a grid window wherever it begins."""
    fits = [F.when(shingles >= size + stride(size) - 1, F.lit(size)) for size in CLASSES]
    return F.greatest(*fits, F.lit(None).cast("int"))


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text; empty for NULL and for texts without words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_TRIMMED))
    hashes = F.transform(F.split(trimmed, SPACES), lambda word: F.xxhash64(word))
    return F.when(trimmed == "", F.array().cast("array<long>")).otherwise(hashes)


def shingle_hashes(words: str) -> Column:
    """Hashes of the shingles of a column of word hashes; shorter texts have one shingle."""
    column = F.col(words)
    every = F.transform(
        column, lambda _, i: F.xxhash64(*[F.get(column, i + place) for place in range(WIDTH)])
    )
    count = F.size(column)
    return F.slice(every, F.lit(1), F.greatest(count - (WIDTH - 1), F.least(count, F.lit(1))))


def _add(left: Column, right: Column, planes: int) -> Column:
    """The sum of two bit-plane counters, with one plane more."""
    out, carry = [], None
    for place in range(planes):
        a, b = left[f"p{place}"], right[f"p{place}"]
        odd, both = a.bitwiseXOR(b), a.bitwiseAND(b)
        out.append(odd if carry is None else odd.bitwiseXOR(carry))
        carry = both if carry is None else both.bitwiseOR(odd.bitwiseAND(carry))
    return F.struct(*[plane.alias(f"p{place}") for place, plane in enumerate([*out, carry])])


def _majority(counter: Column, planes: int) -> Column:
    """Bits counted in more than half of 2 to the power of ``planes`` - 1 hashes."""
    all_of, half = counter[f"p{planes - 1}"], counter[f"p{max(0, planes - 2)}"]
    if planes == 1:
        return all_of
    more = None
    for place in range(planes - 2):
        more = counter[f"p{place}"] if more is None else more.bitwiseOR(counter[f"p{place}"])
    return all_of if more is None else all_of.bitwiseOR(half.bitwiseAND(more))


def _from(array: str, first: int, ratio: int) -> Column:
    """Every ``ratio``-th element from the ``first``."""
    if ratio == 1:
        return F.filter(array, lambda _, i: i >= first) if first else F.col(array)
    return F.filter(array, lambda _, i: (i >= first) & ((i - first) % ratio == 0))


def _sums_of_two(hashes: str, step: int) -> Column:
    """Counters of the hashes at every ``step``-th place and the next."""
    count = F.floor((F.size(hashes) - 2) / step).cast("int")
    none = F.slice(F.array(F.struct(F.lit(0).cast("long").alias("p0"), F.lit(0).cast("long").alias("p1"))), 1, 0)

    def both(place: Column) -> Column:
        a, b = F.get(hashes, place * step), F.get(hashes, place * step + 1)
        return F.struct(a.bitwiseXOR(b).alias("p0"), a.bitwiseAND(b).alias("p1"))

    return F.when(count >= 0, F.transform(F.sequence(F.lit(0), count), both)).otherwise(none)


def _sums(left: Column, right: Column, planes: int) -> Column:
    return F.zip_with(left, right, lambda a, b: _add(a, b, planes))


def _prints(sums: str, size: int, step: int, planes: int) -> Column:
    return F.transform(
        sums,
        lambda one, i: F.struct(
            F.lit(size).alias("size"), (i * step).alias("start"), _majority(one, planes).alias("print")
        ),
    )


def _windows(frame: DataFrame, sizes: tuple[int, ...], steps: dict[int, int]) -> DataFrame:
    """Adds ``windows``: size, start and print of the windows of column ``shingles``.

    ``steps`` gives the shingles between windows of each class of ``sizes``.
    """
    largest, found = max(sizes), []
    if 1 in sizes or largest == 1:
        frame = frame.withColumn("sum1", F.transform("shingles", lambda one: F.struct(one.alias("p0"))))
        found.append(_prints("sum1", 1, 1, 1))
    if largest == 1:
        return frame.withColumn("windows", found[0])
    # Sums of two come straight from the hashes, on the grid of the finest class.
    size, step, planes = 2, min([2, *(steps[one] for one in sizes)]), 2
    frame = frame.withColumn("sum2", _sums_of_two("shingles", step))
    while True:
        if size in sizes:
            found.append(_prints(f"sum{size}", size, step, planes))
        if size == largest:
            break
        # The grid widens as soon as no later class needs the finer one.
        wider = min(size * 2, min(steps[one] for one in sizes if one > size))
        # A window that reaches beyond the text adds to nothing, and its print is NULL.
        sums = _sums(_from(f"sum{size}", 0, wider // step), _from(f"sum{size}", size // step, wider // step), planes)
        size, step, planes = size * 2, wider, planes + 1
        frame = frame.withColumn(f"sum{size}", sums)
    return frame.withColumn("windows", F.concat(*found))


def _block_value(fingerprint: Column, block: int) -> Column:
    return F.shiftrightunsigned(fingerprint, block * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _block_key(size: Column, block: int, value: Column) -> Column:
    """One number for class, block and the block's bits."""
    return (size.cast("long") * BLOCKS + block) * (1 << BLOCK_BITS) + value


def _flipped(block: int) -> Column:
    """Keys of a block of ``window``: as it is, and with each bit flipped."""
    flips = [F.lit(flip).cast("long") for flip in (0, *(1 << bit for bit in range(BLOCK_BITS)))]
    value = _block_value(F.col("window.print"), block)
    return F.transform(F.array(*flips), lambda flip: _block_key(F.col("window.size"), block, value.bitwiseXOR(flip)))


def items_of(benchmark: DataFrame) -> DataFrame:
    """item, item_id, shingles, size for every item with words; equal items once."""
    words = benchmark.select(
        "item_id", F.xxhash64("item_id", "text").alias("item"), word_hashes(F.col("text")).alias("words")
    ).dropDuplicates(["item"])
    items = words.withColumn("shingles", shingle_hashes("words"))
    return items.select("item", "item_id", "shingles", item_class(F.size("shingles")).alias("class")).where(
        F.size("shingles") > 0
    )


def _index(items: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """key, item, offset, item_print: the blocks of all windows of the items in their classes."""
    every = _windows(items, sizes, dict.fromkeys(sizes, 1))
    prints = every.select("item", "class", "small", F.explode_outer("windows").alias("window")).where(
        F.col("window.size").isin(F.col("class"), F.col("small"))
    )
    keys = F.concat(*[_flipped(block) for block in range(BLOCKS)])
    return prints.select(
        F.explode_outer(keys).alias("key"),
        "item",
        F.col("window.start").alias("offset"),
        F.col("window.print").alias("item_print"),
    )


def _small_classes(weights: DataFrame, threshold: float) -> DataFrame:
    """item, small: the largest of the small classes of which every match of the item holds a whole window.

    A match lacks at most the lightest shingles, and a cut between words costs
    all shingles but one of those across it; the longest of the runs that stay is
    no shorter than their mean.
    """
    order = Window.partitionBy("item").orderBy(F.desc("weight"), "shingle")
    heavier = F.coalesce(F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    needed = weights.withColumn("needed", (heavier < (threshold - 1e-6) * F.col("whole")).cast("int"))
    runs = needed.groupBy("item").agg(F.sum("needed").alias("held"), F.count("*").alias("n"))
    run = longest_run(F.col("held"), F.col("n") - F.col("held"))
    fits = [F.when(run >= size, F.lit(size)) for size in CLASSES if size <= SMALLEST]
    return runs.select("item", F.greatest(*fits, F.lit(None).cast("int")).alias("small"))


def longest_run(held: Column, lacking: Column) -> Column:
    """The least length of the longest run of shingles if ``lacking`` are gone by cuts between words."""
    return F.ceil(held / (F.floor(lacking / (WIDTH - 1)) + 1))


def holding(docs: DataFrame, known: DataFrame, words: Callable[[Column], Column] = word_hashes) -> DataFrame:
    """row, doc_id, shingles of the rows of ``docs`` (row, doc_id, text) that hold one of the shingles ``known``."""
    known = stored(known.select("shingle").distinct(), "known")
    known = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
    hashed = docs.select("row", words(F.col("text")).alias("words"))
    single = hashed.select("row", F.explode_outer(shingle_hashes("words")).alias("shingle"))
    some = stored(single.join(known, "shingle", "left_semi").select("row").distinct(), "holding")
    hashed = docs.join(some, "row", "left_semi").select("row", "doc_id", words(F.col("text")).alias("words"))
    return stored(hashed.select("row", "doc_id", shingle_hashes("words").alias("shingles")).dropDuplicates(["row"]), "shingled")


def segmented(shingled: DataFrame, step: int, overlap: int) -> DataFrame:
    """row, from, shingles: the same in pieces of ``step`` and ``overlap`` more, so that long texts are many rows."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("shingles") - 1, F.lit(0)), F.lit(step))
    parts = F.transform(
        starts,
        lambda start: F.struct(
            start.alias("from"), F.slice(F.col("shingles"), start + 1, F.lit(step + overlap)).alias("shingles")
        ),
    )
    # Outer: for an inner explode the optimizer adds a filter on the size of the
    # array, and computes the whole array once more for it.
    return shingled.select("row", F.explode_outer(parts).alias("part")).select("row", "part.from", "part.shingles")


def _candidates(shingled: DataFrame, items: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """Distinct (row, item, at): the item's shingle 0 would lie on the document's shingle ``at``."""
    overlap = max(sizes) + max(stride(size) for size in sizes)
    step = SEGMENT - SEGMENT % max(stride(size) for size in sizes)
    segments = segmented(shingled, step, overlap)
    covered = _windows(segments, sizes, {size: stride(size) for size in sizes})
    windows = covered.select("row", "from", F.explode_outer("windows").alias("window"))
    keys = {
        f"key{block}": _block_key(F.col("window.size"), block, _block_value(F.col("window.print"), block))
        for block in range(BLOCKS)
    }
    place = (F.col("from") + F.col("window.start")).alias("start")
    prints = windows.select(
        "row", place, F.col("window.print").alias("print"), *[key.alias(name) for name, key in keys.items()]
    )
    # Unpivot stays inside generated code, up to the look-up in the index.
    probes = prints.unpivot(["row", "start", "print"], list(keys), "block", "key")
    index = stored(_index(items, sizes), "index")
    # The index grows with the benchmark alone; a large one is joined by shuffling.
    known = F.broadcast(index) if index.count() <= BROADCAST_ROWS else index
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS
    return (
        probes.join(known, "key")
        .where(near)
        .select("row", "item", (F.col("start") - F.col("offset")).alias("at"))
        .distinct()
    )


def _weights(items: DataFrame) -> DataFrame:
    """item, shingle, weight, whole: distinct shingles, and the weight of all those of the item.

    A shingle that several items share says less: it weighs one over their number.
    """
    single = items.select("item", F.explode(F.array_distinct("shingles")).alias("shingle"))
    shared = single.groupBy("shingle").agg((F.lit(1.0) / F.count("*")).alias("weight"))
    whole = F.sum("weight").over(Window.partitionBy("item"))
    return single.join(shared, "shingle").select("item", "shingle", "weight", whole.alias("whole"))


def _places(found: DataFrame, scored: DataFrame, shingled: DataFrame, items: DataFrame, weights: DataFrame) -> DataFrame:
    """row, item, at: where most of the item's weight lies within its length, the first of equals."""
    parts = weights.groupBy("item").agg(F.collect_list(F.struct("shingle", "weight")).alias("parts"))
    long = items.select("item", F.size("shingles").alias("long"))
    pad = F.floor(F.col("long") / 4).cast("int") + 8
    first = F.greatest(F.col("at") - pad, F.lit(0))
    last = F.col("at") + F.col("long") + pad
    span = F.slice("shingles", first + 1, F.greatest(last - first, F.lit(0)))
    near = F.aggregate(
        "parts",
        F.lit(0.0),
        lambda total, part: total + F.when(F.array_contains(F.col("span"), part["shingle"]), part["weight"]).otherwise(0.0),
    )
    spans = (
        found.join(scored.select("row", "item"), ["row", "item"])
        .join(shingled.select("row", "shingles"), "row")
        .join(long, "item")
        .join(parts, "item")
        .select("row", "item", "at", "parts", span.alias("span"))
        .select("row", "item", "at", near.alias("near"))
    )
    return spans.groupBy("row", "item").agg(F.min_by("at", F.struct(-F.col("near"), F.col("at"))).alias("at"))


def _matches(docs: DataFrame, benchmark: DataFrame, threshold: float) -> DataFrame:
    """row, doc_id, item_id, similarity, at for every row (its key) and every item found in it."""
    text = F.col("text").cast("string").alias("text")
    docs = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), "doc_id", text)
    items = stored(items_of(benchmark.select("item_id", text)), "items")
    weights = stored(_weights(items), "weights")
    items = stored(items.join(_small_classes(weights, threshold), "item"), "classed_items")
    sizes = {size for row in items.select("class", "small").distinct().collect() for size in row}
    shingled = holding(docs, weights)
    found = stored(_candidates(shingled, items, tuple(sorted(sizes or {CLASSES[0]}))), "found")
    few = weights.count() <= BROADCAST_ROWS

    def small(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if few else frame

    held = (
        found.select("row", "item")
        .distinct()
        .join(shingled.select("row", F.col("shingles").alias("own")), "row")
        .join(small(items.select("item", "shingles")), "item")
        .select("row", "item", F.explode_outer(F.array_intersect("shingles", "own")).alias("shingle"))
    )
    scored = (
        held.join(small(weights), ["item", "shingle"])
        .groupBy("row", "item")
        .agg((F.sum("weight") / F.first("whole")).alias("similarity"))
        .where(F.col("similarity") >= threshold - 1e-9)
    )
    scored = stored(scored, "scored")
    return (
        scored.join(small(items.select("item", "item_id")), "item")
        .join(_places(found, scored, shingled, items, weights), ["row", "item"], "left")
        .join(shingled.select("row", "doc_id"), "row")
    )


def contained_items(docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """Returns doc_id, item_id, similarity, at for every item found in a document.

    The similarity is the share of the weight of the item's distinct shingles
    that occurs anywhere in the document, so parts that lie apart add up. It is
    at least ``threshold``. An item is found by one of its windows, so some run of
    it must be whole in the document (see ``_small_classes``): documents that hold
    its shingles in another order may be missed. ``at`` is the place, as the number
    of the word there, around which most of that weight lies (with a quarter of the
    item's length and eight shingles to either side), the first of equals. Words are
    runs of non-space characters. A text of one to four words has one shingle and
    matches only its like; texts without words or NULL match nothing, and rows
    without doc_id are not reported. Rows that repeat a doc_id with another text are
    judged on their own and reported once, by the larger similarity, as are
    repeated items. Empty tables give no rows. Other columns are ignored.
    """
    placed = _matches(docs, benchmark, threshold).where(F.col("doc_id").isNotNull())
    return placed.groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"),
        F.greatest(F.min_by("at", F.struct(-F.col("similarity"), F.col("at"))), F.lit(0)).alias("at"),
    )


def without_items(docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows in which no item was found, with their columns as they are.

    Every row is judged by its own text, whether or not it has a doc_id, and
    whichever others share it.
    """
    return without_rows(docs, _matches(docs, benchmark, threshold)).select(*docs.columns)
