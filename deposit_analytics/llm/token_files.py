"""Token ids of documents in Simple-8b files.

A file row is a frame: whole documents in ascending doc_id order, some hundred
thousand ids. Its ids are cut into blocks of 128. In a block every 64-bit word
holds a selector of four bits and as many ids as fit the selector's width into
the other sixty; the last word of a block may be part empty. An id too wide for
sixty bits is an escape: its word holds a place in the frame's list of escapes.
The word at which each block begins is stored, so that all blocks are packed
and unpacked side by side, and any can be read alone.

Documents are dealt out by ranges of doc_id. A frame knows the ids before it in
its range; those of the ranges before are added when reading.
"""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deposit_analytics.llm import shingles

BLOCK = 128
FRAME = 1 << 18
END_ID = 0
HELD_UNITS = 600_000
LONGEST_HELD = 48

# Ids in a word by selector, and the selector of an escape.
COUNTS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = len(COUNTS)
PAYLOAD_BITS = 60

_COUNT_OF = np.array([*COUNTS, 1, 1], np.int64)

# Byte classes: space, other ASCII space, ASCII letter, ASCII punctuation.
_CLASS = np.zeros(256, np.uint8)
_CLASS[32] = 1
_CLASS[9:14] = 2
for _code in range(33, 127):
    _CLASS[_code] = 0 if chr(_code).isdigit() else 4 if chr(_code).isalpha() else 8

# Space characters beyond ASCII, as UTF-8.
_WIDE_SPACE = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
_MAYBE_WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")


def _padded(values: np.ndarray, fill: int = 0) -> np.ndarray:
    """Rows of one block each."""
    rows = -(-len(values) // BLOCK)
    out = np.full(rows * BLOCK, fill, values.dtype)
    out[: len(values)] = values
    return out.reshape(rows, BLOCK)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the word at which each block begins, and escapes, of 64-bit ids."""
    ids = ids.astype(np.uint64)
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    wide = ids >> np.uint64(PAYLOAD_BITS) > 0
    values = np.where(wide, (np.cumsum(wide) - 1).astype(np.uint64), ids)
    # Rounding may add a bit to a very wide id, which then takes a wider slot.
    bits = np.minimum(np.frexp(values.astype(np.float64))[1], PAYLOAD_BITS).astype(np.uint8)
    bits[wide] = PAYLOAD_BITS + 1
    values, bits = _padded(values), _padded(bits)
    rows = len(values)
    best = np.where(bits > PAYLOAD_BITS, ESCAPE, 0).astype(np.uint8)
    most, before = bits, 1
    for selector, count in enumerate(COUNTS[1:], 1):
        shifted = np.zeros_like(most)
        shifted[:, : BLOCK - (count - before)] = most[:, count - before :]
        most, before = np.maximum(most, shifted), count
        best[most <= PAYLOAD_BITS // count] = selector
    flat = np.concatenate([values, np.zeros((rows, COUNTS[-1]), np.uint64)], axis=1).ravel()
    line = np.arange(rows) * (BLOCK + COUNTS[-1])
    sizes = np.full(rows, BLOCK)
    sizes[-1] = len(ids) - (rows - 1) * BLOCK
    at, step, words = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros((rows, BLOCK), np.uint64)
    while len(active := np.flatnonzero(at < sizes)):
        selectors = best[active, at[active]]
        for selector in np.unique(selectors):
            mine = active[selectors == selector]
            count = _COUNT_OF[selector]
            width = PAYLOAD_BITS // count
            word = np.full(len(mine), int(selector) << PAYLOAD_BITS, np.uint64)
            first = line[mine] + at[mine]
            for place in range(count):
                word |= flat[first + place] << np.uint64(place * width)
            words[mine, step[mine]] = word
            at[mine] += count
        step[active] += 1
    begins = np.concatenate([[0], np.cumsum(step)[:-1]]).astype(np.uint32)
    return words[np.arange(BLOCK)[None, :] < step[:, None]], begins, ids[wide]


def unpack(words: np.ndarray, begins: np.ndarray, escapes: np.ndarray, count: int) -> np.ndarray:
    """The ids that ``pack`` was given, all blocks at once."""
    out = np.zeros(count, np.uint64)
    if not count:
        return out
    selectors = (words >> np.uint64(PAYLOAD_BITS)).astype(np.int64)
    taken = np.cumsum(_COUNT_OF[selectors]) - _COUNT_OF[selectors]
    starts = begins.astype(np.int64)
    block = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words))))
    place = taken - taken[starts][block] + block * BLOCK
    ends = np.minimum((block + 1) * BLOCK, count)
    for selector in np.unique(selectors):
        mine = np.flatnonzero(selectors == selector)
        slots = _COUNT_OF[selector]
        width = PAYLOAD_BITS // slots
        mask = np.uint64((1 << width) - 1)
        for slot in range(slots):
            value = words[mine] >> np.uint64(slot * width) & mask
            to = place[mine] + slot
            inside = to < ends[mine]
            out[to[inside]] = escapes[value[inside].astype(np.int64)] if selector == ESCAPE else value[inside]
    return out


class Encoder:
    """Ids of many texts, each distinct run between safe cuts encoded once.

    The tokenizer's byte-level pre-tokenizer never joins characters across the
    end of a run of other characters and the space after it, or across an ASCII
    letter and ASCII punctuation. Of several space characters before another
    character it takes the last for itself: a space goes with the character, a
    line end or tab stands alone. Texts are cut there, so before that last one
    and, if it is no space, after it. Runs that were met before are looked up,
    and the library encodes the others. A text with a special token or with
    spaces beyond ASCII goes to the library whole. The runs held are bounded.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = tuple(
            token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()
        )
        self.known: dict[str, bytes] = {}

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        kind = _CLASS[data]
        space = kind & 3
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (
            ((space[1:] > 0) & (space[:-1] == 0))
            | ((kind[:-1] == 2) & (space[1:] == 0))
            | ((kind[:-1] == 4) & (kind[1:] == 8))
        )
        # The last of several space characters, unless the text ends with it.
        last = np.zeros(len(data) + 1, bool)
        last[1:-2] = (space[:-2] > 0) & (space[1:-1] > 0) & (space[2:] == 0)
        last[offsets[1:] - 1] = False
        cut |= last
        raw = data.tobytes()
        if any(raw.find(mark) >= 0 for mark in (*_MAYBE_WIDE, *self.specials)):
            for first, last in zip(offsets[:-1], offsets[1:], strict=True):
                text = raw[first:last]
                if _WIDE_SPACE.search(text) or any(mark in text for mark in self.specials):
                    cut[first:last] = False
        cut[offsets] = True
        return np.flatnonzero(cut)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, and the ids before each."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        cuts = self._cuts(data, offsets)
        buffers = [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data.tobytes())]
        coded = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, buffers).dictionary_encode()
        units = coded.dictionary.to_pylist()
        new = [unit for unit in units if unit not in self.known]
        fresh: dict[str, bytes] = {}
        for first in range(0, len(new), 8192):
            part = new[first : first + 8192]
            # Once full, the runs held stay: those met first are the frequent ones.
            room = len(self.known) < HELD_UNITS
            for unit, done in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                (self.known if room and len(unit) <= LONGEST_HELD else fresh)[unit] = array("I", done.ids).tobytes()
        known = self.known
        parts = [known[unit] if unit in known else fresh[unit] for unit in units]
        flat = np.frombuffer(b"".join(parts), np.uint32)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        starts = np.cumsum(lengths) - lengths
        codes = coded.indices.to_numpy()
        sizes = lengths[codes]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(starts[codes] - (ends - sizes), sizes) + np.arange(int(ends[-1]))]
        return ids, np.concatenate([[0], ends])[np.searchsorted(cuts, offsets)]


def _encoder(path: str) -> Encoder:
    """The worker process's encoder, kept from task to task."""
    held = sys.modules.setdefault("corpus_encoders", types.ModuleType("corpus_encoders")).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


_FRAME = (
    "start long, doc_ids array<long>, counts array<long>, words binary, begins binary, escapes binary"
)


def _frame(start: int, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    words, begins, escapes = pack(ids)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([start]),
            pa.array([doc_ids], pa.list_(pa.int64())),
            pa.array([counts.tolist()], pa.list_(pa.int64())),
            *[pa.array([part.tobytes()], pa.binary()) for part in (words, begins, escapes)],
        ],
        ["start", "doc_ids", "counts", "words", "begins", "escapes"],
    )


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Frames of the sorted documents of one range."""
    encode = _encoder(path)
    start, doc_ids, counts, held = 0, [], [], []
    for batch in batches:
        names = batch.column("doc_id").to_pylist()
        data, offsets = shingles.text_bytes(batch.column("text"))
        for first, last in shingles.chunks(offsets):
            low, high = offsets[first], offsets[last]
            ids, begins = encode(data[low:high], offsets[first : last + 1] - low)
            doc_ids += names[first:last]
            counts.append(np.diff(begins) + 1)
            held.append(np.insert(ids, begins[1:], end_id))
            if sum(map(len, held)) >= FRAME:
                yield _frame(start, doc_ids, np.concatenate(counts), ids := np.concatenate(held))
                start, doc_ids, counts, held = start + len(ids), [], [], []
    if doc_ids:
        yield _frame(start, doc_ids, np.concatenate(counts), np.concatenate(held))


def write(docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int = END_ID) -> None:
    """Encodes ``docs`` (doc_id, text) and writes their ids, each document's followed by ``end_id``.

    NULL and empty texts have the end id alone. Documents go in ascending
    doc_id order, NULL first; rows that repeat a doc_id follow one another by
    text. An empty table writes no frames. Other columns are ignored.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    frames = ordered.mapInArrow(lambda batches: _encoded(batches, tokenizer_path, end_id), _FRAME)
    frames.withColumn("part", F.spark_partition_id()).write.parquet(folder)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            counts = np.array(row["counts"], np.int64)
            ends = np.cumsum(counts)
            arrays = [np.frombuffer(row[name], kind) for name, kind in _KINDS.items()]
            ids = unpack(*arrays, int(ends[-1])).astype("<u4")
            begins = ends - counts
            values = pa.Array.from_buffers(
                pa.binary(),
                len(counts),
                [None, pa.py_buffer(np.append(begins, ends[-1]).astype(np.int32) * np.int32(4)), pa.py_buffer(ids.tobytes())],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(counts), row["part"], np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(begins + row["start"]),
                    pa.array(counts),
                    values,
                ],
                ["part", "doc_id", "within", "n_tokens", "ids"],
            )


_KINDS = {"words": np.uint64, "begins": np.uint32, "escapes": np.uint64}


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Returns doc_id, start, n_tokens, ids of every document of the files.

    ``start`` counts the ids of all documents before it, ``ids`` holds unsigned
    little-endian 32-bit numbers. One row per range of documents passes through
    one task, to add up where each range begins.
    """
    frames = spark.read.parquet(folder)
    size = F.aggregate("counts", F.lit(0).cast("long"), lambda total, one: total + one)
    parts = frames.groupBy("part").agg(F.sum(size).alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("begin"))
    kinds = "part int, doc_id long, within long, n_tokens long, ids binary"
    return (
        frames.select("part", "start", "doc_ids", "counts", *_KINDS)
        .mapInArrow(_decoded, kinds)
        .join(F.broadcast(begins), "part")
        .select("doc_id", (F.col("begin") + F.col("within")).alias("start"), "n_tokens", "ids")
    )
