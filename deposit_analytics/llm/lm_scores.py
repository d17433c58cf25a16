"""Stupid-backoff scores of documents, from n-gram counts of the whole corpus.

Documents are gathered into chunks of some megabytes, stored as a word list and
codes, in buckets by chunk. For every order, each chunk's distinct n-grams, with their
counts in the chunk, go to the partitions of their hashes. There the counts of all
chunks are added up: that is the count table of the order. The totals go back to the
chunks that asked, where they are joined to the n-grams of every position and summed
per document.

An n-gram travels once per chunk, however often it occurs, so a hot word is one
entry per chunk in its partition and no partition holds a hot group. It is named by all 64
bits of its hash; the sorted hashes of a chunk travel as differences.

A document is scored by the counts of the others: its own occurrences are taken
out, so that a text repeated elsewhere scores high and a unique one backs off.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deposit_analytics.llm import shingles
from deposit_analytics.sources import sinks

ORDER = 3
BACKOFF = 0.4
UNSEEN = 0.5
CHUNK_BYTES = 10 << 20
PART_GRAMS = 2_000_000

_STEP = np.uint64(0xA0761D6478BD642F)

# Differences of sorted hashes are even noise in their low bytes; the bytes above compress.
NOISE_BYTES = 5


def _planes(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes, the low bytes of all first."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def _numbers(raw: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 8 * count, codec="zstd"), np.uint8).reshape(8, count)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _packed(hashes: np.ndarray) -> bytes:
    """Ascending hashes as their differences: low bytes as they are, then the planes of the rest."""
    steps = np.diff(hashes, prepend=np.uint64(0)).astype("<u8")
    low = steps.view(np.uint8).reshape(-1, 8)[:, :NOISE_BYTES]
    return low.tobytes() + _planes(steps >> np.uint64(8 * NOISE_BYTES))


def _unpacked(raw: bytes, count: int) -> np.ndarray:
    steps = np.zeros((count, 8), np.uint8)
    cut = count * NOISE_BYTES
    steps[:, :NOISE_BYTES] = np.frombuffer(raw[:cut], np.uint8).reshape(count, NOISE_BYTES)
    high = _numbers(raw[cut:], count) << np.uint64(8 * NOISE_BYTES)
    return np.cumsum(steps.view("<u8").ravel() + high, dtype=np.uint64)


def grams(words: np.ndarray, offsets: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every n up to ``order``: the places that end an n-gram inside a document, and its hash."""
    place = np.arange(len(words), dtype=np.int32) - np.repeat(offsets[:-1].astype(np.int32), np.diff(offsets))
    hashes = shingles.mixed(words ^ _STEP)
    for n in range(1, order + 1):
        if n > 1:
            with np.errstate(over="ignore"):
                hashes = np.concatenate([hashes[:1], shingles.mixed(hashes[:-1] * _STEP + words[1:])])
        at = np.flatnonzero(place >= n - 1).astype(np.int32)
        yield at, hashes[at]


def _chunk(number: int, doc_ids: list, words: list[np.ndarray], sizes: list[np.ndarray]) -> pa.RecordBatch:
    every = np.concatenate(words)
    vocabulary, codes, uses = np.unique(every, return_inverse=True, return_counts=True)
    # Frequent words have small codes, which compress.
    frequent = np.argsort(-uses, kind="stable")
    rank = np.empty(len(frequent), np.int64)
    rank[frequent] = np.arange(len(frequent))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number]),
            pa.array([len(every)]),
            pa.array([doc_ids], pa.list_(pa.int64())),
            pa.array([np.concatenate(sizes).astype(np.int64).tobytes()], pa.binary()),
            pa.array([vocabulary[frequent].tobytes()], pa.binary()),
            pa.array([_planes(rank[codes])], pa.binary()),
        ],
        ["chunk", "n_words", "doc_ids", "sizes", "vocabulary", "codes"],
    )


_CHUNK = "chunk long, n_words long, doc_ids array<long>, sizes binary, vocabulary binary, codes binary"


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    doc_ids, words, sizes, held = [], [], [], 0
    for batch in batches:
        names = batch.column("doc_id").to_pylist()
        data, offsets = shingles.text_bytes(batch.column("text"))
        for first, last in shingles.chunks(offsets):
            low, high = offsets[first], offsets[last]
            hashes, at = shingles.word_hashes(data[low:high], offsets[first : last + 1] - low)
            doc_ids += names[first:last]
            words.append(hashes)
            sizes.append(np.diff(at))
            held += high - low
            if held >= CHUNK_BYTES:
                yield _chunk(number, doc_ids, words, sizes)
                number, doc_ids, words, sizes, held = number + 1, [], [], [], 0
    if doc_ids:
        yield _chunk(number, doc_ids, words, sizes)


def _opened(sizes: bytes, vocabulary: bytes, codes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a chunk, and the words before each document."""
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
    return np.frombuffer(vocabulary, np.uint64)[_numbers(codes, int(offsets[-1]))], offsets


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Parts of even ranges; a larger hash has no smaller part."""
    return (hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


_ASKED = "n int, part long, chunk long, n_grams long, grams binary, counts binary"


def _asked(batches: Iterator[pa.RecordBatch], order: int, parts: int) -> Iterator[pa.RecordBatch]:
    """By order and part: the chunk's distinct n-grams, ascending, and their counts in the chunk."""
    for batch in batches:
        for row in batch.to_pylist():
            for n, (_, found) in enumerate(grams(*_opened(row["sizes"], row["vocabulary"], row["codes"]), order), 1):
                hashes, counts = np.unique(found, return_counts=True)
                owners, starts = np.unique(_part(hashes, parts), return_index=True)
                pieces = list(zip(np.split(hashes, starts[1:]), np.split(counts, starts[1:]), strict=True))[: len(owners)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n] * len(owners), pa.int32()),
                        pa.array(owners.astype(np.int64)),
                        pa.array([row["chunk"]] * len(owners), pa.int64()),
                        pa.array([len(one) for one, _ in pieces], pa.int64()),
                        pa.array([_packed(one) for one, _ in pieces], pa.binary()),
                        pa.array([_planes(one) for _, one in pieces], pa.binary()),
                    ],
                    ["n", "part", "chunk", "n_grams", "grams", "counts"],
                )


def _totals(group: pd.DataFrame) -> pd.DataFrame:
    """One part of an order's count table, answered to every chunk that asked."""
    sizes = group["n_grams"].to_numpy()
    asked = np.concatenate([_unpacked(*one) for one in zip(group["grams"], sizes, strict=True)])
    counts = np.concatenate([_numbers(*one) for one in zip(group["counts"], sizes, strict=True)])
    table, place = np.unique(asked, return_inverse=True)
    totals = np.bincount(place, counts, len(table)).astype(np.uint64)[place]
    answers = np.split(totals, np.cumsum(sizes)[:-1])
    return group[["n", "part", "chunk", "n_grams"]].assign(totals=[_planes(one) for one in answers])


def _others(hashes: np.ndarray, doc: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """How often other documents have the n-gram of each place.

    ``totals`` are those of the distinct hashes in ascending order. Places come by
    document, so that in a stable sort a document's own occurrences lie together.
    """
    if not len(hashes):
        return np.zeros(0)
    by_hash = np.argsort(hashes, kind="stable")
    ordered = hashes[by_hash]
    new_hash = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    ordered = doc[by_hash]
    own = new_hash | np.concatenate([[True], ordered[1:] != ordered[:-1]])
    starts = np.flatnonzero(own)
    owned = np.diff(starts, append=len(hashes))
    # One value for each run of a document's own occurrences, put back to their places.
    others = totals[np.cumsum(new_hash[starts]) - 1].astype(np.float64) - owned
    found = np.empty(len(hashes))
    found[by_hash] = np.repeat(others, owned)
    return found


def _scored(chunk: pd.DataFrame, answers: pd.DataFrame, order: int, everything: int) -> pd.DataFrame:
    """Scores of the documents of one chunk."""
    row = chunk.iloc[0]
    words, offsets = _opened(row["sizes"], row["vocabulary"], row["codes"])
    doc_ids, sizes = row["doc_ids"], np.diff(offsets)
    logs = np.zeros(len(sizes))
    backed = np.zeros(len(sizes))
    if len(words):
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        highest = np.minimum(np.arange(len(words), dtype=np.int32) - offsets[:-1].astype(np.int32)[doc] + 1, order)
        rest = np.maximum(everything - sizes.astype(np.float64), 1)
        answers = answers.sort_values(["n", "part"])
        score = context = np.zeros(0)
        used = np.ones(len(words), np.int32)
        for n, (places, hashes) in enumerate(grams(words, offsets, order), 1):
            mine = answers[answers["n"] == n]
            totals = [_numbers(*one) for one in zip(mine["totals"], mine["n_grams"], strict=True)]
            count = np.zeros(len(words))
            count[places] = _others(hashes, doc[places], np.concatenate(totals)) if totals else 0
            if n == 1:
                score = BACKOFF ** (highest - 1.0) * np.maximum(count, UNSEEN) / rest[doc]
            else:
                # The context ends one word earlier, in the same document.
                hit = np.flatnonzero(count > 0)
                score[hit] = BACKOFF ** (highest[hit] - n) * count[hit] / context[hit - 1]
                used[hit] = n
            context = count
        logs = np.bincount(doc, np.log(score), len(sizes))
        backed = np.bincount(doc, used < highest, len(sizes))
    some = np.maximum(sizes, 1)
    return pd.DataFrame(
        {
            "doc_id": pd.array([None if one is None or one != one else int(one) for one in doc_ids], "Int64"),
            "n_words": sizes,
            "log_score": logs,
            "mean_score": np.where(sizes > 0, logs / some, np.nan),
            "backed_off": np.where(sizes > 0, backed / some, np.nan),
        }
    )


def _bucketed(chunks: DataFrame) -> DataFrame:
    """Stores the chunks in buckets, so that only the answers have to move to them."""
    spark = chunks.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = sinks.work_folder(spark, "chunks")
    chunks.write.bucketBy(buckets, "chunk").option("path", folder).option("compression", "zstd").saveAsTable(name)
    table = spark.table(name)
    # The files of an external table stay; only the name goes.
    spark.sql(f"DROP TABLE {name}")
    return table


def score(docs: DataFrame, *, order: int = ORDER) -> DataFrame:
    """Returns doc_id, n_words, log_score, mean_score, backed_off for each row of ``docs`` (doc_id, text).

    The score of a word is the count of the longest n-gram ending there that
    other rows have, over the count of its context, times 0.4 for every shorter
    order; a word no other row has counts as half an occurrence. ``log_score``
    is the sum of natural logarithms, ``mean_score`` that per word,
    ``backed_off`` the share of words that needed a shorter order. Words are
    runs of non-space characters. Texts without words, or NULL, score 0 with
    NULL mean and share. Rows that repeat one another count as others of each
    other. An empty table gives no rows. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = _bucketed(docs.mapInArrow(_chunked, _CHUNK))
    everything = chunks.agg(F.sum("n_words")).first()[0] or 0
    # The n-grams of an order are at most as many as the words.
    parts = everything // PART_GRAMS + 1
    codes = chunks.where("n_words > 0").select("chunk", "sizes", "vocabulary", "codes")
    answers = (
        codes.mapInArrow(lambda batches: _asked(batches, order, parts), _ASKED)
        .groupBy("n", "part")
        .applyInPandas(_totals, "n int, part long, chunk long, n_grams long, totals binary")
    )
    scores = (
        chunks.select("chunk", "doc_ids", "sizes", "vocabulary", "codes")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInPandas(
            lambda chunk, found: _scored(chunk, found, order, everything),
            "doc_id long, n_words long, log_score double, mean_score double, backed_off double",
        )
    )
    return scores.withColumns({name: F.nanvl(name, F.lit(None).cast("double")) for name in ("mean_score", "backed_off")})
