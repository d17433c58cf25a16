"""Language identification by fusing evidence.

Three kinds of evidence meet by Bayes' rule: how likely the text is in each
language, the language that markup or metadata declares, and where the text
comes from. Text likelihoods come from byte trigram counts, fitted on a bounded
sample of labelled rows. How far a declaration can be trusted, and which
languages a host publishes, is counted over all records from the text evidence
by grouped aggregation. A host's prior is smoothed towards that of its address
suffix, and that towards the whole corpus; a record's own share is taken out of
its host's counts first.

That compares languages with one another. Whether a text is in any of them is
judged on absolute evidence: its mean likelihood under all fitted languages
together is held against what the labelled rows of its own language have, and a
text far below that is in none. Under all together, since each half of a text in
two languages is likely in its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deposit_analytics.llm import shingles
from deposit_analytics.llm.common import row_key, stored

BUCKET_BITS = 16
SAMPLE = 2000
SMOOTHING = 0.5
STRENGTH = 20.0
MOST_EVIDENCE = 300.0
LEAST_CONFIDENCE = 0.4
# How far, in natural logarithms per trigram, a text may lie below the labelled
# rows, and how many standard errors more: short texts vary.
MARGIN = 3.0
ERRORS = 3.0

# Lower-case letters and bytes of multi-byte characters stand for themselves, a
# nought for all digits, a space for everything else.
_FOLDED = np.full(256, 32, np.uint32)
_FOLDED[ord("0") : ord("9") + 1] = ord("0")
_FOLDED[128:] = np.arange(128, 256)
_FOLDED[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLDED[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SPREAD = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Model:
    """Log-likelihoods of trigram buckets, one row per language."""

    languages: tuple[str, ...]
    table: np.ndarray

    def absolute(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-likelihoods under all languages together; their mean and deviation over each language's trigrams."""
        shares = np.exp(self.table.astype(np.float64))
        every = np.log(shares.mean(axis=0))
        mean = shares @ every
        return every, mean, np.sqrt(np.maximum(shares @ every**2 - mean**2, 0))


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams with a letter, and those before each text."""
    if len(data) < 3:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    folded = _FOLDED[data]
    code = folded[:-2] | folded[1:-1] << np.uint32(8) | folded[2:] << np.uint32(16)
    letter = (folded != 32) & (folded != ord("0"))
    inside = letter[:-2] | letter[1:-1] | letter[2:]
    ends = offsets[1:-1]
    for back in (1, 2):
        crossing = ends - back
        inside[crossing[(crossing >= 0) & (crossing < len(inside))]] = False
    with np.errstate(over="ignore"):
        buckets = (code * _SPREAD) >> np.uint32(32 - BUCKET_BITS)
    counts = np.concatenate([[0], np.cumsum(inside)])
    return buckets[inside], counts[np.minimum(offsets, len(inside))]


def letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter."""
    folded = _FOLDED[data]
    counts = np.concatenate([[0], np.cumsum((folded != 32) & (folded != ord("0")))])
    return np.diff(counts[offsets]) > 0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column("label").to_pylist()
        data, offsets = shingles.text_bytes(batch.column("text"))
        for first, last in shingles.chunks(offsets):
            low, high = offsets[first], offsets[last]
            buckets, at = trigrams(data[low:high], offsets[first : last + 1] - low)
            labels = np.array(names[first:last])
            for label in sorted(set(names[first:last])):
                mine = np.repeat(labels == label, np.diff(at))
                found, counts = np.unique(buckets[mine], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(found)), pa.array(found.astype(np.int64)), pa.array(counts)],
                    ["label", "bucket", "n"],
                )


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits the text model on about ``sample`` rows a language of (doc_id, text, label).

    The rows are those with the least hashes of doc_id, so reruns agree; a label
    with fewer rows is fitted on all of them. Every label is a language. What
    comes to the driver is bounded by languages times trigram buckets. Rows with
    NULL as label are left out.
    """
    labelled = labelled.select("doc_id", "text", "label").where(F.col("label").isNotNull())
    sizes = {row.label: row.n for row in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model((), np.zeros((0, 1 << BUCKET_BITS), np.float32))
    share = reduce(
        lambda chosen, name: chosen.when(F.col("label") == name, sample / sizes[name]), sizes, F.when(F.lit(False), 0.0)
    )
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    rows = (
        labelled.where(place < F.coalesce(share, F.lit(0.0)))
        .select("label", F.col("text").cast("string").alias("text"))
        .mapInArrow(_counts, "label string, bucket long, n long")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    names = tuple(sorted(sizes))
    table = np.full((len(names), 1 << BUCKET_BITS), SMOOTHING)
    place_of = {name: k for k, name in enumerate(names)}
    table[rows.label.map(place_of).to_numpy(np.int64), rows.bucket.to_numpy(np.int64)] += rows.n.to_numpy(np.float64)
    return Model(names, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    table = model.table
    every, mean, deviation = model.absolute()
    for batch in batches:
        data, offsets = shingles.text_bytes(batch.column("text"))
        for first, last in shingles.chunks(offsets):
            low, high = offsets[first], offsets[last]
            buckets, at = trigrams(data[low:high], offsets[first : last + 1] - low)
            counts = np.diff(at)
            some = np.flatnonzero(counts)
            logs = np.zeros((last - first, len(table)))
            for k, row in enumerate(table):
                if len(some):
                    logs[some, k] = np.add.reduceat(row[buckets], at[:-1][some], dtype=np.float64)
            together = np.zeros(last - first)
            if len(some):
                together[some] = np.add.reduceat(every[buckets], at[:-1][some])
            best, some = logs.argmax(axis=1), np.maximum(counts, 1)
            # Neighbouring trigrams share letters, so a third of them count.
            below = mean[best] - together / some
            known = (counts == 0) | (below <= MARGIN + ERRORS * deviation[best] * np.sqrt(3 / some))
            # The same, and long texts repeat themselves.
            weight = np.minimum(counts / 3, MOST_EVIDENCE) / np.maximum(counts, 1)
            logs = (logs - logs.max(axis=1, keepdims=True)) * weight[:, None]
            shares = np.exp(logs)
            shares /= shares.sum(axis=1, keepdims=True)
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("declared"),
                    part.column("suffix"),
                    part.column("host"),
                    pa.array(counts.astype(np.int64)),
                    pa.array(letters(data[low:high], offsets[first : last + 1] - low)),
                    pa.array(known),
                    pa.array(list(logs), pa.list_(pa.float64())),
                    pa.array(list(shares), pa.list_(pa.float64())),
                ],
                ["doc_id", "declared", "suffix", "host", "trigrams", "letters", "known", "logs", "shares"],
            )


def _best(weights: str, names: tuple[str, ...]) -> Column:
    """The name of the largest weight, the first of equals."""
    place = F.array_position(weights, F.array_max(weights)) - 1
    return F.get(F.array(*[F.lit(name) for name in names]), place.cast("int"))


def _shares(scored: DataFrame, key: str, count: int, prefix: str) -> DataFrame:
    """Per value of ``key``, the text evidence for each language, added up."""
    return scored.groupBy(key).agg(*[F.sum(F.col("shares")[k]).alias(f"{prefix}{k}") for k in range(count)])


def identify(records: DataFrame, model: Model, least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """Returns doc_id, lang, confidence, text_lang, kept, declared for each record.

    ``records`` has doc_id, text, declared, suffix and host; each may be NULL. A
    missing declaration says nothing, a missing suffix or host is a value of its
    own. ``kept`` is false when the best language's probability lies below
    ``least_confidence``, which half a text in another language does not bring
    about, when the text's trigrams are far less likely than those of labelled rows,
    so that it is in no fitted language, or when it has no letters. Such texts tell
    nothing about hosts and declarations. ``declared`` is the declared language in
    lower case, without region. A text too short for a trigram goes by
    the other evidence. Ties go to the first language by name. With a model
    without languages, lang is NULL and all records are kept. Repeated rows are
    judged alike; an empty table gives no rows.
    """
    names = model.languages
    records = records.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lower(F.substring_index(F.substring_index(F.trim("declared"), "-", 1), "_", 1)).alias("declared"),
        F.coalesce(F.concat(F.lit("."), "suffix"), F.lit("")).alias("suffix"),
        F.coalesce(F.concat(F.lit("/"), "host"), F.lit("")).alias("host"),
    )
    if not names:
        none = F.lit(None).cast("string")
        return records.select(
            "doc_id", none.alias("lang"), F.lit(0.0).alias("confidence"), none.alias("text_lang"), F.lit(True).alias("kept"), "declared"
        )
    count = len(names)
    scored = records.mapInArrow(
        lambda batches: _score(batches, model),
        "doc_id long, declared string, suffix string, host string, trigrams long, letters boolean, known boolean,"
        " logs array<double>, shares array<double>",
    )
    scored = stored(scored, "scores")
    shown = scored.where((F.col("trigrams") > 0) & F.col("known"))
    sums = shown.agg(*[F.sum(F.col("shares")[k]) for k in range(count)]).first()
    everything = [one or 0.0 for one in sums]
    total = sum(everything) + count
    prior = [(one + 1) / total for one in everything]
    # Stored, so that their size is known before the join and small ones move, not the records.
    parents = stored(_shares(shown, "suffix", count, "s"), "suffixes")
    hosts = stored(_shares(shown, "host", count, "h"), "hosts")
    claims = stored(_shares(shown.where(F.col("declared").isNotNull()), "declared", count, "d"), "claims")
    claimed = [row or 0.0 for row in claims.agg(*[F.sum(f"d{k}") for k in range(count)]).first()]
    fused = scored.join(parents, "suffix", "left").join(hosts, "host", "left").join(claims, "declared", "left")
    zero = F.lit(0.0)
    of_suffix = [F.coalesce(F.col(f"s{k}"), zero) for k in range(count)]
    of_host = [F.coalesce(F.col(f"h{k}"), zero) for k in range(count)]
    own = [F.when((F.col("trigrams") > 0) & F.col("known"), F.col("shares")[k]).otherwise(zero) for k in range(count)]
    in_suffix = sum(of_suffix[1:], of_suffix[0])
    others = [F.greatest(a - b, zero) for a, b in zip(of_host, own, strict=True)]
    in_host = sum(others[1:], others[0])
    # A language's records declare a value as often as all do, until there is evidence.
    declared = [F.coalesce(F.col(f"d{k}"), zero) for k in range(count)]
    any_declared = sum(declared[1:], declared[0]) / max(sum(claimed), 1.0)
    final = []
    for k in range(count):
        parent = (of_suffix[k] + STRENGTH * prior[k]) / (in_suffix + STRENGTH)
        place = (others[k] + STRENGTH * parent) / (in_host + STRENGTH)
        claim = (declared[k] + any_declared + 1e-3) / (claimed[k] + 1.0 + 1e-3)
        final.append(F.col("logs")[k] + F.log(place) + F.when(F.col("declared").isNull(), zero).otherwise(F.log(claim)))
    # One array after the other, so that no expression holds copies of another.
    fused = fused.withColumn("final", F.array(*final))
    fused = fused.withColumn("most", F.array_max("final"))
    fused = fused.withColumn("weights", F.transform("final", lambda one: F.exp(one - F.col("most"))))
    top = 1 / F.aggregate("weights", zero, lambda total, one: total + one)
    fused = fused.withColumn("confidence", top)
    return fused.select(
        "doc_id",
        _best("weights", names).alias("lang"),
        "confidence",
        F.when(F.col("trigrams") > 0, _best("shares", names)).alias("text_lang"),
        (F.col("letters") & F.col("known") & (F.col("confidence") >= least_confidence)).alias("kept"),
        "declared",
    )


def document_records(docs: DataFrame) -> DataFrame:
    """Records of documents: the declared language is ``lang``, the host is ``source``."""
    return docs.select(
        "doc_id",
        "text",
        F.col("lang").cast("string").alias("declared"),
        F.lit(None).cast("string").alias("suffix"),
        F.col("source").cast("string").alias("host"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """Records of web pages: declared in the markup, suffix and host from the address."""
    host = F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    markup = F.regexp_extract(F.col("html"), r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-zA-Z]+)", 1)
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")
    return pages.select(
        F.col("page_id").alias("doc_id"),
        text.alias("text"),
        F.when(markup != "", markup).alias("declared"),
        F.when(host != "", F.substring_index(host, ".", -1)).alias("suffix"),
        F.when(host != "", host).alias("host"),
    )


def identified(docs: DataFrame, **options) -> DataFrame:
    """The rows whose language is certain enough, with that language as ``lang`` and other columns as they are.

    The model is fitted on the documents' own ``lang``, which stays where it says
    the same, if in other letters. Rows are judged by themselves, whether or not
    they have a doc_id and whichever others share it.
    """
    model = fit(docs.select("doc_id", "text", F.lower(F.col("lang").cast("string")).alias("label")))
    key = F.xxhash64(
        row_key(F.col("doc_id"), F.col("text")), F.coalesce(F.col("lang").cast("string"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit(""))
    )
    records = document_records(docs.withColumn("doc_id", key))
    judged = identify(records, model, **options)
    # Most rows stay as they are, and only the others have to meet their documents.
    changed = judged.where(~F.col("kept") | ~F.col("lang").eqNullSafe(F.col("declared")))
    changed = stored(changed.select(F.col("doc_id").alias("row"), F.col("lang").alias("found"), "kept").dropDuplicates(["row"]), "judged")
    marked = docs.select(F.struct("*").alias("doc"), key.alias("row")).join(changed, "row", "left")
    lang = F.coalesce("found", F.col("doc.lang").cast("string")).alias("lang")
    return marked.where(F.coalesce("kept", F.lit(True))).select(*[lang if name == "lang" else f"doc.{name}" for name in docs.columns])
