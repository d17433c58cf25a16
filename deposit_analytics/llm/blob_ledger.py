"""Secret scans over every version of every text, by an incremental ledger.

A version is a text at a path; equal texts are one blob, named by the SHA-256 of
its bytes. The ledger is a table with a row for each blob and scan: the rules, by
kind and version, that the blob was searched with, and what they found. A scan
reads the texts of those blobs only that lack a rule, searches them with the rules
they lack, and appends one commit with pairs and findings together, so a scan that
breaks off leaves nothing behind. Findings are joined back to all paths at the end.

Only hashes and findings are shuffled to tell what is unseen. Of a blob's copies
one is read, picked by blob and path, so a text with very many copies is one row
of that join. If little is new, Spark broadcasts the short list by its size and
no text moves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deposit_analytics.llm.common import stored

LEDGER = "blob binary, rules array<string>, findings array<struct<rule:string,start:long,end:long>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters.

    Matches are leftmost and do not overlap; short ones are dropped after the
    search, with what they cover. A changed rule needs a new version.
    """

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The formats of secrets. For access and hex the least length stands
# in the pattern, which finds the same spans: their matches are whole runs.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*"),
)
RULES = BASE + ADDED


def found(text: str, rule: Rule) -> list[tuple[int, int]]:
    """Start and end of what a rule finds, in code points, the end exclusive."""
    return [
        match.span()
        for match in re.compile(rule.pattern, re.ASCII).finditer(text)
        if match.end(rule.group) - match.start(rule.group) >= rule.least
    ]


def blob_of(text: Column) -> Column:
    """The name of a text: the SHA-256 of its UTF-8 bytes; NULL counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def open_ledger(spark: SparkSession, folder: str) -> None:
    """Makes the ledger's folder, unless it is there; adds no pair."""
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(folder)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(folder)


def _place(path: Column) -> Column:
    return F.coalesce(path.cast("string"), F.lit(""))


def _searched(batches: Iterator[pa.RecordBatch], rules: dict[str, Rule]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("blob", pa.binary()),
            ("rules", pa.list_(pa.string())),
            ("findings", pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
        ]
    )
    last = None
    for batch in batches:
        rows = []
        for blob, names, text in zip(batch.column("blob"), batch.column("missing"), batch.column("text"), strict=True):
            # Rows that repeat path and text come one after the other.
            if blob == last:
                continue
            last, names, text = blob, names.as_py(), text.as_py() or ""
            spans = [
                {"rule": name, "start": start, "end": end} for name in names for start, end in found(text, rules[name])
            ]
            rows.append({"blob": blob.as_py(), "rules": names, "findings": spans})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def unseen(keyed: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, place, missing: for each blob of ``keyed`` (path, blob) that lacks a rule, one of its paths and those rules."""
    blobs = keyed.groupBy("blob").agg(F.min(_place(F.col("path"))).alias("place"))
    # As many rows for a blob as it had scans.
    seen = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
    names = F.array(*[F.lit(rule.name) for rule in rules])
    missing = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "place", missing.alias("missing")).where(F.size("missing") > 0)


def scan(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Brings the ledger up to date for ``versions`` (path, text) and returns their (path, blob).

    Searches every blob with the rules it was not searched with before, and no
    other. NULL texts count as empty, and NULL paths are paths. Other columns are
    ignored. An empty table adds nothing.
    """
    spark = versions.sparkSession
    texts = versions.select("path", F.col("text").cast("string").alias("text"))
    keyed = stored(texts.select("path", blob_of(F.col("text")).alias("blob")), "versions")
    missing = stored(unseen(keyed, read_ledger(spark, folder), rules), "unseen")
    known = {rule.name: rule for rule in rules}
    wanted = texts.select(_place(F.col("path")).alias("place"), blob_of(F.col("text")).alias("blob"), "text")
    commit = (
        wanted.join(missing, ["blob", "place"])
        .select("blob", "missing", "text")
        .mapInArrow(lambda batches: _searched(batches, known), LEDGER)
        .distinct()
    )
    commit.write.mode("append").parquet(folder)
    return keyed


def findings(keyed: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Returns path, findings for each row of ``keyed`` (path, blob), from the ledger alone.

    ``findings`` is an array of start, place, end and kind by start and then by
    the order of ``rules``; those of other rules and of other versions of a rule
    are left out. A row without findings has an empty array. The ledger must have
    been brought up to date by ``scan`` for these rules.
    """
    one = F.col("one")
    place = F.array_position(F.array(*[F.lit(rule.name) for rule in rules]), one["rule"])
    kind = F.element_at(F.array(*[F.lit(rule.kind) for rule in rules]), place.cast("int"))
    by_blob = (
        read_ledger(keyed.sparkSession, folder)
        .where(F.size("findings") > 0)
        .select("blob", F.explode("findings").alias("one"))
        .where(place > 0)
        .select("blob", F.struct(one["start"].alias("start"), place.alias("place"), one["end"].alias("end"), kind.alias("kind")).alias("one"))
        # As many as one text holds; a set, since scans that ran at once may both have added them.
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set("one")).alias("findings"))
    )
    none = F.array().cast("array<struct<start:long,place:long,end:long,kind:string>>")
    return keyed.select("path", "blob").join(by_blob, "blob", "left").select("path", F.coalesce("findings", none).alias("findings"))


def joined(spans: Column) -> Column:
    """kind:start:end of the findings, joined by commas."""
    return F.array_join(F.transform(spans, lambda one: F.concat_ws(":", one["kind"], one["start"], one["end"])), ",")
