"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deposit_analytics.sources import sinks

# Words are runs of anything but these ASCII space characters.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

KEY_BITS = 60


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Writes ``frame`` to the shared folder and reads it back.

    Cuts the lineage: a lost executor never repeats what came before.
    """
    spark = frame.sparkSession
    folder = sinks.work_folder(spark, label)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def committed(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """Stores the frame that ``build`` returns; returns it, read back, and its folder.

    Whatever ``build`` stored on the way goes once the result is committed, or
    when the job fails; a failed job's own half-written result goes too.
    """
    folder = sinks.work_folder(spark, label)
    try:
        with sinks.scratch(spark, f"{label}-scratch"):
            frame = build()
            frame.write.parquet(folder)
    except BaseException:
        sinks.drop_folder(spark, folder)
        raise
    return spark.read.schema(frame.schema).parquet(folder), folder


def word_count(text: Column) -> Column:
    """Words of a text; none for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a row by its doc_id, NULL included, and its text, in 64 bits; a NULL text counts as empty."""
    return F.xxhash64(doc_id.cast("long"), F.coalesce(text.cast("string"), F.lit("")))


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not among ``rows`` (row).

    Rows that share only doc_id or only text are told apart. All columns stay as
    they are.
    """
    key = row_key(F.col("doc_id"), F.col("text"))
    marked = docs.select(F.struct("*").alias("doc"), key.alias("row"))
    return marked.join(rows.select("row").distinct(), "row", "left_anti").select("doc.*")


def hashed_key(text: Column) -> Column:
    """The first 60 bits of the MD5 of a text, as a non-negative number."""
    digits = F.substring(F.md5(text), 1, KEY_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def bucket_of(key: Column, buckets: int) -> Column:
    """Cuts the range of a 60-bit key evenly; a larger key has no smaller bucket."""
    return F.floor(key.cast("double") / float(2**KEY_BITS) * buckets).cast("long")


def root_buckets(rows: int) -> int:
    """Buckets such that both a bucket and the list of buckets grow with the root of the rows."""
    return max(1, math.isqrt(rows))
