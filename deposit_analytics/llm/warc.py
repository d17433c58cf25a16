"""WARC archives with a two-level capture index.

Archives are written by Spark's text sink, one record per row: a record is
ended by two line ends, which is what separates rows. Records of equal payloads
refer to the one with the smallest page id.

The index is built by scanning the archives. Captures are sorted by reversed
host, path and page id, cut into compressed blocks of lines, and stored part by
part. A sparse directory keeps the first key of every block. A lookup finds the
parts by binary search over their first keys, the block by binary search over
the part's directory, and the line by binary search in the block; the record is
then read from its archive by its byte range alone.

Executors open archives through ``pyarrow.fs``, which needs the cluster's
library for the file system that holds them.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deposit_analytics.llm.common import stored

RECORD_END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
LEAST_BYTES = 0
LINES = 1024

# Version line, digits of base 32 as Spark writes them and as
# archives do, and the profile of revisits by equal payload.
_VERSION = "WARC/1.1"
_DIGITS, _LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_UNSAFE = r"[\x00-\x20\x7F]+"
_ADDRESS = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)(:[0-9]+)?([^#]*)")
_CAPTURE = "key string, page_id long, file string, offset long, length long"


def payload_of(html: Column) -> Column:
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def payload_digest(payload: Column) -> Column:
    """Base 32 of the SHA-1: four digits for every five of the hexadecimal form."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*parts)), _DIGITS, _LETTERS)


def _record_id(page_id: Column, digest: Column) -> Column:
    digits = F.md5(F.concat_ws(":", page_id.cast("string"), digest))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digits, a, n) for a, n in cuts]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none for NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write(pages: DataFrame, folder: str, *, least_bytes: int = LEAST_BYTES, date: str = DATE) -> None:
    """Writes one record per row of ``pages`` (page_id, url, html) into ``folder``.

    NULL html is an empty payload. Of the rows with equal payloads of at least
    ``least_bytes`` bytes, those with the smallest page_id are responses and the
    others revisit it; rows without page_id are responses. Rows that repeat a
    page_id and payload get records of their own. An empty table makes no
    records. The payloads are not shuffled unless many of them revisit others.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    described = pages.select("*", payload_of(F.col("html")).alias("payload")).drop("html")
    described = described.withColumn("digest", payload_digest(F.col("payload")))
    digests = stored(described.select("page_id", "digest", F.octet_length("payload").alias("bytes")), "digests")
    first = digests.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    )
    revisits = stored(
        digests.join(first.where(F.col("n") > 1).drop("n"), "digest")
        .where(F.col("page_id") > F.col("first"))
        .select("page_id", "digest", "first")
        .distinct(),
        "revisits",
    )
    rows = described.join(revisits, ["page_id", "digest"], "left")
    revisit, size = F.col("first").isNotNull(), F.octet_length("payload")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        _line("Content-Length", size.cast("string")),
        F.lit("\r\n"),
    )
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit(f"{_VERSION}\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.regexp_replace("url", _UNSAFE, "%20")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first"), F.col("digest")))),
        _line("X-Refers-To-Page", F.col("first").cast("string")),
        _line("X-Page", F.col("page_id").cast("string")),
        _line("X-Payload-Length", size.cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit("\r\n"),
        http,
    )
    record = F.concat(head.cast("binary"), body).cast("string")
    rows.select(record.alias("record")).write.option("lineSep", RECORD_END).text(folder)


def _opened(uri: str):
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").rstrip("\r\n").partition(": ") for line in lines)
    return {name: value for name, _, value in pairs}


def url_key(url: str | None) -> str:
    """Host labels from the last to the first, then path and query; '' for no address."""
    clean = re.sub(_UNSAFE, "%20", url or "")
    found = _ADDRESS.match(clean)
    if not found:
        return clean
    host, port, rest = found.groups()
    return ",".join(reversed(host.lower().split("."))) + (port or "") + ")" + (rest or "/")


def capture_key(url: str | None, page_id: int | None) -> str:
    """Sorts by address first and page id next."""
    place = "" if page_id is None else f"{page_id + 2**63:020d}"
    return f"{url_key(url)} {place}"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Captures of whole archives, read through a small buffer."""
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            rows: list[tuple] = []
            with _opened(uri) as raw, io.BufferedReader(raw, 1 << 18) as file:
                offset = 0
                while file.readline():
                    lines = []
                    while (line := file.readline()) not in (b"\r\n", b""):
                        lines.append(line)
                    headers = _headers(lines)
                    file.seek(int(headers["Content-Length"]), io.SEEK_CUR)
                    end = file.tell()
                    page = int(headers["X-Page"]) if "X-Page" in headers else None
                    rows.append((capture_key(headers.get("WARC-Target-URI"), page), page, uri, offset, end - offset))
                    offset = end + len(RECORD_END)
                    file.seek(offset)
                    if len(rows) == 4096:
                        yield _batch(rows)
                        rows = []
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["key", "page_id", "file", "offset", "length"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed blocks of the sorted captures of one part."""
    held: list[tuple] = []

    def block(rows: list[tuple]) -> pa.RecordBatch:
        lines = "\n".join("\t".join("" if one is None else str(one) for one in row) for row in rows)
        packed = zlib.compress(lines.encode(), 6)
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[0][0]]), pa.array([rows[-1][0]]), pa.array([packed], pa.binary())], ["first", "last", "lines"]
        )

    for batch in batches:
        held += zip(*[column.to_pylist() for column in batch.columns], strict=True)
        while len(held) >= LINES:
            yield block(held[:LINES])
            held = held[LINES:]
    if held:
        yield block(held)


def build_index(spark: SparkSession, folder: str) -> DataFrame:
    """Scans the archives of ``folder``; returns the stored blocks: part, first, last, lines."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path")
    captures = files.repartition("path").mapInArrow(_scanned, _CAPTURE)
    ordered = captures.repartitionByRange("key").sortWithinPartitions("key")
    blocks = ordered.mapInArrow(_blocks, "first string, last string, lines binary")
    return stored(blocks.withColumn("part", F.spark_partition_id()), "capture_index")


def _find(blocks: pd.DataFrame, keys: list[str], exact: bool) -> list[tuple]:
    """Lines of one part for each key: that capture, or all captures of an address."""
    blocks = blocks.sort_values("first")
    directory, lasts, packed = blocks["first"].tolist(), blocks["last"].tolist(), blocks["lines"].tolist()
    opened: dict[int, tuple[list[str], list[str]]] = {}
    found = []
    for key in sorted(set(keys)):
        # Keys of an address are the address, a space and digits.
        k = max(0, bisect.bisect_left(directory, key) - 1)
        end = key if exact else key + ":"
        while k < len(directory) and directory[k] <= end:
            if lasts[k] >= key:
                if k not in opened:
                    lines = zlib.decompress(packed[k]).decode().split("\n")
                    opened = {k: (lines, [line.partition("\t")[0] for line in lines])}
                lines, line_keys = opened[k]
                at = bisect.bisect_left(line_keys, key)
                while at < len(lines) and line_keys[at] <= end:
                    found.append((key, *lines[at].split("\t")))
                    at += 1
            k += 1
    return found


def _find_in_part(left: pd.DataFrame, right: pd.DataFrame, exact: bool) -> pd.DataFrame:
    rows = _find(right, left["wanted"].tolist(), exact) if len(left) and len(right) else []
    frame = pd.DataFrame(rows, columns=["wanted", "key", "page_id", "file", "offset", "length"])
    frame["page_id"] = pd.array([int(one) if one else None for one in frame["page_id"]], "Int64")
    return frame.astype({"offset": "int64", "length": "int64"})


def lookup(index: DataFrame, wanted: DataFrame, *, exact: bool) -> DataFrame:
    """Captures for the distinct keys in column ``wanted``.

    ``exact`` wants whole capture keys; otherwise keys are of addresses, with a
    space at the end, and all captures of them are found. The driver holds the
    first and last key of each part, one row per range partition.
    """
    parts = index.groupBy("part").agg(F.min("first").alias("first"), F.max("last").alias("last")).orderBy("first").collect()
    numbers, firsts, lasts = [row.part for row in parts], [row.first for row in parts], [row["last"] for row in parts]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int]] = []
            for key in batch.column("wanted").to_pylist():
                k = bisect.bisect_left(lasts, key)
                while k < len(numbers) and firsts[k] <= (key if exact else key + ":"):
                    out.append((key, numbers[k]))
                    k += 1
            keys, places = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(places, pa.int32())], ["wanted", "part"])

    queries = wanted.select("wanted").distinct().mapInArrow(routed, "wanted string, part int")
    return (
        queries.groupBy("part")
        .cogroup(index.groupBy("part"))
        .applyInPandas(lambda left, right: _find_in_part(left, right, exact), f"wanted string, {_CAPTURE}")
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records at byte ranges, with the payload of responses."""
    held, file = None, None
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        columns = [batch.column(name).to_pylist() for name in ("key", "file", "offset", "length")]
        for key, uri, offset, length in zip(*columns, strict=True):
            if uri != held:
                held, file = uri, _opened(uri)
            file.seek(offset)
            record = file.read(length)
            head, _, block = record.partition(b"\r\n\r\n")
            headers = _headers(head.split(b"\r\n")[1:])
            payload = block.partition(b"\r\n\r\n")[2]
            revisit = headers["WARC-Type"] == "revisit"
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            if not revisit:
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            rows.append(
                (
                    key,
                    int(headers["X-Page"]) if "X-Page" in headers else None,
                    headers.get("WARC-Target-URI"),
                    int(headers["X-Payload-Length"]) if revisit else len(payload),
                    digest,
                    headers["WARC-Type"],
                    int(headers["X-Refers-To-Page"]) if revisit else None,
                    None if revisit else payload,
                )
            )
            size += len(record)
            if size > 1 << 24:
                yield _records(rows)
                rows, size = [], 0
        if rows:
            yield _records(rows)


_RECORD = (
    "key string, page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, payload binary"
)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [field.split()[0] for field in _RECORD.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names
    )


def read(captures: DataFrame) -> DataFrame:
    """The records of captures, each read by its own byte range, in archive order."""
    placed = captures.select("key", "file", "offset", "length")
    return placed.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(_read, _RECORD)


def _page_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist(), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array([capture_key(*pair) for pair in pairs], pa.string())], ["wanted"])


def captures_of(index: DataFrame, pages: DataFrame) -> DataFrame:
    """The captures of each of ``pages`` (page_id, url)."""
    keys = pages.select(F.col("url").cast("string").alias("url"), F.col("page_id").cast("long").alias("page_id"))
    return lookup(index, keys.mapInArrow(_page_keys, "wanted string"), exact=True)


def captures_at(index: DataFrame, urls: DataFrame) -> DataFrame:
    """All captures of each address in column ``url``."""
    keys = F.udf(lambda url: f"{url_key(url)} ", "string")
    return lookup(index, urls.select(keys(F.col("url").cast("string")).alias("wanted")), exact=False)
