"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deposit_analytics.llm import (
    blob_ledger,
    chosen_path,
    decontamination,
    embedding_dedup,
    language_id,
    license_scan,
    lm_scores,
    mixing,
    prefix_trie,
    sharding,
    token_files,
    warc,
    whitening,
)
from deposit_analytics.llm.common import stored, word_count
from deposit_analytics.sources import sinks


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("words")
    )
    mix = mixing.mix(stored(docs, "sizes"), F.col("words"))
    return mix.select("doc.doc_id", "size", "source_size", "target", "taken", "doc.source")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = sinks.work_folder(spark, "tokens")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write(_table(spark, sf_dir, "documents"), folder, tokenizer)
    return token_files.read(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def _model(spark: SparkSession, sf_dir: str) -> language_id.Model:
    docs = _table(spark, sf_dir, "documents")
    return language_id.fit(docs.select("doc_id", "text", F.col("lang").alias("label")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = language_id.document_records(_table(spark, sf_dir, "documents"))
    return language_id.identify(records, _model(spark, sf_dir)).drop("declared")


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = language_id.page_records(_table(spark, sf_dir, "pages"))
    return language_id.identify(records, _model(spark, sf_dir)).drop("declared").withColumnRenamed("doc_id", "page_id")


def op4_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.find_licenses(_table(spark, sf_dir, "documents"), license_scan.templates(spark))
    return found.select("doc_id", "license_id", F.round("containment", 6).alias("containment"))


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_scores.score(_table(spark, sf_dir, "documents"))
    # Sums of logarithms differ in their last digits by the order of the words.
    digits = {"log_score": 4, "mean_score": 8, "backed_off": 8}
    return scores.withColumns({name: F.round(name, places) for name, places in digits.items()})


def op7_shingle_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_groups(_table(spark, sf_dir, "documents"))


def op8_contiguous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        sharding.text_key(text).alias("key"),
        sharding.text_size(text).alias("bytes"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
    )
    shards = sharding.assign(stored(docs, "texts"), F.col("key"), F.col("bytes"))
    return shards.select(
        "doc.doc_id",
        "size",
        "doc.text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder = sinks.work_folder(spark, "warc")
    warc.write(pages, folder)
    records = warc.read(warc.captures_of(warc.build_index(spark, folder), pages))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contained_items(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op12_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    folder = sinks.work_folder(spark, "ledger")
    blob_ledger.open_ledger(spark, folder)
    found = blob_ledger.findings(blob_ledger.scan(versions, folder), folder)
    kinds = F.transform("findings", lambda one: one["kind"])
    base = F.filter("findings", lambda one: one["place"] <= len(blob_ledger.BASE))
    return found.select(
        F.col("path").alias("doc_id"),
        *[
            (F.size(kinds) - F.size(F.array_remove(kinds, rule.kind))).cast("long").alias(f"n_{rule.kind}")
            for rule in blob_ledger.BASE
        ],
        F.sha2(blob_ledger.joined(base), 256).alias("base_sha256"),
        blob_ledger.joined(F.col("findings")).alias("spans"),
    )


def op13_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_source_mix": op1_source_mix,
    "op2_token_files": op2_token_files,
    "op3_language_id": op3_language_id,
    "page_language_id": page_language_id,
    "op4_license_notices": op4_license_notices,
    "op5_near_vectors": op5_near_vectors,
    "op6_lm_scores": op6_lm_scores,
    "op7_shingle_jaccard_join": op7_shingle_jaccard_join,
    "op8_contiguous_shards": op8_contiguous_shards,
    "op9_capture_index": op9_capture_index,
    "op10_benchmark_leaks": op10_benchmark_leaks,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_blob_ledger": op12_blob_ledger,
    "op13_bit_sliced_whitening": op13_bit_sliced_whitening,
}

# The mix in one window over everything, where the operator adds up buckets.
_MIX = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:15] AS BIGINT) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) :: DOUBLE AS weight
  FROM docs GROUP BY source),
levels AS (SELECT *, (3 * source_size) :: DOUBLE AS most, (3 * source_size) :: DOUBLE / weight AS level FROM sources),
judged AS (
  SELECT a.*, (SELECT sum(least(b.most, a.level * b.weight)) FROM levels b)
                <= (SELECT sum(source_size) FROM levels) AS is_full
  FROM levels a),
targets AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN most
              ELSE ((SELECT sum(source_size) FROM judged) :: DOUBLE
                    - (SELECT coalesce(sum(most), 0) FROM judged WHERE is_full))
                   / (SELECT sum(weight) FROM judged WHERE NOT is_full) * weight END AS target
  FROM judged),
placed AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, source,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size
                 + greatest(0, least(size, budget % source_size - before)) END :: BIGINT AS taken
FROM placed"""

# Distinct five-word shingles of a list of words; shorter texts have one.
_SHINGLES = """list_distinct(list_transform(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1),
                                    lambda i: array_to_string(w[i : i + 4], ' ')))"""
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Every document's shingles against every notice's.
_LICENSES = (
    rf"""
WITH notices(license_id, text) AS (VALUES {", ".join(f"('{name}', '{text}')" for name, text in license_scan.NOTICES.items())}),
plain AS (
  SELECT NULL AS license_id, doc_id, text FROM documents
  UNION ALL SELECT license_id, NULL, text FROM notices),
split AS (
  SELECT license_id, doc_id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM plain),
parts AS (SELECT license_id, doc_id, unnest({_SHINGLES}) AS part FROM split),
wanted AS (SELECT license_id, part, count(*) OVER (PARTITION BY license_id) AS parts FROM parts WHERE doc_id IS NULL)
SELECT d.doc_id, n.license_id, round(count(*) / any_value(n.parts), 6) AS containment
FROM parts d JOIN wanted n ON d.part = n.part
WHERE d.doc_id IS NOT NULL
GROUP BY d.doc_id, n.license_id HAVING count(*) >= {license_scan.THRESHOLD} * any_value(n.parts) - 1e-9"""
)

# Every vector against every other.
_VECTORS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding :: DOUBLE[] AS e,
         coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS usable
  FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.usable AND b.usable AND list_cosine_similarity(a.e, b.e) >= 0.95),
reached AS (
  SELECT vec_id, vec_id AS other FROM vectors
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a),
components AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) :: BIGINT AS n_links, c.component_id,
       v.vec_id = c.component_id AS kept
FROM vectors v JOIN components c ON v.vec_id = c.vec_id"""

# All pairs of different shingle sets that share a shingle.
_NEAR = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (SELECT doc_id, list_sort({_SHINGLES}) AS parts FROM words),
named AS (SELECT doc_id, parts, md5(array_to_string(parts, chr(10))) AS name FROM sets),
classes AS (
  SELECT name, min(doc_id) AS first, count(*) AS copies, any_value(parts) AS parts
  FROM named WHERE len(parts) > 0 GROUP BY name),
spread AS (SELECT name, len(parts) AS n, unnest(parts) AS part FROM classes),
near AS (
  SELECT a.name AS a, b.name AS b FROM spread a JOIN spread b ON a.part = b.part AND a.name <> b.name
  GROUP BY a.name, b.name HAVING count(*) >= 0.8 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9),
reached AS (
  SELECT name, name AS other FROM classes
  UNION SELECT r.name, e.b FROM reached r JOIN near e ON r.other = e.a),
tied AS (
  SELECT r.name, min(c.first) AS class_id FROM reached r JOIN classes c ON r.other = c.name GROUP BY r.name),
links AS (SELECT e.a AS name, sum(c.copies) AS links FROM near e JOIN classes c ON e.b = c.name GROUP BY e.a)
SELECT d.doc_id, CAST(coalesce(c.copies - 1 + coalesce(l.links, 0), 0) AS BIGINT) AS n_links,
       coalesce(t.class_id, d.doc_id) AS class_id
FROM named d LEFT JOIN classes c ON d.name = c.name AND len(d.parts) > 0
LEFT JOIN tied t ON c.name = t.name LEFT JOIN links l ON c.name = l.name"""

# Digests of the payloads, without any archive.
_CAPTURES = r"""
WITH payloads AS (
  SELECT page_id, regexp_replace(url, '[\x00-\x20\x7F]+', '%20', 'g') AS url, coalesce(html, '') AS payload FROM pages),
bits AS (
  SELECT *, CAST(CAST(unhex(sha1(payload)) AS BIT) AS VARCHAR) AS digest,
         min(page_id) OVER (PARTITION BY payload) AS first
  FROM payloads)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST(list_sum(list_transform(range(0, 5), lambda j:
           CASE WHEN substring(digest, CAST(5 * i + j + 1 AS BIGINT), 1) = '1' THEN (16 >> CAST(j AS INTEGER)) ELSE 0 END)) AS BIGINT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to, url
FROM bits"""

# Every document's shingles against every item's.
_LEAKS = f"""
WITH words AS (
  SELECT doc_id, NULL AS item_id, {_WORDS} AS w FROM documents
  UNION ALL SELECT NULL, item_id, {_WORDS} FROM benchmark),
parts AS (SELECT doc_id, item_id, unnest({_SHINGLES}) AS part FROM words),
weights AS (SELECT part, 1.0 :: DOUBLE / count(*) AS weight FROM parts WHERE doc_id IS NULL GROUP BY part),
items AS (
  SELECT item_id, p.part, weight, sum(weight) OVER (PARTITION BY item_id) AS whole
  FROM parts p JOIN weights w ON p.part = w.part WHERE doc_id IS NULL)
SELECT d.doc_id, i.item_id, round(sum(i.weight) / any_value(i.whole), 6) AS similarity
FROM parts d JOIN items i ON d.part = i.part
WHERE d.doc_id IS NOT NULL
GROUP BY d.doc_id, i.item_id HAVING sum(i.weight) / any_value(i.whole) >= 0.8 - 1e-9"""

# Counts of words and pairs as tables, less the document's own.
_SCORES = rf"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents),
tokens AS (
  SELECT row, len(w) AS n_words, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM docs),
grams AS (
  SELECT row, n_words, place, word AS c, lag(word) OVER (PARTITION BY row ORDER BY place) AS b,
         lag(word, 2) OVER (PARTITION BY row ORDER BY place) AS a
  FROM tokens),
counted AS (
  SELECT row, n_words, place,
         count(*) OVER (PARTITION BY c) - count(*) OVER (PARTITION BY row, c) AS of_one,
         count(*) OVER (PARTITION BY b, c) - count(*) OVER (PARTITION BY row, b, c) AS of_two,
         count(*) OVER (PARTITION BY a, b, c) - count(*) OVER (PARTITION BY row, a, b, c) AS of_three
  FROM grams),
contexts AS (
  SELECT *, lag(of_one) OVER (PARTITION BY row ORDER BY place) AS after_one,
         lag(of_two) OVER (PARTITION BY row ORDER BY place) AS after_two, least(place, 3) AS highest,
         CASE WHEN place > 2 AND of_three > 0 THEN 3 WHEN place > 1 AND of_two > 0 THEN 2 ELSE 1 END AS used
  FROM counted),
scored AS (
  SELECT row, sum(ln(power({lm_scores.BACKOFF} :: DOUBLE, highest - used)
                     * CASE used WHEN 3 THEN of_three / after_two WHEN 2 THEN of_two / after_one
                                 ELSE greatest(of_one :: DOUBLE, {lm_scores.UNSEEN} :: DOUBLE)
                                      / greatest((SELECT count(*) FROM tokens) - n_words, 1) END)) AS log_score,
         count(*) FILTER (used < highest) AS backed
  FROM contexts GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(log_score, 0.0 :: DOUBLE), 4) AS log_score,
       round(log_score / len(w), 8) AS mean_score, round(backed :: DOUBLE / len(w), 8) AS backed_off
FROM docs LEFT JOIN scored ON docs.row = scored.row"""

# CRC-32 of the digits of an id, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295 :: BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, byte: list_reduce(list_prepend(xor(c, byte), list_transform(range(8), lambda i: i :: BIGINT)),
    lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 :: BIGINT ELSE 0 END))))"""

# CRC-32 by a table of the steps of each byte; the least capacity by dynamic programming over all pairs of places, where the operator searches it.
_SHARDS = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
         CAST('0x' || md5(coalesce(text, ''))[1:15] AS BIGINT) AS key, hex(encode(coalesce(text, ''))) AS digits
  FROM documents),
steps AS (
  SELECT list(list_reduce(list_prepend(number, range(8)), lambda v, i:
           xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY number) AS step
  FROM range(256) AS numbers(number)),
checked AS (
  SELECT digits, xor(4294967295, list_reduce(
           list_prepend(4294967295 :: BIGINT, list_transform(regexp_extract_all(digits, '..'), lambda x: CAST('0x' || x AS BIGINT))),
           lambda c, byte: xor(c >> 8, step[1 + (xor(c, byte) & 255)]))) AS crc
  FROM (SELECT DISTINCT digits FROM docs), steps),
groups AS (SELECT key, sum(size) AS size FROM docs GROUP BY key),
ends AS (
  SELECT key, size, CAST(sum(size) OVER (ORDER BY key) AS BIGINT) AS past, row_number() OVER (ORDER BY key) AS place
  FROM groups),
places AS (SELECT place, past FROM ends UNION ALL SELECT 0, 0),
best AS (
  SELECT 1 AS k, place, past AS capacity FROM places
  UNION ALL
  SELECT b.k + 1, p.place, min(greatest(b.capacity, p.past - q.past))
  FROM best b JOIN places q ON q.place = b.place JOIN places p ON p.place >= b.place
  WHERE b.k < {sharding.SHARDS} GROUP BY b.k, p.place),
least AS (SELECT min(capacity) AS capacity FROM best WHERE k = {sharding.SHARDS} AND place = (SELECT max(place) FROM places)),
cuts AS (
  SELECT 0 AS k, CAST(0 AS BIGINT) AS cut
  UNION ALL
  SELECT c.k + 1, max(p.past)
  FROM cuts c JOIN places p ON p.past <= c.cut + (SELECT capacity FROM least)
  WHERE c.k < {sharding.SHARDS - 1} GROUP BY c.k),
placed AS (
  SELECT key, (SELECT count(*) FROM cuts WHERE k > 0 AND cut <= e.past - e.size) AS shard FROM ends e),
rows AS (
  SELECT d.doc_id, d.size, c.crc, d.key, p.shard,
         CAST('0x' || md5('slot:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || CAST(d.key AS VARCHAR))[1:15] AS BIGINT) AS hash
  FROM docs d JOIN placed p ON p.key = d.key JOIN checked c ON c.digits = d.digits)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY hash, doc_id, key) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM rows"""

# Prefixes spelt out, and every node joined to all above it.
_TRIE = rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            left(coalesce(text, ''), 32), md5(coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, max(place) + 1 AS length, {_CRC32} % 4 AS h, conv_id - conv_id % 20 AS family FROM turns GROUP BY conv_id),
plans AS (
  SELECT c.conv_id, c.family, c.h, c.length, least(c.h, coalesce(f.length, 0)) AS taken
  FROM convs c LEFT JOIN convs f ON f.conv_id = c.family),
rebuilt AS (
  SELECT p.conv_id, t.place + 1 AS depth, role, text FROM plans p JOIN turns t ON t.conv_id = p.family AND t.place < p.h
  UNION ALL
  SELECT p.conv_id, t.place - p.h + p.taken + 1, role, text FROM plans p JOIN turns t ON t.conv_id = p.conv_id AND t.place >= p.h),
paths AS (
  SELECT conv_id, depth, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS node,
         len(regexp_extract_all(text, '[^ 	-
]+')) AS words
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', 0 FROM plans),
lengths AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id),
nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
  FROM paths JOIN lengths USING (conv_id) GROUP BY depth, node),
children AS (SELECT node[: -65] AS above, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above),
counted AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.above = n.node),
sums AS (
  SELECT p.node, count(*) FILTER (n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
  FROM counted n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(n.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN sums s ON s.node = n.node LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[: -65]"""


def _spans_sql(place: int, rule: blob_ledger.Rule) -> str:
    """Spans of one rule: gaps and matches in turn, whose lengths add up."""
    # The engine's (?i) folds letters beyond ASCII too.
    pattern = rule.pattern.replace("(?i:password|passwd|secret|token|api_?key)", "_KEYWORD_").replace("(?:", "(").replace("'", "''")
    keywords = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in "password passwd secret token api_?key".split())
    whole = f"(?s)(.*?)({pattern.replace('_KEYWORD_', keywords)})"
    counted = f"regexp_extract_all(text, '{whole}', {rule.group + 2})"
    return f"""
  SELECT doc_id, row, {place} AS place, '{rule.kind}' AS kind, unnest(gaps) AS gap, unnest(matches) AS match, unnest(counted) AS counted,
         generate_subscripts(gaps, 1) AS nth
  FROM (SELECT doc_id, row, regexp_extract_all(text, '{whole}', 1) AS gaps, regexp_extract_all(text, '{whole}', 2) AS matches,
               {counted} AS counted FROM texts)"""


_SECRETS = f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents),
parts AS ({" UNION ALL ".join(_spans_sql(place, rule) for place, rule in enumerate(blob_ledger.RULES, 1))}),
ended AS (
  SELECT *, sum(length(gap) + length(match)) OVER (PARTITION BY row, place ORDER BY nth) AS finish FROM parts),
spans AS (
  SELECT row, place, kind, finish - length(match) AS start, concat_ws(':', kind, CAST(finish - length(match) AS BIGINT), CAST(finish AS BIGINT)) AS span
  FROM ended WHERE length(counted) >= CASE place {" ".join(f"WHEN {k} THEN {rule.least}" for k, rule in enumerate(blob_ledger.RULES, 1))} END)
SELECT any_value(t.doc_id) AS doc_id,
       {", ".join(f"count(*) FILTER (place = {k}) AS n_{rule.kind}" for k, rule in enumerate(blob_ledger.BASE, 1))},
       sha256(coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (place <= {len(blob_ledger.BASE)}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, place), '') AS spans
FROM texts t LEFT JOIN spans s ON s.row = t.row GROUP BY t.row"""

ORACLES = {
    "op1_source_mix": _MIX,
    "op4_license_notices": _LICENSES,
    "op5_near_vectors": _VECTORS,
    "op6_lm_scores": _SCORES,
    "op7_shingle_jaccard_join": _NEAR,
    "op8_contiguous_shards": _SHARDS,
    "op9_capture_index": _CAPTURES,
    "op10_benchmark_leaks": _LEAKS,
    "op11_prefix_trie": _TRIE,
    "op12_blob_ledger": _SECRETS,
}
