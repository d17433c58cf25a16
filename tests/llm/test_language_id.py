import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from deposit_analytics.llm import language_id

SF = "/root/testdata/sf0.01"


def labelled(docs):
    return docs.select("doc_id", "text", F.col("lang").alias("label"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(labelled(docs.where("doc_id % 2 = 0")))
    others = docs.where("doc_id % 2 = 1")
    # Without any declaration, so the text and the host's prior decide.
    judged = language_id.identify(language_id.document_records(others.withColumn("lang", F.lit(None).cast("string"))), model)
    right = judged.join(others.select("doc_id", F.col("lang").alias("truth")), "doc_id")
    total, hits, kept = right.agg(
        F.count("*"), F.sum((F.col("lang") == F.col("truth")).cast("int")), F.sum(F.col("kept").cast("int"))
    ).first()
    assert hits >= 0.99 * total
    assert kept >= 0.99 * total


def test_pages(spark):
    docs, pages = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "pages"))
    judged = language_id.identify(language_id.page_records(pages), language_id.fit(labelled(docs)))
    claimed = pages.select(F.col("page_id").alias("doc_id"), F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("claimed"))
    total, hits = judged.join(claimed, "doc_id").agg(
        F.count("*"), F.sum((F.col("lang") == F.col("claimed")).cast("int"))
    ).first()
    assert total == pages.count()
    assert hits >= 0.95 * total


def test_evidence_is_fused(spark):
    """A text that says little goes with its declaration, and next with its host."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(labelled(docs))
    sources = {"de": "http-de", "en": "http-en"}
    rows = [(r.doc_id, r.text, None, "x", sources[r.lang]) for r in docs.where("lang in ('de', 'en')").limit(400).collect()]
    rows = [(k, t, "de" if h == "http-de" else "en", s, h) for k, t, _, s, h in rows]
    rows += [(-1, "at", None, "x", "http-de"), (-2, "at", None, "x", "http-en"), (-3, "at", "de", None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, declared string, suffix string, host string")
    found = {r.doc_id: r for r in language_id.identify(frame, model).where("doc_id < 0").collect()}
    assert found[-1].lang == "de"
    assert found[-2].lang == "en"
    assert found[-1].confidence < 1


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(labelled(docs))
    rows = [(None, None, None, None), (1, "", "en", "s"), (2, "123 ### 4", "fr", None), (3, "the and of " * 50000, "xx", "s"),
            (3, "the and of " * 50000, "xx", "s"), (4, "日本語", "", "")]
    docs = spark.createDataFrame([(*row, "z", 1) for row in rows], "doc_id long, text string, lang string, source string, host string, p0 int")
    out = language_id.identify(language_id.document_records(docs), model).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.kept for r in out}
    assert not kept[None] and not kept[1] and not kept[2] and kept[3]
    assert language_id.identify(language_id.document_records(docs.limit(0)), model).count() == 0


def test_rejected_documents_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame([(10**9, "12 34 ... !!", "en", "src0", 3), (None, "", None, None, 0)], docs.schema)
    kept = language_id.identified(docs.unionByName(more))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(
        [str(r.doc_id) for r in docs.select("doc_id").collect()]
    )


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a text", None, "s")], "doc_id long, text string, lang string, source string")
    assert language_id.identified(docs).count() == 1
    assert language_id.identified(docs.limit(0)).count() == 0


def test_short_and_mixed_texts_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(labelled(docs))
    texts = {r.lang: r.text[:600] for r in docs.where("length(text) > 800").collect()}
    rows = [(1, "a", "en", "s"), (2, "I", None, None), (3, texts["en"] + " " + texts["fr"], "en", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert all(r.kept for r in language_id.identify(language_id.document_records(frame), model).collect())


def test_a_label_with_few_rows_is_a_language(spark):
    """Five rows among ten thousand, and a further text in that language without a declaration."""
    words = "kala vesi metsa taivas lintu puu kivi jarvi talvi kesa poika tytto leipa maito".split()
    rare = [" ".join(words[(k * j + j) % len(words)] for j in range(300)) for k in (3, 5, 9, 11, 13, 15)]
    common = "the house of the river and a garden with many flowers near this old town"
    rows = [(k, f"{common} {k}", "en", "s") for k in range(10_000)] + [(20_000 + k, one, "fi", "s") for k, one in enumerate(rare)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language_id.fit(labelled(docs.where("doc_id <> 20005")))
    assert model.languages == ("en", "fi")
    records = language_id.document_records(docs.withColumn("lang", F.when(F.col("doc_id") != 20005, F.col("lang"))))
    found = {r.doc_id: r.lang for r in language_id.identify(records, model).collect()}
    assert {k: one for k, one in found.items() if one != "en"} == {20_000 + k: "fi" for k in range(6)}


def noise(kind):
    rng = random.Random(kind)
    if kind == "hex":
        return "".join(rng.choice("0123456789abcdef") for _ in range(600))
    if kind == "keys":
        return " ".join("".join(rng.choice("asdfghjklqwertyuiopzxcvbnm") for _ in range(rng.randrange(3, 10))) for _ in range(80))
    if kind == "base64":
        return "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(400))
    if kind == "ru":
        return "Съешь же ещё этих мягких французских булок, да выпей чаю. Широкая электрификация южных губерний."
    return "中华人民共和国宪法规定公民有言论自由和出版自由以及集会结社游行示威的自由"


@pytest.mark.parametrize("kind", ["ru", "zh", "hex", "keys", "base64"])
def test_texts_in_no_fitted_language_go(spark, kind):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    count = docs.count()
    more = spark.createDataFrame([(10**9, noise(kind), "en", "src0", 3), (5, noise(kind), "fr", None, 0), (None, noise(kind), None, None, 0)], docs.schema)
    kept = language_id.identified(docs.unionByName(more)).collect()
    # Those alone go, and the document whose id one of them repeats stays.
    assert len(kept) == count
    assert len({r.doc_id for r in kept}) == count


def test_a_labelled_language_is_fitted_and_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = noise("ru").replace(",", "").replace(".", "").split()
    rng = random.Random(2)
    more = [(10**9 + k, " ".join(rng.choices(words, k=60)), "ru" if k else None, "src0", 3) for k in range(20)]
    kept = {r.doc_id: r.lang for r in language_id.identified(docs.unionByName(spark.createDataFrame(more, docs.schema))).collect()}
    # The one without a label has got it.
    assert {kept[10**9 + k] for k in range(20)} == {"ru"}


def test_the_language_is_carried_on(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    asked = F.when(F.col("doc_id") % 10 == 3, F.lit(None)).when(F.col("doc_id") % 10 == 4, F.upper("lang")).otherwise(F.col("lang"))
    kept = language_id.identified(docs.withColumn("lang", asked)).select("doc_id", F.col("lang").alias("found"))
    wrong = kept.join(docs, "doc_id").where("lower(found) <> lang OR found IS NULL")
    assert kept.count() == docs.count()
    assert wrong.count() <= 1
    assert kept.where("doc_id % 10 = 4 AND found <> upper(found)").count() <= 1


def plain(records, model):
    """lang, confidence, kept of (text, declared, suffix, host), one formula after the other."""
    count = len(model.languages)
    every, mean, deviation = model.absolute()
    judged = []
    for text, declared, _, _ in records:
        folded = [b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b if 97 <= b <= 122 or b > 127 else 32 for b in (text or "").encode()]
        codes = [folded[i : i + 3] for i in range(len(folded) - 2) if any(b not in (32, 48) for b in folded[i : i + 3])]
        buckets = [((a | b << 8 | c << 16) * 0x9E3779B1 % 2**32) >> (32 - language_id.BUCKET_BITS) for a, b, c in codes]
        n = len(buckets)
        logs = [sum(float(model.table[k, one]) for one in buckets) for k in range(count)]
        best = logs.index(max(logs))
        known = not n or mean[best] - sum(every[one] for one in buckets) / n <= language_id.MARGIN + language_id.ERRORS * deviation[best] * math.sqrt(3 / n)
        weight = min(n / 3, language_id.MOST_EVIDENCE) / max(n, 1)
        logs = [(one - max(logs)) * weight for one in logs]
        shares = [math.exp(one) / sum(map(math.exp, logs)) for one in logs]
        judged.append((n, known, logs, shares, any(b not in (32, 48) for b in folded)))
    sums = {name: defaultdict(lambda: [0.0] * count) for name in ("all", "suffix", "host", "declared")}
    for (_, declared, suffix, host), (n, known, _, shares, _) in zip(records, judged, strict=True):
        if n and known:
            keys = [("all", 0), ("suffix", suffix), ("host", host)] + [("declared", declared)] * (declared is not None)
            for name, key in keys:
                sums[name][key] = [a + b for a, b in zip(sums[name][key], shares, strict=True)]
    prior = [(one + 1) / (sum(sums["all"][0]) + count) for one in sums["all"][0]]
    claimed = [sum(row[k] for row in sums["declared"].values()) for k in range(count)]
    out = []
    for (_, declared, suffix, host), (n, known, logs, shares, has) in zip(records, judged, strict=True):
        of_suffix, of_host, of_claim = sums["suffix"][suffix], sums["host"][host], sums["declared"][declared]
        others = [max(a - (b if n and known else 0), 0) for a, b in zip(of_host, shares, strict=True)]
        final = []
        for k in range(count):
            parent = (of_suffix[k] + language_id.STRENGTH * prior[k]) / (sum(of_suffix) + language_id.STRENGTH)
            place = (others[k] + language_id.STRENGTH * parent) / (sum(others) + language_id.STRENGTH)
            claim = (of_claim[k] + sum(of_claim) / max(sum(claimed), 1) + 1e-3) / (claimed[k] + 1 + 1e-3)
            final.append(logs[k] + math.log(place) + (math.log(claim) if declared is not None else 0))
        weights = [math.exp(one - max(final)) for one in final]
        out.append((model.languages[weights.index(1)], round(1 / sum(weights), 6), bool(has and known and 1 / sum(weights) >= language_id.LEAST_CONFIDENCE)))
    return out


def test_fusion_equals_the_plain_formulas(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(labelled(docs))
    rng = random.Random(7)
    rows = []
    for k, r in enumerate(docs.orderBy("doc_id").limit(150).collect()):
        text = rng.choice([r.text[:4000], r.text[: rng.randrange(40)], "ab", "", "12 3", None, noise(rng.choice(["ru", "zh", "hex", "keys"]))])
        rows.append((k, text, rng.choice([r.lang, r.lang, None, "xx"]), rng.choice(["com", "fr", None]), rng.choice(["a", "b", "c", None])))
    frame = spark.createDataFrame(rows, "doc_id long, text string, declared string, suffix string, host string")
    got = {r.doc_id: (r.lang, round(r.confidence, 6), r.kept) for r in language_id.identify(frame, model).collect()}
    want = plain([row[1:] for row in rows], model)
    for k, (lang, confidence, kept) in enumerate(want):
        assert got[k][0] == lang
        assert got[k][1] == pytest.approx(confidence, abs=1e-4)
        assert got[k][2] == kept
