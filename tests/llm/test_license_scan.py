import random
from pathlib import Path

import pytest

import brute
from deposit_analytics.llm import license_scan


def run(spark, rows, notices):
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, at int, license_id string")
    known = spark.createDataFrame([(*one, 3) for one in notices.items()], "license_id string, text string, doc_id int")
    return {(r.doc_id, r.license_id): round(r.containment, 6) for r in license_scan.find_licenses(docs, known).collect()}


def want(rows, notices):
    return {pair: round(share, 6) for pair, share in brute.licenses(rows, notices).items()}


def test_notices_at_any_place_and_with_edits(spark):
    rng = random.Random(3)
    rows = []
    for text in license_scan.NOTICES.values():
        for before in (0, 1, 2, 3, 5, 9, 40, 4091):
            tokens = text.split()
            if before % 2:
                tokens[rng.randrange(len(tokens))] = "EDIT"
            fill = [f"f{rng.randrange(900)}x" for _ in range(before + 15)]
            rows.append((len(rows), " ".join([*fill[:before], *tokens, *fill[before:]])))
    assert run(spark, rows, license_scan.NOTICES) == want(rows, license_scan.NOTICES)


def test_parts_of_a_notice_that_lie_apart_add_up(spark):
    notices = {"long": " ".join(f"w{k}" for k in range(44)), "short": " ".join(f"v{k}" for k in range(26))}
    rows = []
    for text in notices.values():
        tokens = text.split()
        for cut in range(5, len(tokens) - 4):
            for inserted in (60, 5000):
                rows.append((len(rows), " ".join(tokens[:cut] + [f"f{k}" for k in range(inserted)] + tokens[cut:])))
    assert run(spark, rows, notices) == want(rows, notices)
    assert len(want(rows, notices)) == len(rows)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = license_scan.find_licenses(docs, license_scan.templates(spark)).collect()
    assert {(r.doc_id, r.license_id): round(r.containment, 6) for r in found} == want(rows, license_scan.NOTICES)
    assert found


def test_odd_rows(spark):
    mit = license_scan.NOTICES["MIT"]
    notices = {"a": mit, "b": None, "c": "", "d": "two words", "e": mit}
    rows = [(None, mit), (1, None), (2, ""), (3, mit.upper().replace(" ", " -- ")), (3, mit), (4, "Two, words!"), (5, "w " * 30000 + mit)]
    assert run(spark, rows, notices) == {(3, "a"): 1.0, (3, "e"): 1.0, (4, "d"): 1.0, (5, "a"): 1.0, (5, "e"): 1.0}
    assert run(spark, rows, {}) == {}
    assert run(spark, [], notices) == {}


def test_windows_of_every_class_meet_their_template():
    for size, step in license_scan.CLASSES.items():
        for begin in range(3 * step):
            first = -(-begin // step) * step
            assert first + size <= begin + size + step - 1


def test_bands_alone_reach_the_recall(spark):
    """Whole licenses with random edits: bands are the only way to be found."""
    rng = random.Random(4)
    rows = []
    for text in license_scan.NOTICES.values():
        for _ in range(8):
            tokens = text.split()
            for _ in range(rng.randrange(1 + len(tokens) // 30)):
                tokens[rng.randrange(len(tokens))] = rng.choice(["edit", "two words", ""])
            fill = [f"f{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 40))]
            rows.append((len(rows), " ".join([*fill, *tokens, *fill])))
    expected, got = want(rows, license_scan.NOTICES), run(spark, rows, license_scan.NOTICES)
    assert len(expected) >= len(rows)
    assert set(got) <= set(expected)
    assert len(got) >= 0.99 * len(expected)


def test_common_licenses_are_told_apart(spark):
    texts = {name: f"Copyright someone. {text} The end." for name, text in license_scan.NOTICES.items()}
    found = run(spark, list(enumerate(texts.values())), license_scan.NOTICES)
    for k, name in enumerate(texts):
        assert (k, name) in found
    assert not {(list(texts).index("AGPL-notice"), "GPL-notice"), (list(texts).index("LGPL-notice"), "GPL-notice")} & set(found)


def edited(rng, text, every):
    tokens = text.split()
    for _ in range(len(tokens) // every):
        tokens[rng.randrange(len(tokens))] = rng.choice(["edit", "two words", ""])
    return " ".join(tokens)


def test_templates_of_any_length_from_a_folder(spark, tmp_path):
    rng = random.Random(5)
    notices = {f"long-{size}.0": " ".join(f"w{rng.randrange(300)}" for _ in range(size)) for size in (3, 90, 700, 4000)}
    notices["begins-alike"] = notices["long-4000.0"][:9000] + notices["long-700.0"]
    for name, text in notices.items():
        (tmp_path / f"{name}.txt").write_text(text.replace(" ", "\n") + "\n")
    (tmp_path / "plain").write_text("a file without an ending of its name")
    (tmp_path / "empty.txt").write_text("")
    known = license_scan.templates_from(spark, str(tmp_path))
    read = {r.license_id: " ".join(r.text.split()) for r in known.collect() if r.text}
    assert read == {**notices, "plain": "a file without an ending of its name"}
    rows = []
    for text in notices.values():
        for every in (10**6, 60, 30):
            rows.append((len(rows), f"Copyright someone {edited(rng, text, every)} the end of it"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.license_id): round(r.containment, 6) for r in license_scan.find_licenses(docs, known).collect()}
    assert got == want(rows, read)


COMMON = Path("/usr/share/common-licenses")


@pytest.mark.skipif(not COMMON.is_dir(), reason="no folder of license texts")
def test_full_texts_of_common_licenses(spark):
    rng = random.Random(6)
    known = license_scan.templates_from(spark, str(COMMON))
    texts = {r.license_id: r.text for r in known.collect()}
    rows = []
    for text in texts.values():
        rows += [(len(rows) + k, f"Some words before. {edited(rng, text, every)} And behind.") for k, every in enumerate((10**6, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.license_id): round(r.containment, 6) for r in license_scan.find_licenses(docs, known).collect()}
    assert got == want(rows, texts)
    assert {doc_id for doc_id, _ in got} >= set(range(0, len(rows), 2))
