"""The pipeline's stages against their plain versions, each on its own input."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from deposit_analytics.llm.common import committed, stored
from deposit_analytics.sources import sinks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        found.append(docs)
    return [frame.collect() for frame in found]


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "mixing", "sharding"]


def test_clean_documents_pass_language_id(results):
    assert sorted(r.doc_id for r in results[1]) == sorted(r.doc_id for r in results[0])


def test_one_document_of_each_group_stays(results):
    groups = brute.near_groups([(r.doc_id, r.text) for r in results[1]])
    assert sorted(r.doc_id for r in results[2]) == sorted(doc_id for doc_id, _, first in groups if doc_id == first)


def test_leaks_go(spark, results):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {doc_id for doc_id, _ in brute.leaks([(r.doc_id, r.text) for r in results[2]], items)}
    assert sorted(r.doc_id for r in results[3]) == sorted(r.doc_id for r in results[2] if r.doc_id not in leaked)


def test_mix_and_shards(results):
    copies = {doc_id: copies for doc_id, _, _, copies in brute.mix([(r.doc_id, r.source, r.text) for r in results[3]])}
    assert Counter(r.doc_id for r in results[4]) == Counter({doc_id: n for doc_id, n in copies.items() if n})
    sizes = Counter()
    for r in results[4]:
        sizes[brute.text_key(r.text)] += len(r.text.encode()) + 1
    keys = sorted(sizes)
    want = dict(zip(keys, brute.greedy_shards([sizes[key] for key in keys])[1], strict=True))
    assert Counter((r.doc_id, r.shard) for r in results[5]) == Counter((r.doc_id, want[brute.text_key(r.text)]) for r in results[4])
    for slots in brute.grouped((r.shard, r.slot) for r in results[5]).values():
        assert sorted(slots) == list(range(len(slots)))


def test_stages_return_the_columns_of_documents(spark, results):
    names = spark.read.parquet(f"{SF}/documents.parquet").columns
    for rows in results[1:5]:
        assert rows[0].__fields__ == names


def test_a_run_equals_its_stages_and_leaves_only_its_result(spark, results):
    with sinks.scratch(spark) as folder:
        out = corpus_pipeline.run(spark, SF)
        assert Counter(map(tuple, out.collect())) == Counter(map(tuple, results[5]))
        left = [one.name for one in Path(folder).iterdir()]
    assert len(left) == 1 and left[0].startswith("sharding-")


def test_a_failed_job_leaves_nothing(spark):
    with sinks.scratch(spark) as folder:
        with pytest.raises(Exception, match="never"):
            committed(spark, "job", lambda: stored(spark.range(9), "on_the_way").select(F.raise_error(F.lit("never"))))
        empty, kept = committed(spark, "job", lambda: stored(spark.range(0), "on_the_way"))
        assert empty.count() == 0 and [str(one) for one in Path(folder).iterdir()] == [kept]


def test_odd_rows_and_clashing_columns_pass_every_stage(spark):
    """Ids repeated and missing, texts repeated, empty and very long, columns that the stages use themselves."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").first().text
    first, second, third = (r.text for r in docs.where("length(text) between 400 and 900 and lang = 'en'").orderBy("doc_id").limit(3).collect())
    rows = [(1, first), (1, second), (2, second), (None, third), (None, third), (1, f"{first} {item}"), (None, f"{second} {item}"),
            (3, None), (4, ""), (5, f"{third} word " * 3000), (6, "12 34")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, doc string, shard string, size int, slot string, found int"
    frame = spark.createDataFrame([(*row, "en", "s", 1, 2, "d", "h", 3, "l", 4) for row in rows], schema)
    others = docs
    for name in ("row", "doc", "shard", "size", "slot", "found"):
        others = others.withColumn(name, F.lit(None).cast(frame.schema[name].dataType))
    kept = others.unionByName(frame)
    for name, stage in corpus_pipeline.STAGES:
        kept = stored(stage(spark, kept, SF), name)
        if name != "sharding":
            assert kept.columns == frame.columns
    found = [r for r in kept.collect() if r.row == 2]
    assert {(r.doc_id, r.text) for r in found} <= {(1, first), (1, second), (None, third), (5, rows[9][1])}
    assert {r.n_chars for r in found} == {1}
    assert {r.doc_shard for r in found} == {"h"}


def test_an_empty_table_passes_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        assert docs.count() == 0
