import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from deposit_analytics.llm import shingles, token_files
from deposit_analytics.sources import sinks

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "   ", "a  b  c\t\n d don't you'll 1st 2,3 x.y", "<|endoftext|>foo<|endoftext|> bar", "\x1c. x\x1d  \n\n y",
       "“q” — …  z", "é.è, ü!? ß's 'S it's　　k    x", "日本語 テキスト。 emoji 😀😀!\r\n\r\nx", "\n", " \n x\n\ty ", "x" * 9000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**17), st.integers(0, 2**64 - 1)), max_size=700))
def test_packed_ids_come_back(ids):
    ids = np.array(ids, np.uint64)
    words, begins, escapes = token_files.pack(ids)
    assert (token_files.unpack(words, begins, escapes, len(ids)) == ids).all()
    # Any block can be read alone.
    if len(ids) > token_files.BLOCK:
        cut = int(begins[1])
        assert (token_files.unpack(words[:cut], begins[:1], escapes, token_files.BLOCK) == ids[: token_files.BLOCK]).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab Z9.,'\"!\n\t\r\x0b\x1c\x85  é日😀<|>", max_size=40), min_size=1, max_size=6))
def test_cut_texts_encode_as_whole_ones(texts):
    import pyarrow as pa

    encode = test_cut_texts_encode_as_whole_ones.__dict__.setdefault("encoder", token_files.Encoder(PATH))
    ids, begins = encode(*shingles.text_bytes(pa.array(texts)))
    for k, text in enumerate(texts):
        want = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[begins[k] : begins[k + 1]].tolist() == want, repr(text)


def test_runs_of_space_characters_encode_as_in_whole_texts():
    """Blank lines and every other run of up to four space characters, between words and at the ends."""
    encode = token_files.Encoder(PATH)
    runs = ["".join(run) for many in range(1, 5) for run in itertools.product(" \n\t\r", repeat=many)]
    texts = ["a\n\nfoo", "First para.\n\nSecond para.", "a\n\n\n\nfoo", "", "a\n\n", "", "foo"]
    texts += [f"{before}{run}{after}" for run in runs for before in ("", "a", "é.") for after in ("", "foo", "!x", "1é")]
    ids, begins = encode(*shingles.text_bytes(pa.array(texts)))
    for k, text in enumerate(texts):
        want = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[begins[k] : begins[k + 1]].tolist() == want, repr(text)


def test_query_equals_the_library(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = entry.queries()["op2_token_files"](spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == plain(tokenizer, rows)


def test_odd_rows(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME", 50)
    rows = [(k % 7 - 2, text) for k, text in enumerate(ODD)] + [(None, "n"), (3, None), (3, None)]
    frame = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, start int, ids string")
    folder = sinks.work_folder(spark, "tokens")
    token_files.write(frame, folder, PATH)
    read = token_files.read(spark, folder)
    got = read.select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()
    assert sorted(map(tuple, got), key=str) == plain(tokenizer, rows)
    empty = sinks.work_folder(spark, "tokens")
    token_files.write(frame.limit(0), empty, PATH)
    assert token_files.read(spark, empty).count() == 0
