"""Record files: published checksums, round trips through files, order, corruption, shuffled reads, and the query against the tokenizer."""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import encoding, records
from starloom.llm.queries import QUERIES
from starloom.session import scratch_path

_tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def wanted(rows: list[tuple]) -> list[tuple]:
    """Rows of the query by one loop over ``(doc_id, text)`` in order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*_tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def reported(df) -> list[tuple]:
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


def test_checksums_have_published_values():
    assert records.crc32c([b"123456789", b"", bytes(32), b"\xff" * 32, bytes(range(32))]).tolist() == [0xE3069283, 0, 0x8A9136AA, 0x62A8AB43, 0x46DD794E]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=8))
def test_frames_round_trip(parts):
    data = b"".join(records.framed(parts))
    assert records.unframed(data) == parts
    for part, alone in zip(parts, records.crc32c(parts).tolist(), strict=True):
        assert records.crc32c([part]).tolist() == [alone]


def test_damage_is_seen():
    data = b"".join(records.framed([b"some payload", b"another"]))
    for at in range(len(data)):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(records.CorruptRecord):
            records.unframed(bytes(broken))
    with pytest.raises(records.CorruptRecord):
        records.unframed(data[:-1])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\r\x0b\x85\x1c ab'sé漢1!🙂<|endoftext|>", max_size=20) | st.lists(st.sampled_from(["<|endoftext|>", "a", " ", "\n", "b<", "|>"])).map("".join))
def test_encoder_equals_the_tokenizer_with_special_tokens(text):
    assert encoding.encoder().encode(text).tolist() == _tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer_over_the_test_table():
    """All texts of a table, with and without ids for the strings of special tokens."""
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    for text in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist():
        for reference, own in ((_tokenizer, encoding.encoder()), (plain, encoding.encoder(plain=True))):
            assert own.encode(text or "").tolist() == reference.encode(text or "", add_special_tokens=False).ids


def test_query_over_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    assert reported(QUERIES["op13_token_records"](spark, "/root/testdata/sf0.001")) == wanted([tuple(r) for r in docs])


def test_query_over_edges(spark, folder):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert reported(QUERIES["op13_token_records"](spark, folder)) == wanted(docs)


ROWS = [(5, "five <|endoftext|> words"), (None, "no id"), (2, None), (2, "two"), (2, "two"), (7, "x " * 5000), (2**60 + 1, "large"), (-3, ""), (None, None)]


def test_order_of_null_and_repeated_ids(spark):
    path = scratch_path(spark, "test-records")
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in ROWS], "doc_id long, text string, file string, record long").repartition(3)
    records.write_records(docs, path, file_bytes=200)
    rows = reported(records.record_report(spark, path, split_bytes=64))
    ids = [r[0] for r in rows]
    assert ids == [-3, 2, 2, 2, 5, 7, 2**60 + 1, None, None]
    assert sorted((r[0] or 0, *r[2:]) for r in rows) == sorted((r[0] or 0, *r[2:]) for r in wanted(ROWS))
    assert [r[1] for r in rows] == np.cumsum([0, *(r[2] for r in rows)]).tolist()[:-1]
    files = os.listdir(f"{path.removeprefix('file:')}/data")
    assert len(files) == records.index(spark, path).select("file").distinct().count() > 1
    with pytest.raises(FileExistsError):
        records.write_records(docs, path)


def test_shuffled_reads_give_each_record_once(spark, folder):
    path = scratch_path(spark, "test-records")
    records.write_records(spark.read.parquet(f"{folder}/documents.parquet"), path)
    stored = {(r.file, r.record): (r.doc_id, r.ids) for r in records.read_records(spark, path).collect()}
    first, again, other = ([(r.file, r.record, r.doc_id, r.ids) for r in records.shuffled_records(spark, path, seed).collect()] for seed in (1, 1, 2))
    assert first == again != other
    for rows in (first, other):
        assert {(f, r): (d, i) for f, r, d, i in rows} == stored and len(rows) == len(stored) == 16


def test_files_without_an_index_row_go(spark, tmp_path):
    """A file that a lost task left behind is no part of the result."""
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(10)], "doc_id long, text string").repartition(2)
    records.write_records(docs, path)
    name = os.listdir(f"{path}/data")[0]
    with open(f"{path}/data/{name}", "rb") as f:
        rest = f.read()
    with open(f"{path}/data/part-stray.rec", "wb") as f:
        f.write(rest)
    assert records.record_report(spark, path).count() == 10


def test_a_changed_file_is_refused(spark, tmp_path):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    records.write_records(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), path)
    (name,) = os.listdir(f"{path}/data")
    with open(f"{path}/data/{name}", "r+b") as f:
        f.seek(20)
        f.write(b"\xff")
    with pytest.raises(Exception, match="checksum"):
        records.record_report(spark, path).collect()
