"""Substring deduplication: repeated token windows, merged into maximal intervals and removed.

Every window of ``width`` words gets a Rabin-Karp hash. Windows are dealt out by an anchor, the smallest
hash among the windows of half that width inside them: it depends on the words of the window alone, so equal windows
meet, and neighbouring windows mostly share it and travel as one row. Each task first looks for repeats among
its own documents, so that a passage of many documents leaves a task once. Where rows of an anchor meet, sorted by document,
each hash seen before in a smaller document is a repeat; repeats merge into intervals, intervals into
those of the document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.tables import stored, with_matches
from starloom.llm.words import Words, lean, windows_hash, word_slices

WIDTH = 50
_RUNS = "anchor long, doc_id long, row long, first int, last int, hashes binary"
_SPANS = "row long, first int, last int"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    size, out = 1, values
    while 2 * size <= width:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _runs_of(*keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal neighbours."""
    change = np.ones(len(keys[0]), dtype=bool)
    if len(change):
        change[1:] = False
        for key in keys:
            change[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(change)


def _windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row of the text, position, hash and anchor of every window that lies in one text."""
    half = width // 2
    hashes = windows_hash(words.hashes, width)
    sizes = np.diff(words.text_ptr)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(hashes)]
    position = np.arange(len(hashes)) - words.text_ptr[text]
    whole = position + width <= sizes[text]
    anchors = _sliding_min(windows_hash(words.hashes, half), width - half + 1) if len(hashes) else hashes
    return text[whole], position[whole], hashes[whole], anchors[whole]


def _batch(columns: list[np.ndarray], hashes: list[bytes | None]) -> pa.RecordBatch:
    anchor, doc, row, first, last = columns
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor.view(np.int64)), pa.array(doc), pa.array(row), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(hashes, pa.binary())],
        names=["anchor", "doc_id", "row", "first", "last", "hashes"],
    )


def _repeats(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether each hash also belongs to a smaller document."""
    order = np.lexsort((docs, hashes))
    starts = _runs_of(hashes[order])
    smallest = np.repeat(docs[order][starts], np.diff(np.append(starts, len(order))))
    out = np.empty(len(order), dtype=bool)
    out[order] = docs[order] > smallest
    return out


def _runs(width: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for first, last, words in word_slices(batch.column(1)):
                text, position, hashes, anchors = _windows(words, width)
                docs, rows = ids[first:last][text], numbers[first:last][text]
                if not len(docs):
                    continue
                known = _repeats(hashes, docs)
                for kept in (True, False):  # repeats within the slice go on as intervals, other windows with their hashes
                    pick = np.flatnonzero(known if kept else ~known)
                    if not len(pick):
                        continue
                    at = position[pick]
                    key = np.zeros(len(pick), dtype=np.uint64) if kept else anchors[pick]
                    starts = _runs_of(text[pick], at - np.arange(len(at)), key)
                    ends = np.append(starts[1:], len(pick))
                    raw = hashes[pick].astype("<u8").tobytes()
                    payload = [None] * len(starts) if kept else [raw[8 * a : 8 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                    # an interval needs no company: its row spreads it
                    anchor = rows[pick][starts].view(np.uint64) if kept else anchors[pick][starts]
                    yield _batch([anchor, docs[pick][starts], rows[pick][starts], at[starts], at[ends - 1] + width], payload)

    return scan


def _meet(width: int):
    """Rows come sorted by anchor and document. The hashes of the anchor at hand are the only state between batches."""

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor_now, seen = None, {}
        for batch in batches:
            anchors = batch.column(0).to_numpy()
            docs, rows, first, last = (batch.column(i).to_numpy() for i in (1, 2, 3, 4))
            payload = batch.column(5)
            known = payload.is_null().to_numpy(zero_copy_only=False)
            out = [(rows[known], first[known], last[known])]
            shared = np.zeros(len(anchors), dtype=bool)
            same = anchors[1:] == anchors[:-1]
            shared[1:] |= same
            shared[:-1] |= same
            if len(anchors):
                shared |= anchors == anchor_now
                shared |= anchors == anchors[-1]
            spans = []
            for i in np.flatnonzero(shared & ~known).tolist():
                if anchors[i] != anchor_now:
                    anchor_now, seen = anchors[i], {}
                doc, row, begin = int(docs[i]), int(rows[i]), int(first[i])
                for k, h in enumerate(np.frombuffer(payload[i].as_buffer(), dtype="<u8").tolist()):
                    if seen.setdefault(h, doc) < doc:
                        if spans and spans[-1][0] == row and spans[-1][2] == begin + k + width - 1:
                            spans[-1][2] += 1
                        else:
                            spans.append([row, begin + k, begin + k + width])
            if spans:
                out.append(tuple(np.array(column) for column in zip(*spans, strict=True)))
            for d, a, b in out:
                if len(d):
                    yield pa.RecordBatch.from_arrays([pa.array(d.astype(np.int64)), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["row", "first", "last"])

    return flag


def _row() -> Column:
    """Rows are told apart by id and text together: rows equal in both lose the same words, whatever their order or number."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``row, first, last``: word ranges covered by windows that also start in a document with a smaller id. Ranges may overlap."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _row().alias("row"))
    runs = rows.where("doc_id is not null").mapInArrow(lean(_runs(width)), _RUNS)
    return runs.repartition("anchor").sortWithinPartitions("anchor", "doc_id").mapInArrow(lean(_meet(width)), _SPANS)


def maximal(spans: DataFrame) -> DataFrame:
    """``row, spans``: overlapping or touching ranges of a row put together, in order."""
    order = Window.partitionBy("row").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first") > reach, F.lit(True)).cast("int")
    islands = spans.distinct().withColumn("opens", opens).withColumn("island", F.sum("opens").over(order))
    merged = islands.groupBy("row", "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))


def marked(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with ``_spans``: the maximal word ranges to remove, null where there are none.

    Null texts, texts under ``width`` words and rows without doc_id have none. Of equal windows those in the document with the smallest
    id stay, also its repeats inside that document; rows with the same id never remove from each other, and each loses by its own text.
    """
    spans = stored(maximal(repeated_spans(docs, width)), "spans")
    matched = with_matches(docs.withColumn("_llm_row", _row()), spans.select(F.col("row").alias("_llm_row"), F.col("spans").alias("_spans")), "_llm_row")
    return matched.drop("_llm_row")


def _kept_words(text: bytes, spans) -> tuple[list[bytes], int]:
    """Words that stay, and how many there were. ``bytes.split`` separates at exactly the six white space bytes."""
    words = text.split()
    kept, at = [], 0
    for span in spans if spans is not None else ():
        kept += words[at : span["first"]]
        at = span["last"]
    return kept + words[at:], len(words)


@F.pandas_udf(T.StringType())
def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([b" ".join(_kept_words(t.encode(), s)[0]).decode() for t, s in zip(text, spans, strict=True)], dtype=object)


def deduplicate(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The columns of ``docs``; a text that loses words becomes its kept words joined by one space, others stay as they are."""
    rows = marked(docs, width)
    hit, other = rows.where("_spans is not null"), rows.where("_spans is null")
    return hit.withColumn("text", _cut(F.col("text").cast("string"), "_spans")).unionByName(other).select(*docs.columns)


@F.pandas_udf(T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]))
def _digest(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for t, s in zip(text, spans, strict=True):
        kept, n = _kept_words((t or "").encode(), s)
        rows.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])


def removal_report(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per document: words, removed words, SHA-256 of the kept words joined by one space."""
    rows = marked(docs.select("doc_id", "text"), width).select("doc_id", _digest(F.col("text").cast("string"), "_spans").alias("d"))
    return rows.select("doc_id", "d.*")
