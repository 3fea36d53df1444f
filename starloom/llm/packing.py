"""Packing token ids into fixed windows by best-fit decreasing.

A document longer than a window is first cut into full windows; what is left of it, and every shorter document, is
placed by best fit decreasing. Pieces are dealt at random into groups of bounded size that are packed independently, so
the work spreads and no task holds more than a group; a group of thousands of pieces packs as tightly as the whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.encoding import encoder
from starloom.llm.tables import stored
from starloom.llm.words import lean, slices, string_buffers

WINDOW = 1024
GROUP_PIECES = 40_000
END_ID = 0
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cut(window: int, vocabulary: str | None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        end = np.array([END_ID], dtype="<u4")
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            _, bounds = string_buffers(texts)
            for first, last in slices(bounds):
                rows = []
                for doc, text in zip(ids[first:last].to_pylist(), texts[first:last].to_pylist(), strict=True):
                    tokens = np.concatenate([encode(text or ""), end])
                    total = len(tokens)
                    for start in range(0, total, window):
                        length = min(window, total - start)
                        rows.append((doc, start, length, zlib.crc32(tokens[start : start + length]), total))
                yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return scan


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree that tells which capacities occur."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [False] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(self.leaves)]

    def _mark(self, capacity: int, value: bool) -> None:
        i = capacity + self.leaves
        self.tree[i] = value
        while i > 1:
            i >>= 1
            value = self.tree[2 * i] or self.tree[2 * i + 1]
            if self.tree[i] == value:
                return
            self.tree[i] = value

    def put(self, capacity: int, item: int) -> None:
        self.at[capacity].append(item)
        if len(self.at[capacity]) == 1:
            self._mark(capacity, True)

    def take(self, least: int) -> tuple[int, int] | None:
        """A window of the smallest remaining capacity that is ``least`` or more."""
        i = least + self.leaves
        if not self.tree[i]:
            while True:  # up to the first subtree on the right that holds one, then down its left side
                if i & (i + 1) == 0:
                    return None
                if i & 1 == 0 and self.tree[i + 1]:
                    i += 1
                    break
                i >>= 1
            while i < self.leaves:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        item = self.at[capacity].pop()
        if not self.at[capacity]:
            self._mark(capacity, False)
        return capacity, item


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window and offset of each length; lengths come in decreasing order."""
    windows = OpenWindows(window)
    where, offsets, used = [], [], 0
    for length in lengths:
        capacity, item = windows.take(length) or (window, used)
        used += item == used
        where.append(item)
        offsets.append(window - capacity)
        if capacity > length:
            windows.put(capacity - length, item)
    return where, offsets


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A null or empty text is the end id alone. Every row of ``docs`` is a document of its own, also where ids repeat or are null.
    Sequences are numbered with gaps; within a sequence offsets are gapless from 0. No rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stored(rows.mapInArrow(lean(_cut(window, vocabulary)), _PIECES), "pieces").withColumn("row", F.monotonically_increasing_id())
    groups = max(1, -(-pieces.count() // group_pieces))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "row"], ascending=[False, True, True, True], ignore_index=True)
        where, offsets = best_fit(group["length"].tolist(), window)
        group["sequence_id"] = group["group"].astype("int64") * (1 << 32) + np.array(where, dtype=np.int64)
        group["offset"] = np.array(offsets, dtype=np.int64)
        return group.drop(columns=["row", "group"])

    # a group holds about group_pieces rows by construction, whatever the documents; a null id is set aside, as pandas would make all ids floats
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    dealt = dealt.withColumn("no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    columns = [*(c.split()[0] for c in _PIECES.split(", ")), "no_id", "row", "group"]
    packed = dealt.select(columns).groupBy("group").applyInPandas(fill, f"{_PIECES}, no_id boolean, sequence_id long, offset long")
    return packed.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")
