"""Alignment of two tokenizations of the same texts, by lockstep merging of their token ends.

A batch of documents is encoded by both tokenizers. One vector of pointer pairs, one pair a lane, walks all of them at once:
each step links the tokens under the pointers, moves the pointer whose token ends first (both where they end together, which is a cut)
and drops the lanes that are done. A lane is a document or, in a long one, a part between two places where tokens of both end.

Corpus-wide counts of linked id pairs never meet a document's rows one by one. A task works in blocks of documents; a block keeps its distinct pairs
once, and per document only places in that list. Distinct pairs of blocks are counted and joined with their counts,
and come back to the block as one list. No pair, however frequent, has more than a row for each block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.encoding import encoder
from starloom.llm.tables import stored
from starloom.llm.words import slices, string_buffers

PIECES = "piece_bpe_32k.model"
BLOCK_BYTES = 1 << 22
LANE_TOKENS = 512
_BLOCK = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "sizes array<long>, steps binary, times binary, pairs binary, holders binary"
)
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, vocabulary: str | None = None, pieces: str | None = None):
        self.a = encoder(vocabulary, True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces or public_tokenizers.path(PIECES))
        self.b_bytes = [self._piece(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.a_length = np.zeros(1 + max(self.a.token_bytes), dtype=np.int64)
        self.a_length[list(self.a.token_bytes)] = [len(b) for b in self.a.token_bytes.values()]
        self.b_length = np.array([len(b) for b in self.b_bytes], dtype=np.int64)

    @staticmethod
    def _piece(piece: str, is_byte: bool) -> bytes:
        return bytes([int(piece[3:-1], 16)]) if is_byte else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids by A and B of each text with a space before it; none where a text is null, empty or not given back byte by byte."""
        none = np.empty(0, dtype=np.int64)
        full = [i for i, text in enumerate(texts) if text]
        a, b = [none] * len(texts), [none] * len(texts)
        for i, pieces in zip(full, self.b.encode([texts[i] for i in full], num_threads=1), strict=True):
            spaced = " " + texts[i]
            wanted = spaced.encode()
            if b"".join(map(self.b_bytes.__getitem__, pieces)) == wanted:
                ids = self.a.encode(spaced).astype(np.int64)
                if self.a_length[ids].sum() == len(wanted):  # byte-level: equal in length is equal
                    a[i], b[i] = ids, np.array(pieces, dtype=np.int64)
        return a, b


@lru_cache(maxsize=1)
def tokenizers(vocabulary: str | None, pieces: str | None) -> Tokenizers:
    return Tokenizers(vocabulary, pieces)


def lanes(a_end: np.ndarray, b_end: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray, lane_tokens: int = LANE_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First A and B token of each lane and the A token after its last; documents without tokens have none."""
    inside = np.arange(lane_tokens, len(a_end), lane_tokens)
    place = np.searchsorted(b_end, a_end[inside - 1])
    inside, place = inside[b_end[place] == a_end[inside - 1]], place[b_end[place] == a_end[inside - 1]] + 1
    some = a_bounds[:-1] < a_bounds[1:]
    a, first = np.unique(np.concatenate([a_bounds[:-1][some], inside]), return_index=True)
    b = np.concatenate([b_bounds[:-1][some], place])[first]
    return a, b, np.append(a[1:], len(a_end))


def merge(a_end: np.ndarray, b_end: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray, lane_tokens: int = LANE_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links as A and B token numbers, and for each A and B token whether both tokenizations are cut after it.

    Ends are byte offsets that run through all documents; the tokens of document d are those from ``bounds[d]`` to ``bounds[d + 1]``.
    """
    a_cut, b_cut = np.zeros(len(a_end), dtype=bool), np.zeros(len(b_end), dtype=bool)
    links: list[tuple[np.ndarray, np.ndarray]] = []
    i, j, stop = lanes(a_end, b_end, a_bounds, b_bounds, lane_tokens)
    while len(i):
        links.append((i, j))
        ahead = a_end[i] - b_end[j]
        a_ends, b_ends = ahead <= 0, ahead >= 0
        both = a_ends & b_ends
        a_cut[i[both]] = True
        b_cut[j[both]] = True
        i, j = i + a_ends, j + b_ends
        left = i < stop
        if not left.all():
            i, j, stop = i[left], j[left], stop[left]
    if not links:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), a_cut, b_cut
    return np.concatenate([i for i, _ in links]), np.concatenate([j for _, j in links]), a_cut, b_cut


_TENS = np.array([10, 100, 1000, 10_000, 100_000, 1_000_000])


def group_texts(a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray) -> list[bytes]:
    """Per document ``a1,a2|b1;a3|b2,b3``: ids of A and of B between cuts."""
    a_group = np.concatenate([[0], np.cumsum(a_cut)[:-1]]) if len(a) else a
    b_group = np.concatenate([[0], np.cumsum(b_cut)[:-1]]) if len(b) else b
    # an A token follows all B tokens of earlier groups, a B token all A tokens of its group and of those before
    place = np.concatenate([np.arange(len(a)) + np.searchsorted(b_group, a_group), np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")])
    ids, marks = np.empty(len(place), dtype=np.int64), np.empty(len(place), dtype=np.uint8)
    ids[place] = np.concatenate([a, b])
    marks[place] = np.concatenate([np.where(a_cut, ord("|"), ord(",")), np.where(b_cut, ord(";"), ord(","))])
    digits = 1 + np.searchsorted(_TENS, ids, side="right")
    ends = np.cumsum(digits + 1)
    out = np.empty(ends[-1] if len(ends) else 0, dtype=np.uint8)
    out[ends - 1] = marks
    for d in range(int(digits.max()) if len(digits) else 0):
        have = digits > d
        out[ends[have] - 2 - d] = ord("0") + ids[have] // 10**d % 10
    raw, ends = out.tobytes(), np.concatenate([[0], ends])
    bounds = ends[a_bounds + b_bounds]
    return [raw[x : y - 1] if y > x else b"" for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2^32 byte plane by byte plane, so the empty high bytes lie together."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _bounds(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)


def aligned_block(both: Tokenizers, docs: list[int | None], texts: list[str | None]) -> list:
    """Columns of one block after its number."""
    a_parts, b_parts = both.encode(texts)
    a_bounds, b_bounds = _bounds(a_parts), _bounds(b_parts)
    a, b = np.concatenate([*a_parts, np.empty(0, dtype=np.int64)]), np.concatenate([*b_parts, np.empty(0, dtype=np.int64)])
    i, j, a_cut, b_cut = merge(np.cumsum(both.a_length[a]), np.cumsum(both.b_length[b]), a_bounds, b_bounds)
    n_links = np.bincount(np.searchsorted(a_bounds, i, side="right") - 1, minlength=len(docs))
    shown = group_texts(a, b, a_cut, b_cut, a_bounds, b_bounds)
    found, times = np.unique((np.searchsorted(a_bounds, i, side="right") - 1 << 32) + a[i] * len(both.b_bytes) + b[j], return_counts=True)
    owner = found >> 32
    pairs, place, holders = np.unique(found & 0xFFFFFFFF, return_inverse=True, return_counts=True)
    steps = np.diff(place, prepend=0)
    fresh = np.diff(owner, prepend=-1) != 0
    steps[fresh] = place[fresh]
    hashes = [hashlib.sha256(text).hexdigest() if text else "" for text in shown]
    per_doc = [np.diff(a_bounds), np.diff(b_bounds), _per_document(a_cut, a_bounds), n_links]
    sizes = np.bincount(owner, minlength=len(docs))
    return [docs, *[c.tolist() for c in per_doc], hashes, sizes.tolist(), _planes(steps), _planes(times), _planes(pairs), _planes(holders)]


def _align(vocabulary: str | None, pieces: str | None, block_bytes: int):
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "binary": pa.binary()}
    fields = [field.split() for field in _BLOCK.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(vocabulary, pieces)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            _, bounds = string_buffers(texts)
            for first, last in slices(bounds, block_bytes):
                row = [number, *aligned_block(both, ids[first:last].to_pylist(), texts[first:last].to_pylist())]
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([v], kinds[kind]) for v, (_, kind) in zip(row, fields, strict=True)], names=[name for name, _ in fields])

    return scan


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, holders in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            pairs, holders = _numbers(pairs), _numbers(holders)
            for at in range(0, len(pairs), 50_000):
                part = slice(at, at + 50_000)
                columns = [pa.array(np.full(len(pairs[part]), block)), pa.array(pairs[part].astype(np.int32)), pa.array(holders[part].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "pair", "holders"])


def _summed(blocks: pa.Table, looked_up: pa.Table) -> pa.Table:
    """The documents of one block, with sums over their links."""
    (row,) = blocks.to_pylist()
    order = np.argsort(looked_up.column("pair").to_numpy())
    count, best = (looked_up.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "best"))
    bounds = np.concatenate([[0], np.cumsum(row["sizes"], dtype=np.int64)])
    steps, times = _numbers(row["steps"]), _numbers(row["times"])
    walked = np.concatenate([[0], np.cumsum(steps)])
    place = walked[1:] - np.repeat(walked[bounds[:-1]], np.diff(bounds))
    n_best, count_sum = _per_document(best[place] * times, bounds), _per_document(count[place] * times, bounds)
    columns = [row["doc_id"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"], n_best.tolist(), count_sum.tolist(), row["groups_sha256"]]
    return pa.table([pa.array(c, pa.string() if f.endswith("string") else pa.int64()) for c, f in zip(columns, RESULT.split(", "), strict=True)], names=[f.split()[0] for f in RESULT.split(", ")])


def align(docs: DataFrame, vocabulary: str | None = None, pieces: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document with its tokens, groups and links, and how its links fare in the whole corpus.

    Every row of ``docs`` is a document of its own, also where ids repeat or are null. A text that is null, empty or not given back by a tokenizer
    byte by byte has no tokens: zeros and an empty hash. ``n_best`` counts links whose pair is in as many documents as the most frequent pair of
    its A id, ``count_sum`` adds the documents of the pairs of all links. No rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = stored(rows.mapInArrow(_align(vocabulary, pieces, block_bytes), _BLOCK), "aligned")
    flat = blocks.select("block", "pairs", "holders").mapInArrow(_flat, "block long, pair int, holders int")
    a_id = F.floor(F.col("pair") / F.lit(tokenizers(vocabulary, pieces).b.get_piece_size()))
    counts = flat.groupBy("pair").agg(F.sum("holders").alias("count"))
    most = F.max("count").over(Window.partitionBy("a"))  # at most one row for each B id
    counts = stored(counts.withColumn("a", a_id).select("pair", "count", (F.col("count") == most).cast("int").alias("best")), "pair-counts")
    looked_up = flat.select("block", "pair").join(counts, "pair").select("block", "pair", "count", "best")
    return blocks.groupBy("block").cogroup(looked_up.groupBy("block")).applyInArrow(_summed, RESULT)
