"""Hashes of words and word windows, computed on whole Arrow buffers inside a task.

Words are runs of bytes outside ``\\x20 \\x09-\\x0D``; in UTF-8 that equals the character class
``[^\\x20\\x09-\\x0D]+``. All hashes are polynomials over 64-bit values modulo 2^64 (Rabin-Karp),
read off prefix sums and mixed at the end. Work arrays follow the slice of text at hand, not the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at once; a single longer text is a slice of its own. Fewer where each word costs much memory.
SLICE_BYTES = 1 << 20
SMALL_SLICE_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = IDENTITY.copy()
LOWER[ord("A") : ord("Z") + 1] += 32

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BYTE_BASE))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, extended on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(12, (n - 1).bit_length())
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def _prefix(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers, out=out[1:])
    return out


def ranges_hash(byte_values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range ``[start, end)`` of an array of bytes."""
    up, down = _BYTES.upto(len(byte_values) + 1)
    prefix = _prefix(_BYTE_VALUE[byte_values], up[:-1])
    raw = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def windows_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` values; entry i starts at value i."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    up, down = _WORDS.upto(len(hashes) + 1)
    prefix = _prefix(hashes, up[:-1])
    return mix((prefix[width:] - prefix[:-width]) * down[:n])


@dataclass
class Words:
    """Words of some texts: hash, byte range in ``data``, and per text the range of its words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text_ptr: np.ndarray
    data: np.ndarray


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; a null is an empty text."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    bounds = np.frombuffer(offsets, dtype=width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw, bounds


def find_words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray = IDENTITY) -> Words:
    """Words of the texts ``data[bounds[i]:bounds[i + 1]]`` after mapping bytes by ``table``."""
    data = table[data[bounds[0] : bounds[-1]]]
    bounds = bounds - bounds[0]
    inside = ~_SPACE[data]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[heads] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[heads[heads > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(ranges_hash(data, starts, ends), starts, ends, np.searchsorted(starts, bounds), data)


def slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; every text is in one range."""
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1)
        yield first, last
        first = last


def word_slices(texts: pa.Array, table: np.ndarray = IDENTITY) -> Iterator[tuple[int, int, Words]]:
    """``(first, last, words)`` for slices of a string array."""
    data, bounds = string_buffers(texts)
    for first, last in slices(bounds):
        yield first, last, find_words(data, bounds[first : last + 1], table)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its task, and keeps what its allocators hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def lean(scan: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A scan of batches that gives memory back where it ends."""

    @wraps(scan)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from scan(batches)
        finally:
            give_back()

    return run
