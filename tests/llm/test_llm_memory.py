"""What a Python worker holds at a time, and what it keeps after a task."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import jaccard, langid
from starloom.llm.words import lean

TEXTS = pa.array([" ".join(f"w{(7 * i + j) % 3000}" for j in range(400)) for i in range(1500)], pa.string())


def peak(run) -> float:
    """MB held at most while ``run`` works."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_shingles_hold_a_small_slice():
    assert len(TEXTS) == sum(1 for _ in jaccard.shingle_sets(TEXTS))
    assert peak(lambda: [None for _ in jaccard.shingle_sets(TEXTS)]) < 15


def test_labels_hold_a_small_slice():
    class Shared:
        value = langid.fit([("one", ["w1", "w2", "w3"]), ("two", ["w4", "w5", "w6"])] * 5, steps=2)

    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(TEXTS))), TEXTS], names=["doc_id", "text"])
    found = []
    assert peak(lambda: found.extend(langid._label(Shared)([batch]))) < 20
    assert sum(map(len, found)) == len(TEXTS)


def test_scans_return_memory(monkeypatch):
    calls = []
    monkeypatch.setattr("starloom.llm.words.give_back", lambda: calls.append(1))
    scan = lean(lambda batches: (b for b in batches))
    assert list(scan(iter([1, 2]))) == [1, 2] and calls == [1]

    def fails(batches):
        yield from batches
        raise ValueError

    with pytest.raises(ValueError):
        list(lean(fails)(iter([1])))
    assert calls == [1, 1]
