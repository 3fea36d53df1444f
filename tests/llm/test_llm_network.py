"""The window network against plain formulas, and the number of passes over a batch."""

from __future__ import annotations

import numpy as np

from starloom.llm import pseudolm as lm


def weights(seed: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    network = lm.Network(np.empty(0, np.uint64), np.empty(0, np.int64), np.random.default_rng(seed).normal(0, 0.3, lm._SIZE).astype(np.float32), np.zeros(lm.CLASSES))
    return network.flat, network.part()


def plain(parts: dict[str, np.ndarray], around: np.ndarray, target: int) -> float:
    hidden = np.tanh(sum(parts["places"][p][t].astype(float) for p, t in enumerate(around)) + parts["bias"])
    first = hidden @ parts["classes"] + parts["class_bias"]
    second = hidden @ parts["words"][target // lm.CLASSES] + parts["word_bias"][target // lm.CLASSES]
    return first[target // lm.CLASSES] - np.logaddexp.reduce(first) + second[target % lm.CLASSES] - np.logaddexp.reduce(second)


def test_probabilities_in_two_passes(monkeypatch):
    """A batch takes one exponential for its classes and one for its words, not one for each class."""
    rng = np.random.default_rng(1)
    around, targets = rng.integers(0, lm._PAD + 1, (500, 4)), rng.integers(0, lm._PAD, 500)
    parts, calls, exp = weights(2)[1], [], np.exp
    monkeypatch.setattr(lm.np, "exp", lambda *args, **more: calls.append(1) or exp(*args, **more))
    found = lm.log_probabilities(parts, around, targets)
    assert len(calls) == 2
    assert np.allclose(found, [plain(parts, a, t) for a, t in zip(around, targets.tolist(), strict=True)], atol=1e-4)


def test_step_follows_the_slope():
    """The change of a weight from fresh squares tells its slope; it is that of the plain formula."""
    rng = np.random.default_rng(3)
    around, targets = rng.integers(0, 50, (64, 4)), rng.integers(0, lm._PAD, 64)
    flat, parts = weights(4)
    before = {name: part.copy() for name, part in parts.items()}
    squares = {name: np.ones_like(part) for name, part in parts.items()}
    lm._step(parts, squares, around, targets)
    loss = lambda: -sum(plain(before, a, t) for a, t in zip(around, targets.tolist(), strict=True))
    c = int(targets[0]) // lm.CLASSES
    for name, at in (("classes", (3, 5)), ("class_bias", (c,)), ("words", (c, 7, int(targets[0]) % lm.CLASSES)), ("word_bias", (c, 9)), ("bias", (2,)), ("places", (1, int(around[0, 1]), 6))):
        moved, own = (before[name][at] - parts[name][at]) / lm._RATE, float(before[name][at])
        slope = moved / np.sqrt(1 - moved * moved)
        ends = []
        for shift in (1e-2, -1e-2):
            before[name][at] = own + shift
            ends.append(loss())
        before[name][at] = own
        assert np.isclose(slope, (ends[0] - ends[1]) / 2e-2, rtol=2e-2, atol=2e-3), name


def test_contexts_end_with_the_text():
    tokens, ptr = np.array([5, 6, 7, 8, 9]), np.array([0, 2, 2, 5])
    pad = lm._PAD
    found = lm.contexts(*lm.padded(tokens, ptr)).tolist()
    assert found == [[pad, pad, 6, pad], [pad, 5, pad, pad], [pad, pad, 8, 9], [pad, 7, 9, pad], [7, 8, pad, pad]]
