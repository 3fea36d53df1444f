"""Learned operators: held-out accuracy, exact inference, monotone calibration."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from starloom.llm import langid, pseudolm, toxicity
from starloom.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def chain(k: int = 3, seed: int = 0) -> langid.Chain:
    return langid.Chain([f"l{i}" for i in range(k)], np.zeros((1, k)), np.random.default_rng(seed).normal(0, 1, (k, k)), {})


@pytest.mark.parametrize("sizes", [[1], [5], [2, 1, 4]])
def test_marginals_equal_enumeration(sizes):
    field = chain()
    scores = np.random.default_rng(1).normal(0, 2, (sum(sizes), 3))
    found, start = langid.marginals(field, scores, np.array(sizes)), 0
    for size in sizes:
        own, total = scores[start : start + size], np.zeros((size, 3))
        for labels in itertools.product(range(3), repeat=size):
            first = np.exp(field.steps[:, labels[0]]).sum()
            weight = first * np.exp(own[range(size), labels].sum() + sum(field.steps[a, b] for a, b in zip(labels, labels[1:], strict=False)))
            for t, label in enumerate(labels):
                total[t, label] += weight
        assert np.allclose(found[start : start + size], total / total.sum(axis=1, keepdims=True), atol=1e-9)
        start += size


def test_blocks_do_not_change_marginals(monkeypatch):
    scores = np.random.default_rng(2).normal(0, 1, (200, 3))
    whole = langid.marginals(chain(), scores, np.array([150, 50]))
    monkeypatch.setattr(langid, "_BLOCK", 7)
    assert np.allclose(whole, langid.marginals(chain(), scores, np.array([150, 50])))


def test_code_switched_words_are_labelled():
    one, two = [f"ka{i}lo" for i in range(40)], [f"re{i}mi" for i in range(40)]
    field = langid.fit([("one", one), ("two", two)] * 5, steps=30)
    text = one[:10] + two[:10]
    labels = langid.marginals(field, field.emissions(text)[0], np.array([20])).argmax(axis=1)
    assert labels.tolist() == [0] * 10 + [1] * 10


def test_language_accuracy_held_out(spark):
    found = QUERIES["op4_language_id"](spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 1000 and len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_edges(spark, folder):
    found = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, folder).collect()}
    assert len(found) == 16
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (6, 7, 8))
    assert found[9].lang_pred != "und"


def test_accepted_keeps_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = langid.accepted(docs)
    assert kept.schema == docs.schema
    assert {6, 7, 8}.isdisjoint({r.doc_id for r in kept.collect()})


def test_trees_split_and_calibrate():
    rng = np.random.default_rng(3)
    rows = rng.random((2000, 3))
    labels = ((rows[:, 0] > 0.6) & (rows[:, 1] < 0.5)).astype(float)
    trees = toxicity.boost(rows, labels)
    margin = trees.margin(rows)
    assert ((margin > 0) == labels).mean() > 0.99
    trees.raw, trees.calibrated = toxicity.isotonic(margin, labels, np.ones(len(labels)))
    order = np.argsort(margin)
    assert (np.diff(trees.score(rows)[order]) >= -1e-12).all()


def test_one_class_scores_its_share():
    trees = toxicity.boost(np.ones((10, 2)), np.zeros(10))
    assert np.allclose(trees.score(np.ones((3, 2))), 1e-4)


def test_isotonic_pools():
    centres, values = toxicity.isotonic(np.array([1.0, 2.0, 3.0]), np.array([1.0, 0.0, 1.0]), np.ones(3))
    assert values.tolist() == [0.5, 1.0] and centres.tolist() == [1.5, 3.0]


def test_look_alikes_are_undone():
    def row(text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        return toxicity.features(raw, np.array([0, len(raw)]), toxicity.Lexicons(np.empty(0, np.uint64), np.empty(0, np.uint64)))[0]

    assert row("you id1ot!")[6] == 1 and row("you idiot!")[0] == 1
    assert row("you idiot!")[10] == 1 and row("idiot and then one two three four five six you")[10] == 0
    assert not row("")[:-1].any()


def test_toxicity_held_out(spark):
    found = QUERIES["op10_toxicity"](spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) > 0.9 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_toxicity_with_edges(spark, folder):
    labels = spark.createDataFrame([(1, 1), (2, None), (5, 0), (99, 1)], "doc_id long, toxic int")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert toxicity.score(docs, toxicity.train(docs, labels)).where("score between 0 and 1").count() == 16


def test_language_model_learns_and_normalizes(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")

    def loss(network) -> float:
        rows = pseudolm.score(docs, network).collect()
        assert len(rows) == 1000
        return -sum(r.log_probability for r in rows) / sum(r.n_words for r in rows)

    start, fitted = pseudolm.train(docs, rounds=0), pseudolm.train(docs, rounds=3)
    assert loss(fitted) < loss(start) - 0.3
    around = np.array([[1, 2, 3, 4]])
    total = sum(np.exp(pseudolm.log_probabilities(fitted.part(), np.repeat(around, 4096, axis=0), np.arange(4096))))
    assert abs(total - 1) < 1e-3


def test_language_model_edges(spark, folder):
    found = {r.doc_id: r for r in QUERIES["op6_lm_scoring"](spark, folder).collect()}
    assert len(found) == 16
    assert all(found[i].n_words == 0 and found[i].log_probability == 0 and found[i].mean_log_probability is None for i in (6, 7, 8))
    assert found[1].log_probability == pytest.approx(found[2].log_probability)


def test_every_position_is_a_training_target(spark, folder, monkeypatch):
    docs, taken, merged = spark.read.parquet(f"{folder}/documents.parquet"), [], pseudolm.merged_cells

    def spy(*args):
        taken.append(merged(*args))
        return taken[-1]

    monkeypatch.setattr(pseudolm, "merged_cells", spy)
    n_words = sum(r.n_words for r in pseudolm.score(docs, pseudolm.train(docs)).collect())
    assert sum(float(cells[pseudolm._SIZE]) for cells in taken) == n_words


def test_rare_words_have_their_own_probability(spark):
    common = " ".join(f"c{i}" for i in range(pseudolm.KNOWN))
    texts = [" ".join([common] * 5), "rareab rareab", "otherab", "otherab", None]
    docs = spark.createDataFrame([(None if t == "otherab" else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    network = pseudolm.train(docs, rounds=0)
    assert len(pseudolm.score(docs, network).collect()) == 5
    asked = ["rareab", "otherab", "lackingab", "c1"]
    texts_asked = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")

    def found(network) -> dict[str, float]:
        return {asked[r.doc_id]: r.log_probability for r in pseudolm.score(texts_asked, network).collect()}

    one = found(network)
    assert one["rareab"] == pytest.approx(one["otherab"]) and one["otherab"] == pytest.approx(one["lackingab"] + np.log(4))
    more = docs.unionByName(spark.createDataFrame([(9, "rareab rareab")], docs.schema))
    two = found(pseudolm.train(more, rounds=0))
    assert two["rareab"] == pytest.approx(two["otherab"] + np.log(2))


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    """The same documents in one and in eight partitions, over several shards."""
    monkeypatch.setattr(pseudolm, "SHARD_WORDS", 5000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found = []
    for parts in (1, 8):
        dealt = docs.repartition(parts, "text")
        found.append({r.doc_id: r.mean_log_probability for r in pseudolm.score(dealt, pseudolm.train(dealt)).collect()})
    assert found[0].keys() == found[1].keys()
    assert all(abs(found[0][k] - found[1][k]) < 1e-4 for k in found[0] if found[0][k] is not None)


def test_vocabulary_lookup_finds_each_word_and_no_other():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    crowded = (np.uint64(7) << np.uint64(60)) + np.arange(32, dtype=np.uint64)  # many in one slot
    known = np.sort(np.concatenate([hashes, crowded]))
    network = pseudolm.Network(known, np.arange(len(known)), np.zeros(1, dtype=np.float32), np.zeros(pseudolm.CLASSES))
    asked = np.concatenate([known, known + np.uint64(1), rng.integers(0, 2**64, 1000, dtype=np.uint64), [np.uint64(0), np.uint64(2**64 - 1)]])
    data = np.frombuffer(b"ab" * len(asked), dtype=np.uint8)
    ends = np.arange(2, 2 * len(asked) + 1, 2)
    tokens = network.tokens(pseudolm.Words(asked, ends - 2, ends, np.array([0, len(asked)]), data))
    place = {int(h): i for i, h in enumerate(known)}
    cell = tokens[-1]
    assert tokens.tolist() == [place.get(int(h), cell) for h in asked] and cell >= pseudolm.KNOWN
