"""Operators with an exact result: brute force, round trips, and SQL over the test tables."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from starloom.llm import components, encoding, jaccard, packing, preferences, substrings, vectors, words
from starloom.llm.queries import QUERIES, SQL

from .conftest import against_sql

DATA = "/root/testdata/sf0.001"
_tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_over_test_tables(spark, name):
    assert against_sql(spark, name, DATA)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab\x0b\x0c\r\x1c\x85é漢"), max_size=6))
def test_words_are_those_of_split(texts):
    import pyarrow as pa

    column = pa.array([*texts, None], pa.string())
    data, bounds = words.string_buffers(column)
    found = words.find_words(data, bounds)
    for i, text in enumerate([*texts, ""]):
        own = [found.data[a:b].tobytes() for a, b in zip(found.starts[found.text_ptr[i] : found.text_ptr[i + 1]], found.ends[found.text_ptr[i] : found.text_ptr[i + 1]], strict=True)]
        assert own == text.encode().split()


def test_window_hashes_depend_on_content_alone():
    values = words.mix(np.arange(100, dtype=np.uint64) % np.uint64(10))
    found = words.windows_hash(values, 7)
    assert len(set(found.tolist())) == 10 and (found[:-10] == found[10:]).all()
    assert len(words.windows_hash(values[:3], 7)) == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\r\x0b\x85\x1c ab'sé漢1!🙂<|endoftext|>", max_size=20))
def test_encoder_equals_tokenizer(text):
    assert encoding.encoder().encode(text).tolist() == _tokenizer.encode(text, add_special_tokens=False).ids


def test_best_fit_equals_brute_force():
    rng = random.Random(5)
    for _ in range(50):
        lengths = sorted((rng.randint(1, 64) for _ in range(100)), reverse=True)
        where, offsets = packing.best_fit(lengths, 64)
        room: list[int] = []
        for length, _, offset in zip(lengths, where, offsets, strict=True):
            fits = [r for r in room if r >= length]
            best = min(fits) if fits else 64
            assert offset == 64 - best
            if fits:
                room.remove(best)
            room.append(best - length)


def test_packing_round_trip(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = packing.pack(docs, group_pieces=5).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc in docs.collect():
        ids = [*_tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[doc.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_packing_gives_special_tokens_their_ids(spark):
    (row,) = packing.pack(spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")).collect()
    assert (row.doc_tokens, row.ids_crc32) == (5, zlib.crc32(np.array([64, 220, 50256, 275, 0], dtype="<u4").tobytes()))


def test_packing_leaves_little_room(spark):
    rows = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert sum(1024 - r[1] for r in rows) < 0.01 * 1024 * len(rows)


def test_packing_keeps_null_and_large_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (2**60 + 1, "b"), (2**60 + 1, "b")], "doc_id long, text string")
    assert sorted((r.doc_id or 0) for r in packing.pack(docs).collect()) == [0, 2**60 + 1, 2**60 + 1]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (300, None), (301, 300)]
    links = spark.createDataFrame(links, "a long, b long").repartition(7)
    found = {r.node: r.component for r in components.components(links).collect()}
    assert all(found[i] == 1 for i in range(1, 61)) and all(found[100 + i] == 100 for i in range(50))
    assert found[200] == 200 and found[301] == 300 and len(found) == 60 + 50 + 1 + 2


def brute_components(sets: list[set], percent: int) -> list[int]:
    top = list(range(len(sets)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def test_jaccard_equals_brute_force_around_the_threshold(spark):
    """Groups of copies with more and fewer edits: some outside the component of most others."""
    rng = random.Random(9)
    texts = []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(rng.choice([25, 60, 90]))]
        for _ in range(35):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    texts += ["one common line of many short documents here"] * 3 + [f"one common line of many short documents here {i}" for i in range(20)]
    sets = []
    for text in texts:
        w = text.split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_components(sets, 80)


def test_jaccard_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_LABELS", 2)
    monkeypatch.setattr(jaccard, "_NODES", 8)
    test_jaccard_equals_brute_force_around_the_threshold(spark)


def test_many_components_of_one_token_give_no_pairs(spark, monkeypatch):
    rows, kept = {}, jaccard.stored

    def spy(df, label, outlives=0):
        out = kept(df, label, outlives)
        rows[label] = out.count() + rows.get(label, 0) if label in ("label-pairs", "wide-nodes") else 0
        return out

    monkeypatch.setattr(jaccard, "stored", spy)
    texts = [f"one common line of many short documents here {i}" for i in range(600)]
    found = jaccard.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r.doc_id == r.component_id for r in found) and len(found) == 600
    assert rows["label-pairs"] <= 600 and rows["wide-nodes"] > 0


def test_short_texts_of_one_common_line_are_kept_apart_by_the_filters(spark, monkeypatch):
    """Every pair shares four shingles of five; hardly any pair is compared, and the links there are get found."""
    compared, kept = [], jaccard.stored

    def spy(df, label, outlives=0):
        out = kept(df, label, outlives)
        if label == "wide-cells":
            sides = out.groupBy("key", "i", "j").pivot("query", [False, True]).count().na.fill(0).collect()
            compared.append(sum(r["false"] * r["true"] for r in sides))
        return out

    monkeypatch.setattr(jaccard, "stored", spy)
    count = 20_000
    texts = [f"one common line of many short documents here {i}" for i in range(count)]
    texts += [f"{texts[i]} more" for i in range(0, count, 1000)]  # five shingles of six
    found = jaccard.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i if i < count else 1000 * (i - count) for i in range(len(texts))}
    assert len(compared) == 1 and compared[0] < count * (count - 1) / 2 / 100


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_wide_tokens_at_other_thresholds(spark, monkeypatch, percent):
    monkeypatch.setattr(jaccard, "_LABELS", 1)
    monkeypatch.setattr(jaccard, "_NODES", 4)
    monkeypatch.setattr(jaccard, "_PART", 3)
    rng = random.Random(percent)
    texts = []
    for _ in range(90):
        words = [f"w{i}" for i in range(rng.choice([6, 12, 13, 40]))]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(6)}"
        texts.append(" ".join(words))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs, percent).collect()}
    assert [found[i] for i in range(len(texts))] == brute_components(sets, percent)


def test_distinct_documents_with_null_and_repeated_ids(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(20)) for c in "abc")
    rows = [(None, one), (4, two), (4, two), (7, two), (None, two), (5, three), (5, one + " more"), (None, None), (None, None)]
    kept = jaccard.distinct_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(5, one + " more"), (4, two), (5, three), (None, None), (None, None)]))
    lone = jaccard.distinct_documents(spark.createDataFrame([(None, one), (3, two)], "doc_id long, text string")).collect()
    assert {r.doc_id for r in lone} == {None, 3}


def test_substring_report_equals_brute_force(spark):
    rng = random.Random(4)
    passages = [[f"p{k}w{i}" for i in range(rng.choice([49, 50, 51, 90]))] for k in range(6)]
    docs = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += rng.choice(passages) if rng.random() < 0.6 else [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 30))]
        docs.append((i, " ".join(text)))
    first = {}
    for i, text in docs:
        w = text.split()
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    found = {r.doc_id: r for r in substrings.removal_report(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    for i, text in docs:
        w = text.split()
        gone = {p for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for p in range(k, k + 50)}
        assert (found[i].n_words, found[i].n_removed) == (len(w), len(gone))


def test_vectors_recall_and_precision(spark):
    """Links at cosines just above and below the threshold, copies, and vectors that cannot link."""
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(150):
        base = rng.normal(size=48)
        base /= np.linalg.norm(base)
        side = rng.normal(size=48)
        side -= base * (side @ base)
        side /= np.linalg.norm(side)
        rows += [base.tolist(), *[(3.0 * (c * base + np.sqrt(1 - c * c) * side)).tolist() for c in (0.951, 0.949)]]
    rows += [rows[0]] * 5 + [None, [], [0.0] * 48, [float("nan")] * 48, [None] + [1.0] * 47, [float("inf")] * 48, [1.0, 2.0], [1.0, 2.0]]
    data = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "vec_id long, embedding array<double>").repartition(4)
    found = {r.vec_id: r for r in vectors.near_vectors(data).collect()}
    usable = [i for i, r in enumerate(rows) if r and all(x is not None and np.isfinite(x) for x in r) and any(r)]
    true = {i: set() for i in range(len(rows))}
    for i in usable:
        for j in usable:
            if i != j and len(rows[i]) == len(rows[j]) and np.dot(rows[i], rows[j]) / np.linalg.norm(rows[i]) / np.linalg.norm(rows[j]) >= 0.95:
                true[i].add(j)
    assert all(found[i].n_links <= len(true[i]) for i in true)
    links = sum(found[i].n_links for i in true)
    assert links >= 0.97 * sum(map(len, true.values()))
    assert found[450].component_id == 0 and not found[450].kept and found[455].kept and found[455].n_links == 0


def test_preferences_by_hand(spark):
    turns = "array<struct<turn:long,role:string,text:string>>"
    a = [(0, "user", "hi"), (1, "assistant", "yes")]
    b = [(0, "user", "hi"), (1, "assistant", "no"), (2, "user", "why")]
    rows = preferences.format_preferences(spark.createDataFrame([(1, a, b), (2, a, a), (3, [], None)], f"pair_id long, chosen {turns}, rejected {turns}"))
    found = {r.pair_id: r for r in rows.collect()}
    assert found[1].prompt == "<|user|>\nhi\n<|end|>\n" and found[1].prefix_turns == 1
    assert found[1].chosen == "<|assistant|>\nyes\n<|end|>\n"
    assert [(s.start, s.length) for s in found[1].rejected_loss] == [(14, 11)]
    assert found[1].rejected[14:25] == "no\n<|end|>\n"
    assert found[2].prefix_turns == 2 and found[2].chosen == found[2].rejected == "" and found[2].chosen_loss == []
    assert found[3].prompt == found[3].chosen == "" and found[3].prefix_turns == 0


def test_conversation_edges(spark, tmp_path):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (2, 1, "assistant", "b"), (2, 1, "assistant", "a"), (3, 0, "user", "alone"), (None, 0, "user", "x"), (4, None, "assistant", "y"), (5, 0, None, "z"), (5, 1, "assistant", "")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert {r[2] for r in against_sql(spark, "op1_preference_formatting", str(tmp_path))} == {1, 2, 3, 4, 5, None}


def test_pairs_part_at_all_replies(spark):
    """Every conversation of the table gives a pair; it keeps its turns, and pairs part at different replies."""
    folder = "/root/testdata/sf0.01"
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    pairs = preferences.swapped_pairs(turns).collect()
    assert len(pairs) == turns.select("conv_id").distinct().count()
    assert sum(len(r.chosen) for r in pairs) == sum(len(r.rejected) for r in pairs) == turns.count()
    for r in pairs:
        replies = [i for i, t in enumerate(r.chosen) if t.role == "assistant"]
        changed = [i for i, (a, b) in enumerate(zip(r.chosen, r.rejected, strict=True)) if a.text != b.text]
        assert set(changed) <= set(replies)
    rows = {r.pair_id: r.prefix_turns for r in QUERIES["op1_preference_formatting"](spark, folder).collect()}
    assert len(set(rows.values())) > 3 and any(0 < p < len(r.chosen) - 2 for r in pairs for p in [rows[r.pair_id]])


def test_mixing_targets_and_copies(spark):
    rows = QUERIES["op8_mixing"](spark, "/root/testdata/sf0.01").collect()
    by_source = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by_source.setdefault((r.source_size, r.target), []).append(r)
    assert sum(t for _, t in by_source) == pytest.approx(sum(s for s, _ in by_source))
    for (_, target), own in by_source.items():
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own) / 2


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = docs
    ids = {name: [r.doc_id for r in df.collect()] for name, df in seen.items()}
    assert {6, 7, 8}.isdisjoint(ids["language ID"])
    assert 2 not in ids["n-gram Jaccard join"] and 3 not in ids["n-gram Jaccard join"] and {1, 4, 5} <= set(ids["n-gram Jaccard join"])
    cut = {r.doc_id: r for r in seen["substring dedup"].collect()}
    assert len(cut[4].text.split()) == 230 and cut[4].n_chars == len(cut[4].text)
    assert set(ids["packing"]) == set(ids["mixing"]) <= set(ids["substring dedup"])


def test_pipeline_runs_on_test_tables(spark):
    assert corpus_pipeline.run(spark, DATA).groupBy("sequence_id").count().count() > 0
