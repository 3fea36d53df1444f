"""Null and repeated ids, null texts, ties and numerals, by brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import langid, substrings, toxicity
from starloom.llm.queries import QUERIES

from .conftest import against_sql, words


def removed_by_hand(docs: list[tuple], width: int) -> list[tuple]:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    first: dict[tuple, int] = {}
    split = [(i, (t or "").split()) for i, t in docs]
    for doc_id, own in split:
        for k in range(len(own) - width + 1):
            if doc_id is not None:
                window = tuple(own[k : k + width])
                first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for doc_id, own in split:
        gone = {k + d for k in range(len(own) - width + 1) if doc_id is not None and first[tuple(own[k : k + width])] < doc_id for d in range(width)}
        kept = [w for k, w in enumerate(own) if k not in gone]
        out.append((doc_id, len(own), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


A, B, C = words(1, 60), words(2, 60), words(3, 80)
REPEATED = [(1, A), (2, A), (2, B), (2, None), (2, f"{C} {A}"), (3, f"{B} {C} {A}"), (3, B), (3, B), (None, A), (None, None), (4, ""), (0, words(4, 70)), (5, f"{A} x {A}"), (-1, C)]


@pytest.mark.parametrize("width", [50, 6])
def test_rows_of_one_id_lose_by_their_own_text(spark, width):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in REPEATED], "doc_id long, text string, row long, first string").repartition(3)
    found = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.removal_report(docs, width).collect()]
    assert sorted(found, key=repr) == removed_by_hand(REPEATED, width)
    left = [(r.doc_id, r.text, r.row, r.first) for r in substrings.deduplicate(docs, width).select("doc_id", "text", "row", "first").collect()]
    assert len(left) == len(REPEATED) and sum(t is None for _, t, _, _ in left) == 2
    assert {r[2:] for r in left} == {(1, "x")}
    hashes = sorted(hashlib.sha256(" ".join((t or "").split()).encode()).hexdigest() for _, t, _, _ in left)
    assert hashes == sorted(h for *_, h in removed_by_hand(REPEATED, width))


def test_tied_margins_are_one_point():
    for labels in ([0, 1, 0, 1], [1, 0, 1, 0], [1, 1, 0, 0]):
        centres, values = toxicity.isotonic(np.full(4, 2.0), np.array(labels, dtype=float), np.ones(4))
        assert centres.tolist() == [2.0] and values.tolist() == [0.5]
    centres, values = toxicity.isotonic(np.array([1.0, 2.0, 1.0, 2.0, 3.0]), np.array([0.0, 1.0, 1.0, 0.0, 1.0]), np.array([3.0, 1.0, 1.0, 1.0, 1.0]))
    assert centres.tolist() == [1.0, 2.0, 3.0] and values.tolist() == [0.25, 0.5, 1.0]


def test_texts_without_letters_are_undetermined(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = ["²", "½ ①", "१२३ 42", "́ ั", "_ -", "", None, "Ⅷ", "ª"]
    rows = spark.createDataFrame([(-1 - (i % 3), t, None, None) for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string")
    found = langid.predict(rows.withColumn("n_chars", F.lit(1)), langid.train(docs)).select("lang_pred", "score").collect()
    assert len(found) == len(odd)
    assert sum(r.lang_pred == "und" for r in found) == len(odd) - 1, "the ordinal sign is a letter, the numerals and marks are none"
    assert all(0 <= r.score <= 1 for r in found)


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """Tables with null and repeated ids, null texts and equal rows."""
    path = tmp_path_factory.mktemp("repeated")
    rows = [(i, t, lang, source, 1) for k, (i, t) in enumerate(REPEATED) for lang, source in [(("en", None, "de")[k % 3], ("a", "b", None)[k % 3])]]
    rows += [(None, None, None, None, None)] * 2
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, i % 2) for i in (0, 1, 2, 2, 3, 4, 5)] + [(None, 1, 1), (2, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), [r[0] for r in rows]


def test_quality_of_repeated_ids_against_sql(spark, repeated):
    assert len(against_sql(spark, "op2_quality_rules", repeated[0])) == len(repeated[1])


@pytest.mark.parametrize("name", ["op4_language_id", "op6_lm_scoring", "op7_ngram_jaccard_join", "op8_mixing", "op9_substring_dedup", "op10_toxicity", "op11_token_alignment", "op13_token_records"])
def test_every_row_gives_a_row(spark, repeated, name):
    folder, ids = repeated
    rows = QUERIES[name](spark, folder).collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted(ids, key=repr)
    for column in set(rows[0].__fields__) & {"score", "n_words", "size", "taken", "n_shingles", "start", "n_a"}:
        assert all(r[column] is not None and r[column] >= 0 for r in rows), column
