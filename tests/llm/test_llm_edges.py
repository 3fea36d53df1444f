"""Every operator on nulls, empty and long texts, ties, repeats, clashing columns, and on empty tables."""

from __future__ import annotations

import pytest

from starloom.llm.queries import QUERIES

from .conftest import against_sql


@pytest.mark.parametrize("name", ["op2_quality_rules", "op7_ngram_jaccard_join", "op8_mixing", "op9_substring_dedup"])
def test_edges_against_sql(spark, folder, name):
    assert len(against_sql(spark, name, folder)) == 16


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_near_duplicates_by_hand(spark, folder):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op7_ngram_jaccard_join"](spark, folder).collect()}
    assert found[2] == (116, 1) and found[3] == (116, 1)
    assert found[6] == (0, 6) and found[8] == (0, 8)
    assert found[10] == (1, 9), "three words are one shingle, whatever their case"
    assert found[4][1] == 4
    assert found[15][1] == found[16][1] == 5


def test_removal_by_hand(spark, folder):
    found = {r.doc_id: (r.n_words, r.n_removed) for r in QUERIES["op9_substring_dedup"](spark, folder).collect()}
    assert found[1] == (120, 0) and found[2] == (120, 120)
    assert found[3] == (120, 119), "the changed word stays, as no window with it repeats"
    assert found[4] == (350, 120)
    assert found[11][1] == 0, "a repeat inside one document stays"
