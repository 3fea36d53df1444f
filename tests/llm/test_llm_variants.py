"""Spelling variants: the query against SQL and a plain loop, signatures against their definition, wide signatures, edges."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from starloom.llm import variants

from .conftest import against_sql


def is_near(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(docs: list[tuple]) -> list[tuple]:
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in variants.UPPER else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    n = {w: c for w, c in counts.items() if c >= 2}
    near = {w: [v for v in n if v != w and is_near(v, w)] for w in n}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top and n[top] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def found(df) -> list[tuple]:
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def made_up(seed: int, long: int) -> list[tuple]:
    """Documents of few stems with edits of one and two letters, also in letters beyond ASCII, in skewed numbers."""
    rng = random.Random(seed)
    stems = ["translation", "bibliothèque", "mississippi", "ÉCONOMIE", "größenwahn", "abcdefgh", "aaaaaaaa"]
    words = []
    for stem in stems:
        words += [stem] * 120
        for _ in range(25):
            w = stem
            for _ in range(rng.choice([1, 1, 2])):
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeiéxÿ") + w[i:], w[:i] + rng.choice("aeiéxÀ") + w[i + 1 :]])
            words += [w] * rng.choice([2, 2, 3, 11, 25])
    words += ["translation"] * 300 + ["translatiom"] * 25 + ["transqatiom"] * 2
    rng.shuffle(words)
    docs = [(i, " ".join(words[i * 50 : i * 50 + 50])) for i in range(len(words) // 50 + 1)]
    return [*docs, (None, "translation, Translation. translatio"), (7, "translation×÷translation"), (8, None), (9, ""), (9, "x" * long + " " + "x" * long)]


@pytest.mark.parametrize("wide", [variants.WIDE, 3, 0])
def test_variants_equal_brute_force(spark, wide):
    docs = made_up(3, 20_000 if wide else 50)  # a crowd's rows hold a word once for each of its letters
    rows = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n long").repartition(3)
    expected = brute_force(docs)
    assert any(r[2] not in (r[0], r[1]) for r in expected), "some roots are two steps away"
    assert found(variants.spelling_variants(rows, wide)) == expected


def test_pairs_of_a_crowd_of_anagrams(spark):
    """Words of the same letters share all signatures; only those one edit apart may pair, each once."""
    rng = random.Random(1)
    words = set()
    while len(words) < 700:
        words.add("".join(rng.sample("abcdefghij", 10)))
    words |= {w[:4] + "z" + w[5:] for w in list(words)[:50]} | {w[:4] + w[5:] for w in list(words)[50:90]}
    df = spark.createDataFrame([(w, 2) for w in sorted(words)], "word string, n long")
    pairs = [(r.a, r.b) for r in variants.near_pairs(df).collect()]
    by_cut = {}
    for w in words:
        for i in range(len(w)):
            by_cut.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
    wanted = {tuple(sorted((a, b))) for ws in by_cut.values() for a in ws for b in ws if a != b}
    wanted |= {tuple(sorted((w, cut))) for (_, cut), ws in by_cut.items() if cut in words for w in ws}
    assert sorted(pairs) == sorted(wanted) and len(wanted) > 80


def test_near_words_share_a_signature():
    rng = random.Random(4)
    words, near = [], []
    for _ in range(2000):
        w = "".join(rng.choice("abcdeéè") for _ in range(rng.randint(7, 14)))
        i = rng.randrange(len(w))
        words.append(w)
        near.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + "q" + w[i + 1 :], w[:i] + "ç" + w[i:]]))
    a, b = (variants.vector_codes(pa.array(side), "abcdeéèqç").tolist() for side in (words, near))
    for x, y in zip(a, b, strict=True):
        assert any((x ^ y) & mask == 0 for mask in variants.MASKS)
    assert a == variants.vector_codes(pa.array(["".join(reversed(w)) for w in words]), "abcdeéèqç").tolist(), "a vector has no order"


def test_edges_against_sql(spark, folder):
    assert against_sql(spark, "op12_spelling_variants", folder) is not None


def test_no_words_give_no_rows(spark):
    assert variants.spelling_variants(spark.createDataFrame([(1, "short or 1234567 once sentence")], "doc_id long, text string")).count() == 0
