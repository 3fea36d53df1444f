"""Cross-tokenizer alignment against plain loops over both tokenizers, over edges and a whole test table."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import alignment
from starloom.llm.encoding import byte_letters
from starloom.llm.queries import QUERIES

_a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
_a.encode_special_tokens = True
_b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
_letters = byte_letters()


def tokens(text: str | None) -> tuple[list[tuple[int, bytes]], list[tuple[int, bytes]]]:
    if not text:
        return [], []
    a = [(i, bytes(_letters[c] for c in _a.id_to_token(i))) for i in _a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in _b.encode(text):
        piece = _b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if _b.is_byte(i) else piece.replace("▁", " ").encode()))
    wanted = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == wanted == b"".join(t for _, t in b) else ([], [])


def spans(side: list[tuple[int, bytes]]) -> list[tuple[int, int, int]]:
    out, at = [], 0
    for i, t in side:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute_force(docs: list[tuple]) -> list[tuple]:
    rows, held = [], Counter()
    for doc_id, text in docs:
        a, b = map(spans, tokens(text))
        links, first = [], 0
        for x, s, e in a:
            while first < len(b) and b[first][2] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][1] < e:
                links.append((x, b[k][0]))
                k += 1
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, start = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= cut) for side in (a, b)) if len(a) < 400 else None)
            start = cut
        rows.append((doc_id, len(a), len(b), len(cuts), links, groups))
        held.update(set(links))
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, n_a, n_b, n_groups, links, groups in rows:
        sha = "" if not groups else None if groups[0] is None else hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc_id, n_a, n_b, n_groups, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), sha))
    return out


def compared(df, docs: list[tuple]) -> None:
    found = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]
    wanted = brute_force(docs)
    shas = {(*w[:7],) for w in wanted if w[7] is None}  # long texts: all but the hash
    key = lambda r: (r[0] is None, r[0] or 0, r[1:7])
    for f, w in zip(sorted(found, key=key), sorted(wanted, key=key), strict=True):
        assert f[:7] == w[:7]
        assert f[7] == w[7] or f[:7] in shas


TEXTS = [
    None,
    "",
    " ",
    "  two  spaces\n\nand lines\t",
    "<|endoftext|> and </s> <s> <unk> <0x41> are text",
    "a▁b is not given back",
    "漢字 🙂 Ünïcödé ﬁ ½ ­ ﻿",
    "naïve naïve café",
    "x" * 3000,
    "\x00\x01",
    "word " * 2000,
    "The same words again and again.",
    "The same words again and again.",
]


@pytest.mark.parametrize("block_bytes", [alignment.BLOCK_BYTES, 1])
def test_edges_equal_brute_force(spark, block_bytes):
    docs = [*enumerate(TEXTS), (None, "no id"), (3, "repeated id"), (3, None), (None, None)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, block long, pair int").repartition(3)
    compared(alignment.align(df, block_bytes=block_bytes), docs)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    compared(QUERIES["op11_token_alignment"](spark, "/root/testdata/sf0.001"), docs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab'sé漢1!🙂▁<>|", max_size=30), max_size=5))
def test_blocks_equal_brute_force(texts):
    both = alignment.tokenizers(None, None)
    docs = list(range(len(texts)))
    row = alignment.aligned_block(both, docs, texts)
    wanted = brute_force(list(zip(docs, texts, strict=True)))
    assert list(zip(*row[:5], row[5], strict=True)) == [(*w[:5], w[7]) for w in wanted]


def test_merge_is_the_same_for_all_lane_lengths():
    rng = random.Random(2)
    total = 5000
    docs = sorted(rng.sample(range(1, total), 20))
    a = np.array(sorted({*rng.sample(range(1, total), 1500), *docs, total}))
    b = np.array(sorted({*rng.sample(range(1, total), 900), *docs, total}))
    ends = np.array([0, *docs, total])
    a_bounds, b_bounds = np.searchsorted(a, ends, side="right"), np.searchsorted(b, ends, side="right")
    results = []
    for lane in (1, 7, 100, 10_000):
        i, j, a_cut, b_cut = alignment.merge(a, b, a_bounds, b_bounds, lane)
        results.append((sorted(zip(i.tolist(), j.tolist(), strict=True)), a_cut.tolist(), b_cut.tolist()))
    assert all(r == results[0] for r in results)
    a_from, b_from = np.concatenate([[0], a[:-1]]), np.concatenate([[0], b[:-1]])
    overlap = [(x, y) for x in range(len(a)) for y in range(len(b)) if a_from[x] < b[y] and b_from[y] < a[x]]
    assert results[0][0] == overlap
    assert [e for e, c in zip(a.tolist(), results[0][1], strict=True) if c] == sorted(set(a.tolist()) & set(b.tolist()))
