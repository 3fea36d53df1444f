"""Language identification by a linear-chain conditional random field over the words of a text.

Every word gets one score per language from the weights of its features: the word itself, affixes, character n-grams and
membership in lexicons learned per language. Learned transitions tie neighbours together, so forward-backward labels words in
code-switched text. The language of a text is the one with the largest sum of word marginals.

Training happens on the driver, on a sample whose size is a parameter; chains are cut from one document or switch between documents of
several languages. Labelling runs in tasks over whole texts: emissions come from a bounded table of known words,
and forward-backward runs over blocks of words side by side, exactly, with messages passed from block to block.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.words import SMALL_SLICE_BYTES, lean, ranges_hash, slices, string_buffers

UNKNOWN = "und"
#: The model is fitted on so many labelled documents at most, all languages together, and on so many words of each.
SAMPLE_DOCUMENTS = 2000
SAMPLE_WORDS = 120
_BUCKETS = 1 << 16
_BLOCK = 64
_CHAIN = 32
_CACHED_WORDS = 200_000
_EDGES = regex.compile(r"^\P{L}+|\P{L}+$")


def letters_of(word: str) -> str:
    """A word without what surrounds its letters (Unicode's L categories; no numerals and marks); empty if it has none."""
    return word if word.isalpha() else _EDGES.sub("", word)


def split_words(text: str) -> list[str]:
    """Lower-case words that hold a letter."""
    return [x for word in text.lower().split() if (x := letters_of(word))]


#: Lengths in bytes of n-grams, taken over the word between two marks, and of longer beginnings and ends.
_GRAMS = (2, 3, 4)
_AFFIX = 6


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``owner, bucket`` of the features of words: the word, its beginnings and ends, and its n-grams, hashed into buckets."""
    raw = [f"<{word}>".encode() for word in words]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    ends = np.cumsum([len(x) for x in raw])
    starts = ends - [len(x) for x in raw]
    own = np.arange(len(words))
    parts = [(own, starts, ends), (own, starts, np.minimum(ends, starts + _AFFIX)), (own, np.maximum(starts, ends - _AFFIX), ends)]
    of_byte = np.repeat(own, ends - starts)
    for n in _GRAMS:
        at = np.flatnonzero(np.arange(len(data)) + n <= ends[of_byte])
        parts.append((of_byte[at], at, at + n))
    buckets = [(ranges_hash(data, a, b) + np.uint64(kind)) % np.uint64(_BUCKETS) for kind, (_, a, b) in enumerate(parts)]
    return np.concatenate([p[0] for p in parts]), np.concatenate(buckets).astype(np.int64)


@dataclass
class Chain:
    """A fitted field. ``weights``: per feature bucket and language; the last rows belong to the lexicons. ``steps``: transition scores."""

    languages: list[str]
    weights: np.ndarray
    steps: np.ndarray
    lexicon: dict[str, int]
    rows: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        owner, bucket = word_features(words)
        homes = [(i, _BUCKETS + self.lexicon[word]) for i, word in enumerate(words) if word in self.lexicon]
        extra = np.array(homes, dtype=np.int64).reshape(-1, 2)
        return np.concatenate((owner, extra[:, 0])), np.concatenate((bucket, extra[:, 1]))

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the words that hold a letter, and which these are, by way of a table of bounded size."""
        if self.scores is None or len(self.rows) > _CACHED_WORDS:
            self.rows, self.scores = {}, np.zeros((0, len(self.languages)), dtype=np.float32)
        rows = self.rows
        new = [word for word in dict.fromkeys(words) if word not in rows]
        clean = [letters_of(word) for word in new]
        full = [word for word in clean if word]
        if full:
            owner, bucket = self.features(full)
            added = np.stack([np.bincount(owner, self.weights[bucket, j], len(full)) for j in range(len(self.languages))], axis=1)
            self.scores = np.concatenate((self.scores, added.astype(np.float32)))
        at = len(self.scores) - len(full)
        for word, letters in zip(new, clean, strict=True):
            rows[word] = at if letters else -1
            at += bool(letters)
        places = np.array(list(map(rows.__getitem__, words)), dtype=np.int64)
        return self.scores[places[places >= 0]], places >= 0


def _normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-30)


def _potentials(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True)) + 1e-12


def marginals(chain: Chain, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Marginals of every word of several texts; ``scores`` holds their words one text after the other, none of them empty.

    Texts are cut into blocks. Products of the transfer matrices of each block carry messages across block borders, so the result is that of
    forward-backward over the whole text.
    """
    k = scores.shape[1]
    blocks = -(-sizes // _BLOCK)
    head = np.cumsum(blocks) - blocks
    text = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(scores)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    block, step = head[text] + at // _BLOCK, at % _BLOCK
    total = int(blocks.sum())
    emit = np.ones((total, _BLOCK, k))
    emit[block, step] = _potentials(scores)
    used = np.zeros((total, _BLOCK), dtype=bool)
    used[block, step] = True
    move = np.exp(chain.steps - chain.steps.max())

    product = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(_BLOCK):
        more = (product.reshape(-1, k) @ move).reshape(total, k, k) * emit[:, t, None, :]
        product = np.where(used[:, t, None, None], more / more.sum(axis=(1, 2), keepdims=True), product)
    ahead, behind = np.full((total, k), 1.0 / k), np.full((total, k), 1.0 / k)
    for b in range(1, int(blocks.max())):
        at_b = head[blocks > b] + b
        ahead[at_b] = _normal(np.einsum("ni,nij->nj", ahead[at_b - 1], product[at_b - 1]))
    for b in range(int(blocks.max()) - 2, -1, -1):
        at_b = head[blocks > b + 1] + b
        behind[at_b] = _normal(np.einsum("nij,nj->ni", product[at_b + 1], behind[at_b + 1]))

    out = np.empty_like(emit)
    for t in range(_BLOCK):
        ahead = np.where(used[:, t, None], _normal((ahead @ move) * emit[:, t]), ahead)
        out[:, t] = ahead
    for t in range(_BLOCK - 1, -1, -1):
        out[:, t] = _normal(out[:, t] * behind)
        behind = np.where(used[:, t, None], _normal((emit[:, t] * behind) @ move.T), behind)
    return out[block, step]


def fit(samples: list[tuple[str, list[str]]], steps: int = 120, seed: int = 7) -> Chain:
    """Fit a field on ``(language, words)`` samples by stochastic gradient on the likelihood of labelled chains."""
    languages = sorted({language for language, _ in samples})
    number = {language: i for i, language in enumerate(languages)}
    k = len(languages)
    seen: dict[str, Counter] = defaultdict(Counter)
    for language, words in samples:
        for word in set(words):
            seen[word][number[language]] += 1
    lexicon = {w: c.most_common(1)[0][0] for w, c in seen.items() if c.total() >= 3 and c.most_common(1)[0][1] >= 0.9 * c.total()}
    chain = Chain(languages, np.zeros((_BUCKETS + k, k), dtype=np.float64), np.zeros((k, k)), lexicon)
    if k < 2:
        return chain

    rng = np.random.default_rng(seed)
    vocabulary = {word: i for i, word in enumerate(seen)}
    owner, bucket = chain.features(list(vocabulary))
    by_language = [[np.array([vocabulary[w] for w in words]) for language, words in samples if number[language] == i] for i in range(k)]
    squares, step_squares = np.full_like(chain.weights, 1e-3), np.full((k, k), 1e-3)
    for _ in range(steps):
        words, labels = _switched_chains(rng, by_language, 256)
        table = np.stack([np.bincount(owner, chain.weights[bucket, j], len(vocabulary)) for j in range(k)], axis=1)
        emit, move = _potentials(table[words]), np.exp(chain.steps)
        ahead, behind = np.empty_like(emit), np.empty_like(emit)
        ahead[:, 0] = _normal(np.full((len(words), k), 1.0 / k) @ move * emit[:, 0])
        behind[:, -1] = 1.0
        for t in range(1, _CHAIN):
            ahead[:, t] = _normal(ahead[:, t - 1] @ move * emit[:, t])
            behind[:, -1 - t] = _normal((emit[:, -t] * behind[:, -t]) @ move.T)
        marginal = _normal(ahead * behind)
        pairs = ahead[:, :-1, :, None] * move * (emit * behind)[:, 1:, None, :]
        pairs /= pairs.sum(axis=(2, 3), keepdims=True)
        error = np.eye(k)[labels] - marginal
        by_word = np.stack([np.bincount(words.ravel(), error[..., j].ravel(), len(vocabulary)) for j in range(k)], axis=1) / len(words)
        slope = np.stack([np.bincount(bucket, by_word[owner, j], len(chain.weights)) for j in range(k)], axis=1) - 1e-6 * chain.weights
        squares += slope * slope
        chain.weights += 0.3 * slope / np.sqrt(squares)
        hits = np.bincount((labels[:, :-1] * k + labels[:, 1:]).ravel(), minlength=k * k).reshape(k, k)
        slope = (hits - pairs.sum(axis=(0, 1))) / len(words)
        step_squares += slope * slope
        chain.steps += 0.1 * slope / np.sqrt(step_squares)
    chain.weights = chain.weights.astype(np.float32)
    return chain


def _switched_chains(rng: np.random.Generator, by_language: list[list[np.ndarray]], count: int) -> tuple[np.ndarray, np.ndarray]:
    """Chains of fixed length; half of them in one language, the others switch once or twice."""
    words, labels = np.empty((count, _CHAIN), dtype=np.int64), np.empty((count, _CHAIN), dtype=np.int64)
    for row in range(count):
        cuts = [0, *sorted(rng.integers(1, _CHAIN, size=int(rng.integers(1, 3)) if row % 2 else 0)), _CHAIN]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            language = int(rng.integers(len(by_language)))
            source = by_language[language][int(rng.integers(len(by_language[language])))]
            start = int(rng.integers(len(source)))
            words[row, a:b] = np.take(source, np.arange(start, start + b - a), mode="wrap")
            labels[row, a:b] = language
    return words, labels


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, words: int = SAMPLE_WORDS) -> list[tuple[str, list[str]]]:
    """A stretch of words of ``documents`` labelled documents at most, in equal parts by language, chosen by hashes of their ids."""
    labelled = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    labelled = labelled.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {row.lang: row["count"] for row in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    each = max(1, documents // len(counts))
    chance = F.create_map(*[x for lang, n in sorted(counts.items()) for x in (F.lit(lang), F.lit(min(1.0, 1.5 * each / n)))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) / (1 << 30)
    parts = F.split("text", r"[\x20\x09-\x0D]+")
    start = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.greatest(F.size(parts) - words, F.lit(0)) + 1)
    picked = labelled.where(draw < F.element_at(chance, F.col("lang")))
    rows = picked.select("lang", "doc_id", draw.alias("draw"), F.slice(parts, (start + 1).cast("int"), words).alias("words")).orderBy("draw", "doc_id").limit(2 * documents).collect()
    taken: Counter = Counter()
    out = []
    for row in rows:
        found = split_words(" ".join(row.words))
        if found and taken[row.lang] < each:
            taken[row.lang] += 1
            out.append((row.lang, found))
    return out


def train(docs: DataFrame, **bounds: int) -> Chain:
    return fit(training_sample(docs, **bounds))


def _label(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: Chain = shared.value
        for batch in batches:
            texts = batch.column(1)
            _, bounds = string_buffers(texts)
            for first, last in slices(bounds, SMALL_SLICE_BYTES):
                words = [text.lower().split() if text else [] for text in texts[first:last].to_pylist()]
                owner = np.repeat(np.arange(last - first), [len(w) for w in words])
                scores, kept = chain.emissions([w for text in words for w in text])
                sizes = np.bincount(owner[kept], minlength=last - first)
                best, share = np.full(last - first, -1), np.zeros(last - first)
                full = np.flatnonzero(sizes)
                if len(full) and chain.languages:
                    found = marginals(chain, scores, sizes[full])
                    sums = np.add.reduceat(found, np.cumsum(sizes[full]) - sizes[full], axis=0) / sizes[full][:, None]
                    best[full], share[full] = sums.argmax(axis=1), np.clip(sums.max(axis=1), 0, 1)
                names = [chain.languages[i] if i >= 0 else UNKNOWN for i in best.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], pa.array(names, pa.string()), pa.array(share)], names=["doc_id", "lang_pred", "score"])

    return scan


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row: the language with the largest mean of word marginals, and that mean.

    ``und`` with score 0 for a text that is null or has no letter, and for all texts where there was nothing to learn from.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(_label(shared)), "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, least: float = 0.4, **bounds: int) -> DataFrame:
    """Rows of ``docs`` whose text is in a known language for at least the share ``least`` of its words."""
    chain = train(docs, **bounds)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int64()), batch.column(batch.schema.get_field_index("text"))], names=["doc_id", "text"])
            rows = [row for out in _label(shared)([pair]) for row in zip(out.column(1).to_pylist(), out.column(2).to_pylist(), strict=True)]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in rows], pa.bool_()))

    return docs.mapInArrow(lean(keep), docs.schema)
