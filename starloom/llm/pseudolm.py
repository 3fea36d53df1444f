"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every word is predicted from the two words before and the two after it: rows of one table per place add up, pass tanh, and a two-level
softmax (class, then word in class) gives the word's probability. A document's score is the sum of its words' conditional log-probabilities.

The vocabulary is made of word counts over all documents. The most frequent words are tokens of the network; every other word is one of a cell, which the network
predicts, and has the cell's probability times its share of the cell's words, from a table of the counts of all words that stays in Spark and is
joined when documents are scored. Training is data parallel: texts become token numbers once, dealt to shards by a hash of the document, with as many shards
as the corpus has millions of words; the rounds divide all positions among them, so that each is a target exactly once. In a round each shard runs stochastic
gradient from the common weights over its positions of that round, in a fixed order, and the executors add up the changes, weighted by
words. So the network is a function of the documents, however they lie in partitions. What reaches the driver is the network, of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import chunk_rows, merged_cells, stored
from starloom.llm.words import Words, mix, ranges_hash, word_slices

CLASSES = 64
#: Words with an id of their own; the last class holds cells of the others, by the hash of their last two bytes.
KNOWN = CLASSES * (CLASSES - 1)
PLACES = (-2, -1, 1, 2)
WIDTH = 32
ROUNDS = 3
_BATCH = 4096
_PIECE = 4096
_RATE = 0.08
_PAD = CLASSES * CLASSES
_CHUNK = 1 << 12
SHARD_WORDS = 1 << 21
#: Slots by the leading bits of a word hash, to find a word of the vocabulary in a step or two.
_SLOT_BITS = 20
#: Count of all words together that a cell has not seen.
_UNSEEN = 0.5

_SHAPES = {"places": (len(PLACES), _PAD + 1, WIDTH), "bias": (WIDTH,), "classes": (WIDTH, CLASSES), "class_bias": (CLASSES,), "words": (CLASSES, WIDTH, CLASSES), "word_bias": (CLASSES, CLASSES)}
_SIZE = sum(int(np.prod(shape)) for shape in _SHAPES.values())


_CELL = (mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) % np.uint64(CLASSES)).astype(np.int64)


def cells(words: Words) -> np.ndarray:
    """The cell of each word, for those outside the vocabulary."""
    before = np.where(words.ends - words.starts > 1, words.data[np.maximum(words.ends - 2, 0)], 0) if len(words.ends) else words.ends
    return _CELL[words.data[words.ends - 1] + 256 * before.astype(np.int64)]


@dataclass
class Network:
    """``vocabulary``: sorted word hashes, ``ids`` of each; ``flat``: all weights, ``part`` names views into them; ``cells``: words
    of each cell; ``rare``: ``word, n`` of all words outside the vocabulary, which stays in Spark."""

    vocabulary: np.ndarray
    ids: np.ndarray
    flat: np.ndarray
    cells: np.ndarray
    rare: DataFrame | None = None
    index: np.ndarray | None = None

    def local(self) -> Network:
        """What tasks get."""
        return replace(self, rare=None)

    def part(self, flat: np.ndarray | None = None) -> dict[str, np.ndarray]:
        flat, out, at = self.flat if flat is None else flat, {}, 0
        for name, shape in _SHAPES.items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    def slots(self) -> np.ndarray:
        """First word of the vocabulary at or after each slot."""
        if self.index is None:
            self.index = np.searchsorted(self.vocabulary, np.arange(1 << _SLOT_BITS, dtype=np.uint64) << np.uint64(64 - _SLOT_BITS)).astype(np.int32)
        return self.index

    def tokens(self, words: Words) -> np.ndarray:
        out = KNOWN + cells(words)
        open_, at = np.arange(len(out)), self.slots()[words.hashes >> np.uint64(64 - _SLOT_BITS)] if len(self.vocabulary) else None
        while len(self.vocabulary) and len(open_):
            inside = at < len(self.vocabulary)
            open_, at = open_[inside], at[inside]
            found = self.vocabulary[at] == words.hashes[open_]
            out[open_[found]] = self.ids[at[found]]
            later = self.vocabulary[at] < words.hashes[open_]  # a smaller word of the same slot
            open_, at = open_[later], at[later] + 1
        return out


def padded(tokens: np.ndarray, text_ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens with paddings before, between and after the texts, and the place of each token there."""
    most = max(PLACES)
    place = np.arange(len(tokens)) + most * np.repeat(np.arange(1, len(text_ptr)), np.diff(text_ptr))
    out = np.full(len(tokens) + most * len(text_ptr), _PAD, dtype=np.uint16)
    out[place] = tokens
    return out, place


def contexts(around: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Tokens around each place, a column for each of ``PLACES``; beyond the text stands a padding token."""
    return np.stack([around[place + p] for p in PLACES]).T


_ONES = np.ones((CLASSES, 1), dtype=np.float32)


def _largest(x: np.ndarray) -> np.ndarray:
    """Of each row, by halves: columns are a power of two, and few for numpy's own way along rows."""
    while x.shape[1] > 1:
        half = x.shape[1] // 2
        x = np.maximum(x[:, :half], x[:, half:])
    return x


def _exponents(x: np.ndarray) -> np.ndarray:
    """Puts exponentials in place of ``x``; the sum of each row."""
    np.exp(x, out=x)
    return x @ _ONES


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= _largest(x)
    total = _exponents(x)
    x /= total
    return x


def _hidden(parts: dict[str, np.ndarray], around: np.ndarray) -> np.ndarray:
    total = parts["places"][0].take(around[:, 0], axis=0)
    total += parts["bias"]
    for place in range(1, len(PLACES)):
        total += parts["places"][place].take(around[:, place], axis=0)
    return np.tanh(total, out=total)


def _by_class(targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of targets by class, the class of each in it, and where each class begins and ends."""
    classes = (targets // CLASSES).astype(np.uint8)
    order = np.argsort(classes, kind="stable")
    classes = classes[order]
    return order, classes, np.searchsorted(classes, np.arange(CLASSES + 1))


def _word_scores(parts: dict[str, np.ndarray], hidden: np.ndarray, classes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Scores of the words of each row's class; rows come by class."""
    scores = np.empty((len(hidden), CLASSES), dtype=hidden.dtype)
    for c in np.flatnonzero(np.diff(edges)).tolist():
        rows = slice(edges[c], edges[c + 1])
        np.matmul(hidden[rows], parts["words"][c], out=scores[rows])
    scores += parts["word_bias"].take(classes, axis=0)
    return scores


def log_probabilities(parts: dict[str, np.ndarray], around: np.ndarray, targets: np.ndarray) -> np.ndarray:
    out = np.empty(len(targets))
    for start in range(0, len(targets), _PIECE):
        piece = slice(start, start + _PIECE)
        order, classes, edges = _by_class(targets[piece])
        hidden, each = _hidden(parts, around[piece][order]), np.arange(len(order))
        values = np.zeros(len(order))
        for scores, target in ((hidden @ parts["classes"] + parts["class_bias"], classes), (_word_scores(parts, hidden, classes, edges), targets[piece][order] % CLASSES)):
            scores -= _largest(scores)
            values += scores[each, target]
            values -= np.log(_exponents(scores)[:, 0])
        out[start + order] = values
    return out


def _step(parts: dict[str, np.ndarray], squares: dict[str, np.ndarray], around: np.ndarray, targets: np.ndarray) -> None:
    """One step of Adagrad on a batch."""

    def move(name: str, slope: np.ndarray, at=...) -> None:
        seen = squares[name][at] + slope * slope
        squares[name][at] = seen
        parts[name][at] -= _RATE * slope / np.sqrt(seen)

    order, classes, edges = _by_class(targets)
    around, targets = around[order], targets[order]
    hidden, each = _hidden(parts, around), np.arange(len(targets))
    error = _softmax(hidden @ parts["classes"] + parts["class_bias"])
    error[each, classes] -= 1
    back = error @ parts["classes"].T
    wrong = _softmax(_word_scores(parts, hidden, classes, edges))
    wrong[each, targets % CLASSES] -= 1
    found = np.flatnonzero(np.diff(edges))
    slopes = np.empty((len(found), WIDTH, CLASSES), dtype=hidden.dtype)
    for i, c in enumerate(found.tolist()):
        rows = slice(edges[c], edges[c + 1])
        back[rows] += wrong[rows] @ parts["words"][c].T
        np.matmul(hidden[rows].T, wrong[rows], out=slopes[i])
    move("classes", hidden.T @ error)
    move("class_bias", error.sum(axis=0))
    at = ... if len(found) == CLASSES else found
    move("words", slopes, at)
    move("word_bias", np.add.reduceat(wrong, edges[found], axis=0), at)
    slope = back * (1 - hidden * hidden)
    move("bias", slope.sum(axis=0))
    for place in range(len(PLACES)):
        order = np.argsort(around[:, place], kind="stable")  # of two bytes each: by radix
        rows = around[order, place]
        starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        move("places", np.add.reduceat(slope.take(order, axis=0), starts, axis=0), (place, rows[starts]))


def _masked(tokens: np.ndarray, number: int, rounds: int) -> np.ndarray:
    """Positions of one round; each position belongs to exactly one of the ``rounds``."""
    spot = np.arange(len(tokens), dtype=np.uint64)
    return np.flatnonzero(mix(spot ^ mix(tokens.astype(np.uint64))) % np.uint64(rounds) == number)


_TOKENS = "hash long, tokens binary"
_SHARD = "shard long, tokens binary, sizes binary"


def _numbered(shared):
    """Token numbers of each text, two bytes each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network: Network = shared.value
        for batch in batches:
            for first, last, words in word_slices(batch.column(1)):
                raw, ends = network.tokens(words).astype("<u2").tobytes(), words.text_ptr.tolist()
                parts = [raw[2 * a : 2 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], pa.array(parts, pa.binary())], names=["hash", "tokens"])

    return scan


def _gathered(key: tuple, rows: pa.Table) -> pa.Table:
    """One row for a shard: its texts by hash, then tokens."""
    texts = [t for _, t in sorted(zip(rows.column("hash").to_pylist(), rows.column("tokens").to_pylist(), strict=True)) if t]
    sizes = np.array([len(t) // 2 for t in texts], dtype="<u4").tobytes()
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "tokens": pa.array([b"".join(texts)], pa.binary()), "sizes": pa.array([sizes], pa.binary())})


def _train(shared, number: int, rounds: int):
    """Per task the changes of the weights by its shards, each times its number of words, and these numbers in the last cell."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network: Network = shared.value
        total = np.zeros(-(-(_SIZE + 1) // _CHUNK) * _CHUNK)
        for batch in batches:
            for raw, sizes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                tokens = np.frombuffer(raw, dtype="<u2").astype(np.int64)
                text_ptr = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, dtype="<u4"), dtype=np.int64)])
                flat = network.flat.copy()
                parts, squares = network.part(flat), network.part(np.full(_SIZE, 1.0, dtype=np.float32))
                masked = _masked(tokens, number, rounds)
                around, place = padded(tokens, text_ptr)
                for i in range(0, len(masked), _BATCH):
                    at = masked[i : i + _BATCH]
                    _step(parts, squares, contexts(around, place[at]), tokens[at])
                total[:_SIZE] += (flat - network.flat) * float(len(masked))
                total[_SIZE] += len(masked)
        if total[_SIZE]:
            rows = chunk_rows(total)
            for i in range(0, len(rows), 32):
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows[i : i + 32]], pa.int32()), pa.array([b for _, b in rows[i : i + 32]], pa.binary())], names=["chunk", "cells"])

    return scan


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, words in word_slices(batch.column(0)):
            known, at, counts = np.unique(words.hashes, return_index=True, return_counts=True)
            columns = [pa.array(known.view(np.int64)), pa.array(cells(words)[at].astype(np.int8)), pa.array(counts.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "cell", "n"])


def train(docs: DataFrame, rounds: int = ROUNDS, seed: int = 11) -> Network:
    """Fit the network on all documents; every position is a target in one of the rounds."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    counts = stored(texts.mapInArrow(_count, "word long, cell byte, n long").groupBy("word").agg(F.min("cell").alias("cell"), F.sum("n").alias("n")), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(KNOWN).collect()
    hashes = np.array([r.word for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    rare, totals = counts.where(F.lit(False)), np.zeros(CLASSES)
    if len(top) == KNOWN:
        last = top[-1]
        rare = counts.where((F.col("n") < last.n) | ((F.col("n") == last.n) & (F.col("word") > last.word)))
        for row in rare.groupBy("cell").agg(F.sum("n").alias("n")).collect():
            totals[row.cell] = row.n
    network = Network(hashes[order], order, np.zeros(_SIZE, dtype=np.float32), totals, rare.select("word", "n"))
    parts = network.part()
    rng = np.random.default_rng(seed)
    for name in ("places", "classes", "words"):
        parts[name][...] = rng.normal(0, 0.05, _SHAPES[name])
    seen = np.full(CLASSES * CLASSES, 0.5)
    seen[: len(top)] += [r.n for r in top]
    seen[KNOWN:] += max(1.0, float(seen[:KNOWN].sum()) / 4 / CLASSES)
    by_class = seen.reshape(CLASSES, CLASSES)
    parts["class_bias"][...] = np.log(by_class.sum(axis=1) / by_class.sum())
    parts["word_bias"][...] = np.log(by_class / by_class.sum(axis=1, keepdims=True))
    shared = docs.sparkSession.sparkContext.broadcast(network.local())
    words = counts.agg(F.sum("n")).first()[0] or 0
    owner = [F.col("doc_id").cast("long")] if "doc_id" in docs.columns else []
    numbered = docs.select(F.xxhash64(*owner, F.col("text").cast("string")).alias("hash"), F.col("text").cast("string").alias("text")).where("text is not null").mapInArrow(_numbered(shared), _TOKENS)
    dealt = numbered.groupBy(F.pmod("hash", F.lit(max(1, -(-words // SHARD_WORDS)))).alias("shard")).applyInArrow(_gathered, _SHARD)
    shards = stored(dealt, "shards") if rounds else None
    for number in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(network.local())
        changes = merged_cells(shards.mapInArrow(_train(shared, number, rounds), "chunk int, cells binary"), -(-(_SIZE + 1) // _CHUNK) * _CHUNK, "<f8")
        if changes[_SIZE] > 0:
            network = replace(network, flat=(network.flat + changes[:_SIZE] / changes[_SIZE]).astype(np.float32))
    return network


_SCORED = "row long, doc_id long, n_words long, base double, rare array<long>"


def _score(shared):
    """Per row its words, the sum of their log-probabilities as if no cell had seen any word outside the vocabulary, and these words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network: Network = shared.value
        parts = network.part()
        unseen = np.log(_UNSEEN) - np.log(network.cells + _UNSEEN)
        for batch in batches:
            for first, last, words in word_slices(batch.column(2)):
                tokens = network.tokens(words)
                values = log_probabilities(parts, contexts(*padded(tokens, words.text_ptr)), tokens)
                outside = tokens >= KNOWN
                values[outside] += unseen[tokens[outside] - KNOWN]
                running, before = np.concatenate(([0.0], np.cumsum(values))), np.concatenate(([0], np.cumsum(outside)))
                sums = running[words.text_ptr[1:]] - running[words.text_ptr[:-1]]
                rare = pa.ListArray.from_arrays(pa.array(before[words.text_ptr], pa.int32()), pa.array(words.hashes[outside].view(np.int64)))
                columns = [batch.column(0)[first:last], batch.column(1)[first:last], pa.array(np.diff(words.text_ptr).astype(np.int64)), pa.array(sums), rare]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_words", "base", "rare"])

    return scan


def score(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, n_words, log_probability, mean_log_probability`` per row; a text without words has sum 0 and no mean.

    A word outside the vocabulary has its cell's probability times its share of the cell's words in the corpus of training; all words
    that this corpus lacks have together the share of half a word.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network.local())
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(texts.mapInArrow(_score(shared), _SCORED), "scores")
    rare = rows.select("row", F.explode("rare").alias("word")).join(network.rare, "word")
    gains = rare.groupBy("row").agg(F.sum(F.log(F.col("n") / F.lit(_UNSEEN))).alias("gain"))
    total = F.col("base") + F.coalesce("gain", F.lit(0.0))
    rows = rows.select("row", "doc_id", "n_words", "base").join(gains, "row", "left")
    return rows.select("doc_id", "n_words", total.alias("log_probability"), F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_probability"))
