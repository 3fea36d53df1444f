"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A text becomes a short row of rates: words of a general and of two learned lexicons (whole words and word beginnings), as
they stand and after undoing look-alike characters; their distance to second-person words; capitals; punctuation; obfuscation. Learned
lexicons, trees and calibration each use their own part of a bounded sample of labelled documents, balanced by class; class
weights restore the true shares for the calibration. Scoring runs over whole texts in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.words import Words, find_words, ranges_hash, slices, string_buffers

#: Labelled documents used for training at most, both classes together, and entries of each learned lexicon at most.
SAMPLE_DOCUMENTS = 8000
LEXICON_ENTRIES = 400
STEM_BYTES = (4, 5, 6, 7, 8)
NEAR = 5
_SPAN = 50

#: Words that insult in several languages.
INSULTS = (
    "idiot idiots stupid moron morons loser losers scum trash clown pathetic worthless disgusting dumb fool imbecile jerk freak creep "
    "garbage filth vermin idiota imbecil estupido basura payaso idiote imbecile stupide ordure dumm bloed trottel abschaum muell"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros".split()

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[ord("a") : ord("z") + 1] = True
_IS_LETTER[0x80:] = True
_ALIKE = np.arange(256, dtype=np.uint8)
_ALIKE[[ord(c) for c in "0134578@$|+"]] = [ord(c) for c in "oieastbaslt"]
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_MARKS = {name: np.isin(np.arange(256), [ord(c) for c in chars]) for name, chars in {"shout": "!", "ask": "?", "stop": ".,;:", "symbol": "#*$%&|<>@^~_", "digit": "0123456789"}.items()}


def _letters(words: Words, data: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes that are kept, and where each word starts and ends among them."""
    at = np.concatenate(([0], np.cumsum(keep)))
    return data[keep], at[words.starts], at[words.ends]


def hash_words(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return np.unique(ranges_hash(np.frombuffer(b"".join(raw), dtype=np.uint8), ends - [len(w) for w in raw], ends))


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), dtype=bool)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return known[at] == hashes


@dataclass
class Forms:
    """Hashes of the words of some texts: letters only, letters after undoing look-alikes, and word beginnings."""

    words: Words
    plain: np.ndarray
    alike: np.ndarray
    stems: list[np.ndarray]


def forms(data: np.ndarray, bounds: np.ndarray) -> Forms:
    words = find_words(data, bounds)
    low = _LOWER[words.data]
    kept, starts, ends = _letters(words, low, _IS_LETTER[low])
    plain = ranges_hash(kept, starts, ends)
    stems = [np.where(ends - starts > n, ranges_hash(kept, starts, np.minimum(ends, starts + n)), np.uint64(0)) for n in STEM_BYTES]
    alike = _ALIKE[low]
    alike = ranges_hash(*_letters(words, alike, _IS_LETTER[alike]))
    return Forms(words, plain, alike, stems)


@dataclass
class Lexicons:
    words: np.ndarray
    stems: np.ndarray

    def __post_init__(self):
        self.insults, self.person = hash_words(list(INSULTS)), hash_words(list(SECOND_PERSON))


def features(data: np.ndarray, bounds: np.ndarray, lexicons: Lexicons) -> np.ndarray:
    """One row of features per text."""
    f = forms(data, bounds)
    ptr, raw = f.words.text_ptr, f.words.data
    edges = bounds - bounds[0]
    count = np.diff(ptr).astype(float)
    size = np.maximum(count, 1)

    def total(flags: np.ndarray, at: np.ndarray = ptr) -> np.ndarray:
        running = np.concatenate(([0], np.cumsum(flags)))
        return (running[at[1:]] - running[at[:-1]]).astype(float)

    insults, person = _among(f.plain, lexicons.insults), _among(f.plain, lexicons.person)
    learned = _among(f.plain, lexicons.words)
    stems = np.logical_or.reduce([_among(s, lexicons.stems) for s in f.stems])
    hidden = (_among(f.alike, lexicons.insults) | _among(f.alike, lexicons.words)) & ~insults & ~learned
    bad = insults | learned | stems | hidden
    first, last = np.repeat(ptr[:-1], np.diff(ptr)), np.repeat(ptr[1:], np.diff(ptr))
    spot = np.arange(len(bad))
    people, hits = np.concatenate(([0], np.cumsum(person))), np.concatenate(([0], np.cumsum(bad)))
    close = bad & (people[np.minimum(spot + NEAR + 1, last)] > people[np.maximum(spot - NEAR, first)])
    dense = hits[np.minimum(spot + _SPAN, last)] - hits[spot]
    thickest = np.zeros(len(count))
    full = np.flatnonzero(count)
    if len(full):
        thickest[full] = np.maximum.reduceat(dense, ptr[full])

    capital = _CAPITAL[raw]
    letters = np.maximum(total(_IS_LETTER[_LOWER[raw]], edges), 1)
    bytes_ = np.maximum(np.diff(edges).astype(float), 1)
    running = np.concatenate(([0], np.cumsum(capital)))
    lengths = f.words.ends - f.words.starts
    shouted = (running[f.words.ends] - running[f.words.starts] >= 0.8 * lengths) & (lengths > 2)
    inner = ~_IS_LETTER[_LOWER[raw]]
    inner[f.words.starts] = False
    inner[np.maximum(f.words.ends - 1, 0)] = False
    masked = np.concatenate(([0], np.cumsum(inner)))
    masked = masked[f.words.ends] > masked[f.words.starts]
    same = np.zeros(len(raw), dtype=bool)
    same[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & _IS_LETTER[_LOWER[raw[2:]]]
    columns = [
        total(insults), total(insults) / size, total(learned), total(learned) / size, total(stems), total(stems) / size, total(hidden), total(bad), total(bad) / size,
        thickest, total(close), total(person) / size, total(capital, edges) / letters, total(shouted) / size, total(masked) / size, total(same, edges) / letters,
        *[total(mark[raw], edges) / bytes_ for mark in _MARKS.values()], np.log1p(count),
    ]
    return np.stack(columns, axis=1)


@dataclass
class Trees:
    """Boosted trees of fixed depth, stored level by level, and a calibration table."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        each = np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (rows[each, feature[node]] > cut[node])
            out += leaf[node - len(feature)]
        return out

    def score(self, rows: np.ndarray) -> np.ndarray:
        margin = self.margin(rows)
        return np.clip(np.interp(margin, self.raw, self.calibrated), 0, 1) if len(self.raw) else 1 / (1 + np.exp(-margin))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def boost(rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 48, least: float = 2.0) -> Trees:
    """Second-order boosting on quantile bins for the logistic loss."""
    share = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-4, 1 - 1e-4))
    model = Trees(float(np.log(share / (1 - share))), np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 1)), np.empty(0), np.empty(0))
    if len(labels) == 0 or labels.min() == labels.max():
        return model
    cuts = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins)[1:-1], method="lower")) for j in range(rows.shape[1])]
    codes = np.stack([np.searchsorted(c, rows[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    inner, margin, found = (1 << depth) - 1, np.full(len(labels), model.base), []
    for _ in range(trees):
        p = _sigmoid(margin)
        slope, weight = labels - p, p * (1 - p)
        feature, cut, node = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(len(labels), dtype=np.int64)
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            best = np.full(nodes, 1e-9)
            for j, edges in enumerate(cuts):
                cell = (node - first) * bins + codes[:, j]
                g = np.bincount(cell, slope, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                h = np.bincount(cell, weight, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain = np.where((h >= least) & (h[:, -1:] - h >= least), gain, 0)[:, : len(edges)]
                if gain.shape[1]:
                    at = gain.argmax(axis=1)
                    better = gain[np.arange(nodes), at] > best
                    best = np.where(better, gain[np.arange(nodes), at], best)
                    feature[first : first + nodes][better], cut[first : first + nodes][better] = j, edges[at[better]]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > cut[node])
        leaf = rate * np.bincount(node - inner, slope, inner + 1) / (np.bincount(node - inner, weight, inner + 1) + 1)
        margin += leaf[node - inner]
        found.append((feature, cut, leaf))
    model.feature, model.cut, model.leaf = (np.stack(x) for x in zip(*found, strict=True))
    return model


def isotonic(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic regression by pooling adjacent violators: block centres and values. Rows of one margin are one point, whatever their order."""
    blocks: list[list[float]] = []  # value, weight, sum of margins
    distinct, point = np.unique(margins, return_inverse=True)
    total = np.bincount(point, weights, len(distinct))
    share = np.bincount(point, weights * labels, len(distinct)) / total
    for m, y, w in zip(distinct.tolist(), share.tolist(), total.tolist(), strict=True):
        blocks.append([y, w, m * w])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            (a, u, s), (b, v, t) = blocks[-2:]
            blocks[-2:] = [[(a * u + b * v) / (u + v), u + v, s + t]]
    return np.array([s / w for _, w, s in blocks]), np.array([y for y, _, _ in blocks])


@dataclass
class Model:
    lexicons: Lexicons
    trees: Trees


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``stem, hash, toxic, clean``: texts of each class that hold the word or word beginning, summed per batch."""
    for batch in batches:
        data, bounds = string_buffers(batch.column(0))
        toxic = np.array(batch.column(1).to_pylist(), dtype=np.int64)
        for first, last in slices(bounds):
            f = forms(data, bounds[first : last + 1])
            text = np.repeat(np.arange(last - first), np.diff(f.words.text_ptr))
            for stem, hashes in [(False, f.plain), *[(True, s) for s in f.stems]]:
                pairs = np.unique(np.stack((hashes, text.astype(np.uint64)), axis=1)[hashes != 0], axis=0)
                if not len(pairs):
                    continue
                known, at = np.unique(pairs[:, 0], return_inverse=True)
                label = toxic[first:last][pairs[:, 1].astype(np.int64)]
                counts = [np.bincount(at[label == k], minlength=len(known)) for k in (1, 0)]
                yield pa.RecordBatch.from_arrays([pa.array([stem] * len(known)), pa.array(known.view(np.int64)), *map(pa.array, counts)], names=["stem", "hash", "toxic", "clean"])


def _sample_features(lexicons: Lexicons):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = string_buffers(batch.column(0))
            for first, last in slices(bounds):
                rows = features(data, bounds[first : last + 1], lexicons)
                yield pa.RecordBatch.from_arrays([batch.column(i)[first:last] for i in (1, 2, 3)] + [pa.array(rows.tolist(), pa.list_(pa.float64()))], names=["toxic", "draw", "doc_id", "row"])

    return scan


def train(docs: DataFrame, labels: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> Model:
    """Fit lexicons, trees and calibration on ``documents`` labelled rows at most. Rows with a null label or text do not count as labelled."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic").cast("int") == 1).cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    labels = labels.where(~held_out(F.col("doc_id"))).distinct()
    sizes = {row.toxic: row["count"] for row in labels.groupBy("toxic").count().collect()}
    each = documents // 2
    chance = F.when(F.col("toxic") == 1, min(1.0, 1.1 * each / sizes.get(1, 1))).otherwise(min(1.0, 1.1 * each / sizes.get(0, 1)))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / (1 << 30)
    picked = labels.where(draw < chance).select("doc_id", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(100)).cast("int").alias("draw"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(int(1.2 * documents))
    # at most 1.2 * documents rows, whatever the tables: small enough for every executor
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null").join(F.broadcast(picked), "doc_id")

    counts = sample.where("draw < 45").select("text", "toxic").mapInArrow(_word_counts, "stem boolean, hash long, toxic long, clean long")
    counts = counts.groupBy("stem", "hash").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    marked = counts.where("toxic >= 4 and toxic >= 8 * (clean + 0.25)")
    chosen = {stem: marked.where(F.col("stem") == stem).orderBy(F.desc(F.col("toxic") / (F.col("clean") + 1)), "hash").limit(LEXICON_ENTRIES).collect() for stem in (False, True)}
    lexicons = Lexicons(*[np.sort(np.array([r.hash for r in chosen[stem]], dtype=np.int64).view(np.uint64)) for stem in (False, True)])

    rows = sample.where("draw >= 45").select("text", "toxic", "draw", "doc_id").mapInArrow(_sample_features(lexicons), "toxic int, draw int, doc_id long, row array<double>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.toxic, r.row))
    values, toxic, part = np.array([r.row for r in rows]), np.array([r.toxic for r in rows], dtype=float), np.array([r.draw for r in rows])
    if not len(rows):
        return Model(lexicons, boost(np.empty((0, 1)), np.empty(0)))
    grow = part < 82
    trees = boost(values[grow], toxic[grow])
    rest = ~grow
    if len(set(toxic[rest].tolist())) == 2:
        seen = [max(1, int((toxic[rest] == k).sum())) for k in (0, 1)]
        weights = np.where(toxic[rest] == 1, sizes.get(1, 0) / seen[1], sizes.get(0, 0) / seen[0])
        trees.raw, trees.calibrated = isotonic(trees.margin(values[rest]), toxic[rest], weights)
    return Model(lexicons, trees)


def _score(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            data, bounds = string_buffers(batch.column(1))
            for first, last in slices(bounds):
                scores = model.trees.score(features(data, bounds[first : last + 1], model.lexicons))
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], pa.array(scores)], names=["doc_id", "score"])

    return scan


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row; a null text scores like an empty one. Without labels of both classes every text scores the share of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_score(shared), "doc_id long, score double")
