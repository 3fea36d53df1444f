"""N-gram Jaccard join by prefixes under several global token orders.

A document is its set of distinct five-word shingles. Put both sets of a pair in any one global order: if their Jaccard
similarity reaches t, the first n - ceil(t n) + 1 tokens of either share a token. This holds for every
order at once, so the join takes one order to find pairs and the others to rule pairs out:

1. Orders: the first goes by document frequency, rare tokens first, the others by hashes. Frequencies come from
   counters of fixed size over all documents; a wrong estimate changes the order, which stays one for all, not the result.
2. Equal sets collapse to one node. Nodes that share a prefix token of the first order are linked by way of the smallest
   of them, not all pairs: candidates are (smallest, other).
3. Candidates whose sizes or whose prefixes under the other orders rule them out go; these prefixes are longer, and a pair has to share
   several of their tokens. The rest is verified on whole sets.
4. Verified links make components. Where a token still joins several components, their nodes are candidates too: those of the
   smaller component go through 3 against all of the larger one, in blocks inside tasks, and links join the
   components. A pair left out is inside one component already, so no link between components is missed.
5. A token that joins many components gives no pairs of them: its nodes go through 3 in pairs of blocks inside tasks, and the whole sets of those that
   remain are compared. Where the blocks of a token would be many, its nodes are keyed again by the tokens of their prefixes under the second
   order, then the third, so that a pair has to share a token under each. Of the smaller set of a pair the shorter prefix
   n - ceil(2 t n / (1 + t)) + 1 is enough; a key without such a node has no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.components import components
from starloom.llm.tables import CELLS, bounded_batches, chunk_rows, merged_cells, only_ids, passing_tables, stored
from starloom.llm.words import LOWER, SMALL_SLICE_BYTES, find_words, lean, mix, slices, string_buffers, windows_hash

WORDS = 5
PERCENT = 80
_ROWS = 2
_OTHER_ORDERS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)


def shingle_sets(texts: pa.Array, width: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of every text; under ``width`` words the whole sequence is one shingle."""
    data, bounds = string_buffers(texts)
    for first, last in slices(bounds, SMALL_SLICE_BYTES):
        words = find_words(data, bounds[first : last + 1], LOWER)
        hashes = windows_hash(words.hashes, width)
        for row, (a, b) in enumerate(zip(words.text_ptr[:-1].tolist(), words.text_ptr[1:].tolist(), strict=True), first):
            if b - a >= width:
                yield row, np.unique(hashes[a : b - width + 1])
            elif b > a:
                yield row, mix(windows_hash(words.hashes[a:b], b - a) + np.uint64(b - a))
            else:
                yield row, np.empty(0, dtype=np.uint64)


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set alone."""
    one, two = mix(shingles ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64), mix(shingles ^ np.uint64(0xE7037ED1A0B428DB)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _cells(shingles: np.ndarray) -> list[np.ndarray]:
    return [((shingles >> np.uint64(20 * row)) & np.uint64(CELLS - 1)).astype(np.int64) for row in range(_ROWS)]


_SETS = "doc_id long, n long, h1 long, h2 long, chunk int, cells binary"


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and digest of every set, and the task's token counters."""
    counters = np.zeros((_ROWS, CELLS), dtype=np.uint32)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("chunk", pa.int32()), ("cells", pa.binary())])

    def batch_of(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema], schema=schema)

    def count(found: list[np.ndarray]) -> None:
        tokens = np.concatenate(found) if found else np.empty(0, dtype=np.uint64)
        for row, cells in enumerate(_cells(tokens)):
            counters[row] += np.bincount(cells, minlength=CELLS).astype(np.uint32)

    for batch in batches:
        sizes, digests, pending, held = [], [], [], 0
        for _, shingles in shingle_sets(batch.column(1)):
            sizes.append(len(shingles))
            digests.append(_digest(shingles))
            pending.append(shingles)
            held += len(shingles)
            if held > CELLS // 4:
                count(pending)
                pending, held = [], 0
        count(pending)
        yield batch_of(doc_id=batch.column(0), n=sizes, h1=[x for x, _ in digests], h2=[x for _, x in digests])
    rows = chunk_rows(counters.reshape(-1))
    for i in range(0, len(rows), 32):
        yield batch_of(chunk=[c for c, _ in rows[i : i + 32]], cells=[b for _, b in rows[i : i + 32]])


def _prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _early_size(n, percent: int):
    """Prefix that the smaller set of a pair needs: the pair shares at least 2 t / (1 + t) of its tokens."""
    return n - (2 * percent * n + 99 + percent) // (100 + percent) + 1


_PREFIXES = "h1 long, n long, prefix array<long>, others array<binary>"


def _prefixes(counters, percent: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = counters.value
        seen: set[int] = set()  # sets this task has given; copies of one text leave it once
        for batch in batches:
            nodes, sizes, prefixes, others = [], [], [], []
            for _, shingles in shingle_sets(batch.column(0)):
                if not len(shingles):
                    continue
                node = _digest(shingles)[0]
                if node in seen:
                    continue
                if len(seen) >= 1 << 17:
                    seen.clear()
                seen.add(node)
                size = _prefix_size(len(shingles), percent)
                estimate = np.minimum.reduce([frequency[row][cells] for row, cells in enumerate(_cells(shingles))])
                nodes.append(node)
                sizes.append(len(shingles))
                prefixes.append(shingles[np.lexsort((shingles, estimate))[:size]].view(np.int64))
                others.append(_other_prefixes(shingles, percent))
            if nodes:
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(p) for p in prefixes]), pa.int32()), pa.array(np.concatenate(prefixes)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), lists, pa.array(others, pa.list_(pa.binary()))], names=["h1", "n", "prefix", "others"])

    return scan


_SIZED_SETS = "h1 long, tokens binary"


def _least_shared(n: int) -> int:
    return n // 10 + 1


def _other_prefixes(shingles: np.ndarray, percent: int) -> list[bytes]:
    """Prefixes under the other orders, in order, sixteen bits of each token. They are longer than needed to share one token: the
    l smallest common tokens of a pair are among the first n - ceil(t n) + l of either set."""
    size = min(len(shingles), _prefix_size(len(shingles), percent) + _least_shared(len(shingles)) - 1)
    return [np.sort(mix(shingles ^ np.uint64(seed)))[:size].astype("<u2").tobytes() for seed in _OTHER_ORDERS]


class _Filter:
    """Whether a pair can reach the threshold, by sizes and by tokens shared in its prefixes under each of the other orders."""

    def __init__(self, percent: int):
        self.percent, self.table = percent, np.zeros(1 << 16, dtype=bool)

    def __call__(self, n_a: int, a: list[bytes], n_b: int, b: list[bytes]) -> bool:
        if 100 * min(n_a, n_b) < self.percent * max(n_a, n_b):
            return False
        least = _least_shared(min(n_a, n_b))
        size_a, size_b = (_prefix_size(n, self.percent) + least - 1 for n in (n_a, n_b))
        return all(self._shared(x, size_a, y, size_b) >= least for x, y in zip(a, b, strict=True))

    def _shared(self, a: bytes, size_a: int, b: bytes, size_b: int) -> int:
        own = np.frombuffer(a, dtype="<u2")[:size_a]
        self.table[own] = True
        count = int(self.table[np.frombuffer(b, dtype="<u2")[:size_b]].sum())
        self.table[own] = False
        return count


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s for _, s in shingle_sets(batch.column(0)) if len(s)]
        yield pa.RecordBatch.from_arrays([pa.array([_digest(s)[0] for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["h1", "tokens"])


def _possible(percent: int):
    @F.pandas_udf(T.BooleanType())
    def check(n_a: pd.Series, a: pd.Series, n_b: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(list(map(_Filter(percent), n_a, a, n_b, b)), dtype=bool)

    return check


def _similar(percent: int):
    @F.pandas_udf(T.BooleanType())
    def check(left: pd.Series, right: pd.Series) -> pd.Series:
        def reach(a: bytes, b: bytes) -> bool:
            a, b = np.frombuffer(a, dtype="<u8"), np.frombuffer(b, dtype="<u8")
            both = np.sort(np.concatenate((a, b)))
            common = int((both[1:] == both[:-1]).sum())
            return 100 * common >= percent * (len(a) + len(b) - common)

        return pd.Series([reach(a, b) for a, b in zip(left, right, strict=True)], dtype=bool)

    return check


def _label_pairs(percent: int):
    """Pairs of labels that share a token and that the filter lets pass. A token has ``_LABELS`` labels at most.

    Rows ``lo, part, is_token, token, label, n, others`` come sorted: for each part of a ``lo`` the labels of single nodes with their prefixes, then its tokens.
    Pairs of one part are given once, as long as they fit.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        possible = _Filter(percent)
        now, labels, found, held = None, [], [], {}

        def passes(a: int, b: int) -> bool:
            one, two = held.get(a), held.get(b)
            return one is None or two is None or possible(*one, *two)

        def out() -> Iterator[pa.RecordBatch]:
            pairs = [pair for pair in np.unique(np.concatenate(found), axis=0).tolist() if passes(*pair)]
            for i in range(0, len(pairs), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array([pair[k] for pair in pairs[i : i + 10_000]], pa.int64()) for k in (0, 1)], names=["a", "b"])

        def give() -> None:
            """Each label with all after it."""
            values = np.array(labels, dtype=np.int64)
            for i in range(len(values) - 1):
                found.append(np.stack((np.full(len(values) - 1 - i, values[i]), values[i + 1 :]), axis=1))

        for batch in batches:
            for *lo, is_token, token, label, n, others in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if now is None or now[0] != lo or is_token and now[1] != token:
                    give()
                    if found and (now[0] != lo or sum(map(len, found)) > 1_000_000):
                        yield from out()
                        found = []
                    if now is None or now[0] != lo:
                        held.clear()
                    now, labels = (lo, token), []
                if is_token:
                    labels.append(label)
                else:
                    held[label] = n, others
        give()
        if found:
            yield from out()

    return scan


#: Components that a token joins by pairs; with more, its nodes are compared in pairs of blocks of so many nodes.
_LABELS = 256
_NODES = 1024

#: Rows of tokens in one part of the work of a smallest component.
_PART = 1024

#: Members of one component that a task compares queries with at a time.
_BLOCK = 256


class _Block:
    """Sets of some members; counts what a query shares with each of them."""

    def __init__(self, members: list[bytes], kind: str):
        values = [np.frombuffer(m, dtype=kind) for m in members]
        self.sizes = np.array([len(v) for v in values])
        tokens, owners = np.concatenate(values), np.repeat(np.arange(len(values)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owners = tokens[order], owners[order]

    def common(self, query: np.ndarray) -> np.ndarray:
        first, last = np.searchsorted(self.tokens, query, "left"), np.searchsorted(self.tokens, query, "right")
        counts = last - first
        at = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return np.bincount(self.owners[at], minlength=len(self.sizes))


def _blocks(batches: Iterator[pa.RecordBatch], members_of, compare) -> Iterator[tuple]:
    """Results of ``compare(members, query row)`` for rows ``target, block, query, ...`` that come sorted: the members of a block, then the queries against it."""
    now, rows, members = None, [], None
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if now != row[:2]:
                now, rows, members = row[:2], [], None
            if not row[2]:
                rows.append(row)
            elif rows:
                members = members_of(rows) if members is None else members
                if compare(members, row):
                    yield row


def _named(rows: list[tuple], names: list[str], at: tuple[int, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[k] for row in rows], pa.int32() if name == "block" else pa.int64()) for name, k in zip(names, at, strict=True)], names=names)


def _can_meet(percent: int):
    """Queries that the filter lets meet a member of the block. Rows ``target, block, query, label, node, n, others``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        possible = _Filter(percent)
        found = _blocks(batches, lambda rows: rows, lambda members, q: any(possible(m[5], m[6], q[5], q[6]) for m in members))
        yield _named(list(found), ["target", "block", "label", "node"], (0, 1, 3, 4))

    return scan


def _meet(percent: int):
    """Links between labels. Rows ``target, block, query, label, tokens``."""

    def linked(members: _Block, row: tuple) -> bool:
        query = np.frombuffer(row[4], dtype="<u8")
        common = members.common(query)
        return bool((100 * common >= percent * (members.sizes + len(query) - common)).any())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _blocks(batches, lambda rows: _Block([row[4] for row in rows], "<u8"), linked)
        yield _named(list(found), ["a", "b"], (3, 0))

    return scan


def _keys(percent: int, order: int):
    """Rows ``key, node, label, n, early`` keyed again by each token of the node's prefix under another order. Rows ``key, node, label, n, early, others``.

    The smaller set of a pair has to be early under every order.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, early = batch.column(0).to_numpy().view(np.uint64), batch.column(4).to_numpy(zero_copy_only=False)
            sizes = batch.column(3).to_numpy()
            for first in range(0, len(batch), 64):
                rows = range(first, min(len(batch), first + 64))
                found = [np.frombuffer(batch.column(5)[i][order].as_py(), dtype="<u2")[: _prefix_size(int(sizes[i]), percent)] for i in rows]
                counts = np.array([len(f) for f in found])
                at = np.repeat(np.arange(first, first + len(counts)), counts)
                place = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
                key = mix(keys[at] ^ mix(np.concatenate(found).astype(np.uint64) + np.uint64(1)))
                taken = batch.select(["node", "label", "n"]).take(pa.array(at))
                still = early[at] & (place < _early_size(sizes[at], percent))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *taken.columns, pa.array(still)], names=["key", "node", "label", "n", "early"])

    return scan


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], tuple]]:
    """``(members, query row)`` for rows ``key, i, j, query, ...`` that come sorted, members before queries; the list is one object within a cell."""
    now, members = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if now != row[:3]:
                now, members = row[:3], []
            if not row[3]:
                members.append(row)
            elif members:
                yield members, row


_CELL = "key long, i int, j int, query boolean, label long, node long"


def _cell_survivors(percent: int):
    """Rows of a cell that the filter lets meet one of another label. Rows ``key, i, j, query, label, node, n, others``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
            names = ["key", "i", "j", "query", "label", "node"]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

        now, found, met = None, [], None
        for members, row in _cells_of(batches):
            if members is not now:
                if met is not None:
                    found += [m for m, keep in zip(now, met.tolist(), strict=True) if keep]
                now, met = members, np.zeros(len(members), dtype=bool)
                blocks = [_Block([m[7][order] for m in members], "<u2") for order in range(len(_OTHER_ORDERS))]
                sizes, labels = (np.array([m[k] for m in members]) for k in (6, 4))
            least, most = np.minimum(sizes, row[6]), np.maximum(sizes, row[6])
            possible = (100 * least >= percent * most) & (labels != row[4])
            for order, block in enumerate(blocks):
                if possible.any():
                    possible &= block.common(np.frombuffer(row[7][order], dtype="<u2")) >= _least_shared(least)
            if possible.any():
                met |= possible
                found.append(row)
            if len(found) >= 5000:
                yield batch_of(found)
                found = []
        if met is not None:
            found += [m for m, keep in zip(now, met.tolist(), strict=True) if keep]
        yield batch_of(found)

    return scan


def _join_cells(percent: int):
    """Links between labels of one cell, as many as join them. Rows ``key, i, j, query, label, tokens``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, labels, top, links = None, None, None, {}, []

        def root(x: int) -> int:
            while top.setdefault(x, x) != x:
                top[x] = x = top[top[x]]
            return x

        for members, row in _cells_of(batches):
            if members is not now:
                now, top = members, {}
                block, labels = _Block([m[5] for m in members], "<u8"), np.array([m[4] for m in members])
            label, own = row[4], np.frombuffer(row[5], dtype="<u8")
            common = block.common(own)
            near = (100 * common >= percent * (block.sizes + len(own) - common)) & (labels != label)
            for other in np.unique(labels[near]).tolist():
                a, b = root(label), root(other)
                if a != b:
                    top[b] = a
                    links.append((label, other))
            if len(links) >= 5000:
                yield _named(links, ["a", "b"], (0, 1))
                links = []
        yield _named(links, ["a", "b"], (0, 1))

    return scan


_KEYED = "key long, node long, label long, n long, early boolean"


def _pairable(rows: DataFrame) -> DataFrame:
    """Rows of keys with an early node and two labels: others hold no pair to compare."""
    some = rows.groupBy("key").agg(F.max("early").alias("any"), F.min("label").alias("least"), F.max("label").alias("most")).where("any and least <> most")
    return rows.join(some.select("key"), "key", "left_semi")


def _merged(rows: DataFrame) -> DataFrame:
    """Keys of the same nodes become one; a node that is early under any of them is early there."""
    same = ["m", "x", "y"]
    keys = rows.groupBy("key").agg(F.count("*").alias("m"), *(F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(name) for seed, name in enumerate(same[1:])))
    firsts = keys.groupBy(*same).agg(F.min("key").alias("first"))
    rows = rows.join(keys.join(firsts, same).select("key", "first"), "key").groupBy(F.col("first").alias("key"), "node", "label", "n")
    return rows.agg(F.max("early").alias("early"))


class _Join:
    def __init__(self, docs: DataFrame, percent: int):
        self.percent = percent
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        survey = stored(self.docs.mapInArrow(lean(_survey), _SETS), "sets", outlives=1)
        self.sets = survey.where("n is not null").select("doc_id", "n", "h1", "h2")
        self.nodes = self.sets.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"))
        counters = merged_cells(survey.where("chunk is not null"), _ROWS * CELLS, "<u4").reshape(_ROWS, CELLS)
        shared = docs.sparkSession.sparkContext.broadcast(counters)
        self.prefixes = stored(self.docs.select("text").mapInArrow(lean(_prefixes(shared, percent)), _PREFIXES), "prefixes")

    def postings(self) -> DataFrame:
        """``token, node, least`` of tokens in the prefixes of several nodes."""
        group = Window.partitionBy("token")
        rows = self.prefixes.select(F.explode("prefix").alias("token"), F.col("h1").alias("node"))
        rows = rows.withColumn("least", F.min("node").over(group)).withColumn("most", F.max("node").over(group))
        return stored(rows.where("least <> most").select("token", "node", "least").distinct(), "postings")

    def known(self, nodes: DataFrame) -> DataFrame:
        """``h1, n, others`` of the given nodes."""
        return only_ids(self.prefixes.select("h1", "n", "others"), nodes, "h1").dropDuplicates(["h1"])

    def whole(self, nodes: DataFrame) -> DataFrame:
        """``h1, tokens`` of the given nodes, made from their texts again: sets are too large to keep all of them."""
        ids = self.nodes.join(nodes, "h1", "left_semi").select("doc_id")
        return only_ids(self.docs, ids).select("text").mapInArrow(lean(_whole_sets), _SIZED_SETS).dropDuplicates(["h1"])

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` of nodes whose sets reach the threshold."""
        ends = lambda rows: rows.select(F.col("a").alias("h1")).unionByName(rows.select(F.col("b").alias("h1"))).distinct()
        known = self.known(ends(pairs))
        for end in ("a", "b"):
            pairs = pairs.join(known.select(F.col("h1").alias(end), F.col("n").alias(f"n_{end}"), F.col("others").alias(f"others_{end}")), end)
        left = stored(pairs.where(_possible(self.percent)("n_a", "others_a", "n_b", "others_b")).select("a", "b"), "candidates")
        whole = self.whole(ends(left))
        for end in ("a", "b"):
            left = left.join(whole.select(F.col("h1").alias(end), F.col("tokens").alias(f"tokens_{end}")), end)
        return stored(left.where(_similar(self.percent)("tokens_a", "tokens_b")).select("a", "b"), "links")

    def crossing(self, named: DataFrame, members: DataFrame) -> DataFrame:
        """Linked pairs ``a, b`` of components that share a token. Where a token joins few components, the nodes of the smaller one are
        compared with blocks of the larger one inside a task; pairs of nodes are never rows."""
        ends = named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token", "lo")
        mixed = stored(named.join(ends, "token").select("lo", "token", "label").distinct(), "mixed")
        wide = stored(mixed.groupBy("token").count().where(F.col("count") > _LABELS).select("token"), "wide")
        if wide.isEmpty():
            return self.paired(mixed, members)
        return self.paired(mixed.join(wide, "token", "left_anti"), members).unionByName(self.blocked(named.join(wide, "token", "left_semi"))).distinct()

    def rekeyed(self, rows: DataFrame, order: int) -> DataFrame:
        """Rows ``key, node, label, n, early`` keyed again by the prefixes under another order."""
        known = self.known(rows.select(F.col("node").alias("h1")).distinct()).select(F.col("h1").alias("node"), "others")
        rows = rows.join(known, "node").select("key", "node", "label", "n", "early", "others")
        rows = rows.mapInArrow(lean(_keys(self.percent, order)), _KEYED)
        # a token of sixteen bits may come twice in one prefix
        return stored(rows.groupBy("key", "node", "label", "n").agg(F.max("early").alias("early")), "wide-keys")

    def blocked(self, named: DataFrame) -> DataFrame:
        """Links ``a, b`` between components whose nodes share a token of many components. A key is divided by the tokens of another order
        where its nodes are so many that pairs of blocks would repeat each of them more often than it has tokens in its prefix."""
        tokens = named.select("token").distinct()
        early = F.col("at") < F.expr(f"n - (2 * {self.percent} * n + 99 + {self.percent}) div (100 + {self.percent}) + 1")
        places = self.prefixes.select(F.posexplode("prefix").alias("at", "token"), F.col("h1").alias("node"), "n").join(tokens, "token", "left_semi")
        rows = named.join(places.select("token", "node", "n", early.alias("early")).distinct(), ["token", "node"]).withColumnRenamed("token", "key")
        rows = stored(_merged(_pairable(stored(rows.select("key", "node", "label", "n", "early"), "wide-nodes"))), "wide-groups")
        prefixes = F.sum(F.expr(f"n - ({self.percent} * n + 99) div 100 + 1"))
        for order in range(len(_OTHER_ORDERS)):
            sizes = rows.groupBy("key").agg(F.count("*").alias("m"), prefixes.alias("prefixes"))
            many = stored(sizes.where(F.col("m") * F.col("m") > _NODES * F.col("prefixes")).select("key"), "many")
            if many.isEmpty():
                break
            divided = _merged(_pairable(self.rekeyed(rows.join(many, "key", "left_semi"), order)))
            rows = stored(rows.join(many, "key", "left_anti").unionByName(divided), "wide-groups")

        blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / _NODES).cast("int").alias("blocks"))
        rows = rows.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        members = rows.where("early").select("key", F.col("block").alias("i"), every.alias("j"), F.lit(False).alias("query"), "label", "node")
        queries = rows.select("key", every.alias("i"), F.col("block").alias("j"), F.lit(True).alias("query"), "label", "node")
        cells = stored(members.unionByName(queries), "wide-cells")
        order = ["key", "i", "j", "query"]
        arranged = lambda rows: rows.repartition("key", "i", "j").sortWithinPartitions(*order)
        known = self.known(cells.select(F.col("node").alias("h1")).distinct()).withColumnRenamed("h1", "node")
        rows = arranged(cells.join(known, "node").select(*order, "label", "node", "n", "others"))
        left = stored(rows.mapInArrow(lean(_cell_survivors(self.percent)), _CELL), "wide-meetings")
        whole = self.whole(left.select(F.col("node").alias("h1")).distinct()).withColumnRenamed("h1", "node")
        rows = arranged(left.join(whole, "node").select(*order, "label", "tokens"))
        return stored(rows.mapInArrow(lean(_join_cells(self.percent)), "a long, b long").distinct(), "wide-links")

    def paired(self, mixed: DataFrame, members: DataFrame) -> DataFrame:
        """Links ``a, b`` between components that share a token, from pairs of components."""
        sizes = members.groupBy("label").agg(F.count("*").alias("size"))
        parts = mixed.groupBy("lo").agg(F.ceil(F.count("*") / _PART).alias("parts"))
        mixed = mixed.join(parts, "lo").withColumn("part", F.pmod(F.xxhash64("token"), F.col("parts")))
        heads = mixed.select("lo", "part", "label").distinct().join(sizes.where("size = 1"), "label", "left_semi")
        known = self.known(heads.select(F.col("label").alias("h1")).distinct()).withColumnRenamed("h1", "label")
        heads = heads.join(known, "label").select("lo", "part", F.lit(False).alias("is_token"), F.lit(0).cast("long").alias("token"), "label", "n", "others")
        tokens = mixed.select("lo", "part", F.lit(True).alias("is_token"), "token", "label", F.lit(None).cast("long").alias("n"), F.lit(None).cast("array<binary>").alias("others"))
        order = ["lo", "part", "is_token", "token", "label"]
        pairs = heads.unionByName(tokens).repartition("lo", "part").sortWithinPartitions(*order).mapInArrow(lean(_label_pairs(self.percent)), "a long, b long").distinct()
        for end in ("a", "b"):
            pairs = pairs.join(sizes.select(F.col("label").alias(end), F.col("size").alias(f"size_{end}")), end)
        small = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b")))
        pick = lambda one, other: F.when(small, F.col(one)).otherwise(F.col(other))
        blocks = F.ceil(F.greatest("size_a", "size_b") / _BLOCK).cast("int")
        pairs = stored(pairs.select(pick("a", "b").alias("label"), pick("b", "a").alias("target"), blocks.alias("blocks")), "label-pairs")
        order = ["target", "block", "query"]
        place = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        queries = pairs.join(members, "label").select("target", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("query"), "label", "node")
        targets = pairs.select(F.col("target").alias("label"), "blocks").distinct().join(members, "label")
        targets = stored(targets.select(F.col("label").alias("target"), place.alias("block"), F.lit(False).alias("query"), "label", "node"), "targets")

        rows = queries.unionByName(targets)
        known = self.known(rows.select(F.col("node").alias("h1")).distinct()).withColumnRenamed("h1", "node")
        rows = rows.join(known, "node").select(*order, "label", "node", "n", "others").repartition("target", "block").sortWithinPartitions(*order)
        left = stored(rows.mapInArrow(lean(_can_meet(self.percent)), "target long, block int, label long, node long"), "meetings")

        rows = left.select("target", "block", F.lit(True).alias("query"), "label", "node").unionByName(targets.join(left.select("target", "block").distinct(), ["target", "block"], "left_semi").select(*order, "label", "node"))
        whole = self.whole(rows.select(F.col("node").alias("h1")).distinct()).withColumnRenamed("h1", "node")
        rows = rows.join(whole, "node").select(*order, "label", "tokens").repartition("target", "block").sortWithinPartitions(*order)
        return stored(rows.mapInArrow(lean(_meet(self.percent)), "a long, b long").distinct(), "crossing")

    def labels(self) -> DataFrame:
        """``node, label`` of all nodes that share a prefix token with others."""
        spark = self.docs.sparkSession
        with passing_tables(spark):
            postings = self.postings()
            stars = stored(postings.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct(), "stars")
            first = stored(components(self.links(stars)), "labels")
            named = stored(postings.join(first, "node", "left").select("token", "node", F.coalesce("component", "node").alias("label")), "named", outlives=1)
            members = stored(named.select("node", "label").distinct(), "members", outlives=1)
        with passing_tables(spark):
            joined = stored(components(self.crossing(named, members)).toDF("label", "top"), "joined", outlives=1)
        return members.join(joined, "label", "left").select("node", F.coalesce("top", "label").alias("label"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Sets with 100 * intersection >= ``percent`` * union are linked; the component is the smallest doc_id reachable by links. A text without words
    (null, empty, white space) has size 0 and is linked with nothing, so its component is its own doc_id. Rows that repeat a doc_id each get
    the component of their own text. A null doc_id gets a component only through other documents.
    Shingles and sets are compared as 64-bit hashes, equality of sets as 128-bit digests.
    """
    bounded_batches(docs.sparkSession)
    with passing_tables(docs.sparkSession):
        join = _Join(docs, percent)
        labels = stored(join.labels(), "labels", outlives=1)
    classes = join.nodes.join(labels.toDF("h1", "label"), "h1", "left")
    tops = classes.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("top"))
    classes = classes.join(tops, "label", "left").select("h1", "h2", F.coalesce("top", "doc_id").alias("component_id"))
    return join.sets.join(classes, ["h1", "h2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def distinct_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component, in the columns of ``docs``: the one with the smallest id, of rows that repeat it any one, and a row without id only
    where no other row of the component has one. Documents without words stay."""
    rows = stored(docs.withColumn("_llm_row", F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(rows.select(F.col("_llm_row").alias("doc_id"), "text"), percent).select(F.col("doc_id").alias("_llm_row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "_llm_row"))
    keep = rows.select("_llm_row", "doc_id").join(found, "_llm_row").groupBy("component_id").agg(first.alias("first"))
    return rows.join(keep.select(F.col("first._llm_row").alias("_llm_row")), "_llm_row", "left_semi").select(*docs.columns)
