"""Near-duplicate vectors by cross-polytope hashing.

A hash rotates a vector at random (three rounds of random signs and a fast Hadamard transform) and takes the nearest of the
2d signed axes. A table joins k such hashes into a bucket; k grows with the logarithm of the number of vectors, tables and
probes with k. A vector is a member of its own bucket and visits its next best ones as a query. Inside a bucket,
queries meet blocks of members in one matrix product per block, so every candidate pair is verified by its cosine
without becoming a row. A pair that meets several times counts where it meets first, which both ends tell from their codes.
Equal vectors collapse to one before hashing and count as many.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.tables import stored

COSINE = 0.95
#: Members of a bucket that queries are compared with at a time.
_BLOCK = 1024
_QUERIES = 256
_CHOICES = 4


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    rows, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(rows, width // (2 * half), 2, half)
        x = np.concatenate((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(rows, width)
        half *= 2
    return x / math.sqrt(width)


@dataclass
class Hashes:
    """Buckets of vectors in every table; the first probe is the vector's own bucket."""

    hashes: int
    tables: int
    probes: int

    @classmethod
    def for_count(cls, vectors: int, width: int) -> Hashes:
        axes = 2 * (1 << max(0, (width - 1).bit_length()))
        most = int(62 / math.log2(axes))
        hashes = min(most, max(1, math.ceil(math.log(max(vectors, 2) / 64) / math.log(axes))))
        return cls(hashes, 2 + 2 * hashes, min(2**hashes, 64))

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """Array (vectors, tables, probes) of bucket codes of unit vectors."""
        count, width = unit.shape
        padded = np.zeros((count, 1 << max(0, (width - 1).bit_length())))
        padded[:, :width] = unit
        axes = padded.shape[1]
        choices = min(_CHOICES, axes)
        combos = sorted(itertools.product(range(choices), repeat=self.hashes), key=lambda c: (sum(c), c))[: 8 * self.probes]
        out = np.zeros((count, self.tables, self.probes), dtype=np.int64)
        for table in range(self.tables):
            loss, code = np.zeros((count, len(combos))), np.zeros((count, len(combos)), dtype=np.int64)
            for i in range(self.hashes):
                signs = np.random.default_rng([axes, table, i]).choice([-1.0, 1.0], (3, axes))
                turned = padded
                for round_signs in signs:
                    turned = hadamard(turned * round_signs)
                size = np.abs(turned)
                best = np.argsort(-size, axis=1, kind="stable")[:, :choices]
                axis = 2 * best + (np.take_along_axis(turned, best, axis=1) > 0)
                size = np.take_along_axis(size, best, axis=1)
                pick = [c[i] for c in combos]
                loss += ((size[:, :1] - size) ** 2)[:, pick]
                code += axis[:, pick] * (2 * axes) ** i
            order = np.argsort(loss, axis=1, kind="stable")[:, : self.probes]
            found = np.take_along_axis(code, order, axis=1)
            out[:, table] = np.pad(found, ((0, 0), (0, self.probes - found.shape[1])), mode="edge")
        return out


def _units(column: pa.Array, kind: str, width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, width).astype(np.float64)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _usable(kind: str):
    """Vectors that can link, as bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, widths = [], [], []
            for id_, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if id_ is None or not values.is_valid or not len(values.values) or values.values.null_count:
                    continue
                vector = values.values.to_numpy().astype(kind)
                norm = np.linalg.norm(vector.astype(np.float64))
                if np.isfinite(norm) and norm > 0:
                    ids.append(id_)
                    rows.append(vector.tobytes())
                    widths.append(len(vector))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(widths, pa.int32()), pa.array(rows, pa.binary())], names=["vec_id", "width", "vector"])

    return scan


def _visits(kind: str, shapes: dict[int, Hashes]):
    """Rows ``node, size, width, vector, table, bucket, member``: every bucket that a vector belongs to or visits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(2).to_numpy()
            for width in np.unique(widths).tolist():
                rows = batch.filter(pa.array(widths == width))
                for start in range(0, len(rows), 500):
                    part = rows.slice(start, 500)
                    codes = shapes[width].buckets(_units(part.column(3), kind, width))
                    count, tables, probes = codes.shape
                    at = np.repeat(np.arange(count), tables * probes)
                    table = np.tile(np.repeat(np.arange(tables), probes), count)
                    member = np.tile(np.arange(probes) == 0, count * tables)
                    keep = np.flatnonzero(member | (codes != codes[:, :, :1]).reshape(-1))
                    taken = part.take(pa.array(at[keep]))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(table[keep].astype(np.int32)), pa.array(codes.reshape(-1)[keep]), pa.array(member[keep])], names=["node", "size", "width", "vector", "table", "bucket", "member"])

    return scan


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one comparison as stars: each node with the smallest one it reaches."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


_FOUND = "node long, links long, other long"


def _compare(kind: str, shapes: dict[int, Hashes], cosine: float):
    """Rows ``table, width, bucket, block, query, node, size, member, vector`` come sorted: members of a block, then queries against it.

    Gives ``(node, links)`` counts, weighted by copies, and ``(node, other)`` links that keep components together.
    """

    def batch_of(nodes, links=None, others=None) -> pa.RecordBatch:
        empty = pa.nulls(len(nodes), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(links, pa.int64()) if links is not None else empty, pa.array(others, pa.int64()) if others is not None else empty], names=["node", "links", "other"])

    class Group:
        def __init__(self, key: tuple):
            self.key, self.rows, self.ready = key, [], False

        def close(self) -> None:
            """All members are there."""
            self.node, self.size, self.unit, self.codes = (np.concatenate([r[k] for r in self.rows]) for k in range(4))
            self.links = np.zeros(len(self.node), dtype=np.int64)
            self.ready = True

        def meet(self, node: np.ndarray, size: np.ndarray, unit: np.ndarray, codes: np.ndarray, member: np.ndarray) -> Iterator[pa.RecordBatch]:
            table = self.key[0]
            q, m = np.nonzero(unit @ self.unit.T >= cosine)
            one, two = node[q], self.node[m]
            own = np.where(member[q], one > two, (two < one) | ~(self.codes[m, table] == codes[q, table, :1]).any(axis=1))
            q, m = q[own & (one != two)], m[own & (one != two)]
            for earlier in range(table):
                met = (codes[q, earlier] == self.codes[m, earlier, :1]).any(axis=1) | (self.codes[m, earlier] == codes[q, earlier, :1]).any(axis=1)
                q, m = q[~met], m[~met]
            if len(q):
                self.links += np.bincount(m, size[q], len(self.node)).astype(np.int64)
                seen = np.unique(q)
                yield batch_of(node[seen], np.bincount(q, self.size[m], len(node))[seen].astype(np.int64))
                child, parent = _stars(node[q], self.node[m])
                yield batch_of(child, others=parent)

        def end(self) -> Iterator[pa.RecordBatch]:
            if self.ready and self.links.any():
                yield batch_of(self.node[self.links > 0], self.links[self.links > 0])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: Group | None = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)
            query, node, size, member = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4, 8))
            place, hashed = np.zeros(len(batch), dtype=np.int64), {}
            for width in np.unique(keys[:, 1]).tolist():
                at = np.flatnonzero(keys[:, 1] == width)
                place[at] = np.arange(len(at))
                unit = _units(batch.column(8).take(pa.array(at)), kind, width)
                hashed[width] = unit, shapes[width].buckets(unit)
            change = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1) | (query[1:] != query[:-1]))))
            for a, b in zip(change.tolist(), [*change[1:].tolist(), len(batch)], strict=True):
                if b <= a:
                    continue
                key = tuple(keys[a].tolist())
                if group is None or group.key != key:
                    if group:
                        yield from group.end()
                    group = Group(key)
                unit, codes = hashed[key[1]]
                for i in range(a, b, _QUERIES):
                    j = min(b, i + _QUERIES)
                    rows = node[i:j], size[i:j], unit[place[i] : place[i] + j - i], codes[place[i] : place[i] + j - i]
                    if not query[a]:
                        group.rows.append(rows)
                    elif group.rows and not (len(group.rows) == 1 and len(group.rows[0][0]) == 1 == j - i and node[i] == group.rows[0][0][0]):
                        if not group.ready:
                            group.close()
                        yield from group.meet(*rows, member[i:j])
        if group:
            yield from group.end()

    return scan


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without vec_id, link with nothing: no links, a component
    of their own. Vectors of different length never link. Rows that repeat a vec_id with another vector share one vertex.
    """
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    values = F.col("embedding") if element == "float" else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("embedding"))
    usable = stored(rows.mapInArrow(_usable(kind), "vec_id long, width int, vector binary"), "vectors")
    classes = stored(usable.groupBy("width", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("size")), "classes")
    shapes = {row.width: Hashes.for_count(row["count"], row.width) for row in classes.groupBy("width").count().collect()}

    visits = stored(classes.select("node", "size", "width", "vector").mapInArrow(_visits(kind, shapes), "node long, size long, width int, vector binary, table int, bucket long, member boolean"), "visits")
    place = ["table", "width", "bucket"]
    blocks = visits.where("member").groupBy(*place).agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks"))
    placed = visits.join(blocks, place)
    members = placed.where("member").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("query", F.lit(False))
    queries = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("query", F.lit(True))
    columns = [*place, "block", "query", "node", "size", "member", "vector"]
    meeting = members.select(columns).unionByName(queries.select(columns)).repartition(*place, "block").sortWithinPartitions(*place, "block", "query", "node")
    found = stored(meeting.mapInArrow(_compare(kind, shapes, cosine), _FOUND), "found")

    links = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.where("other is not null").select("node", "other")).toDF("node", "top")
    classes = classes.join(links, "node", "left").join(joined, "node", "left")
    classes = classes.select("width", "vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("top", "node").alias("component"))
    # copies of one vector may be many: they take the figures of their class in a join that can be split
    known = usable.join(classes, ["width", "vector"]).select("vec_id", "n_links", "component").distinct()
    out = rows.select("vec_id").join(known, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
