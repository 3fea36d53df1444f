"""Connected components of a graph given as links, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import stored
from starloom.llm.words import lean

_STARS = "child long, parent long"


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of links as stars: every node points to the smallest one it reaches inside the batch."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int, parent: dict[int, int] = parent) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        rows = [(x, root(x)) for x in list(parent)]
        rows = [(x, top) for x, top in rows if x != top]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.int64())], names=["child", "parent"])


def _round(stars: DataFrame) -> DataFrame:
    """Large star, then small star. Both take the minimum per node first, so a node with very many links is one
    row after the map side, and the joins that follow can be split."""
    both = stars.select(F.col("child").alias("u"), F.col("parent").alias("v")).unionByName(stars.select(F.col("parent").alias("u"), F.col("child").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("child"), F.col("m").alias("parent")).distinct()
    least = large.groupBy("child").agg(F.min("parent").alias("m"))
    small = large.join(least, "child").where("parent <> m").select(F.col("parent").alias("child"), F.col("m").alias("parent"))
    return small.unionByName(least.select("child", F.col("m").alias("parent"))).distinct()


def _finished(stars: DataFrame) -> bool:
    """Every child has one parent and no parent is a child."""
    ends = stars.select(F.col("child").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs")).unionByName(
        stars.select(F.col("parent").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("downs"))
    )
    return ends.groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs")).where("ups > 1 or ups = 1 and downs = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (two columns of 64-bit ids): the smallest node it reaches, itself included.

    Loops and repeated links are harmless; links with a null end are ignored.
    """
    a, b = links.columns
    links = links.select(F.col(a).cast("long"), F.col(b).cast("long")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    nodes = links.where(F.col(a) == F.col(b)).select(F.col(a).alias("node"))
    stars = stored(links.mapInArrow(lean(_forest), _STARS).distinct(), "stars")
    while not _finished(stars):
        stars = stored(_round(stars), "stars")
    found = stars.select(F.col("child").alias("node"), F.col("parent").alias("component"))
    roots = stars.select(F.col("parent").alias("node")).unionByName(nodes).distinct().join(found, "node", "left_anti")
    return found.unionByName(roots.select("node", F.col("node").alias("component")))
