"""Global row positions without a single-partition window.

``row_number() over (order by ...)`` and ``ntile(k) over (order by ...)`` pull all rows into
one task. Here the rows are range partitioned on the whole sort key - which ends in a unique
column, so a run of equal values is spread as well - numbered inside their partition, and
shifted by the size of the partitions before them. Only those sizes, one row per partition,
meet in one place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialize

# monotonically_increasing_id keeps the partition above bit 33 and the row index below it.
_ROW_BITS = 33


def _ordering(order: list[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def with_position(
    df: DataFrame,
    order: list[str | Column],
    name: str,
    total: str | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Add the 1-based rank in ``order``, which must be unique, and optionally the row count.

    The sorted rows are written once to the shared folder with ``keep``: their numbering has to
    stay the same for both passes, whatever executor is lost in between.
    """
    keys = _ordering(order)
    ranked = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranked = keep(ranked.withColumn("_slot", F.monotonically_increasing_id()), "positions")

    part = F.shiftright("_slot", _ROW_BITS)
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = ranked.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(everywhere).alias("_total"),
    )
    # One row per shuffle partition: bounded by the partition count, not by the data.
    joined = ranked.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    extra = [F.col("_total").alias(total)] if total else []
    return joined.select(*df.columns, (F.col("_offset") + row + 1).alias(name), *extra)


def tile_of(position: Column, total: Column, tiles: int) -> Column:
    """Tile number of a 1-based position, as the window function ``ntile`` assigns it."""
    small = F.floor(total / tiles)
    larger = total % tiles
    head = larger * (small + 1)
    in_head = F.floor((position - 1) / (small + 1)) + 1
    in_tail = larger + F.floor((position - 1 - head) / F.nullif(small, F.lit(0))) + 1
    return F.when(position <= head, in_head).otherwise(in_tail).cast("int")


def with_ntile(df: DataFrame, tiles: int, order: list[str | Column], name: str) -> DataFrame:
    """Add the tile (1..``tiles``) of every row in the global ``order``, which must be unique."""
    ranked = with_position(df, order, "_position", "_rows")
    return ranked.withColumn(name, tile_of(F.col("_position"), F.col("_rows"), tiles)).drop("_position", "_rows")


def with_ntiles(df: DataFrame, tiles: int, key: str, orders: dict[str, str | Column]) -> DataFrame:
    """Add one tile (1..``tiles``) per entry of ``orders``, name to measure, each in the global order of measure and ``key``.

    All measures are ranked in one sort, with the measure as leading range key: it has as many ranks as there are rows, so a rank
    tells its measure's own. The ranks come back to their rows by ``key``, which is unique and not null.
    """
    names = list(orders)
    held = materialize(df.withColumns({f"_by{i}": _ordering([o])[0] for i, o in enumerate(orders.values())}), "tiled")
    # every measure keeps its type: a ranked row holds its own measure, the others are null
    turns = F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("_measure")
    stacked = held.select(key, turns, *[f"_by{i}" for i in range(len(names))])
    own = {f"_by{i}": F.when(F.col("_measure") == i, F.col(f"_by{i}")) for i in range(len(names))}
    ranked = with_position(stacked.withColumns(own), ["_measure", *own, key], "_position", "_rows")
    rows = F.floor(F.col("_rows") / len(names))
    ranked = ranked.withColumn("_tile", tile_of(F.col("_position") - F.col("_measure") * rows, rows, tiles))
    tiled = ranked.groupBy(key).agg(*[F.max(F.when(F.col("_measure") == i, F.col("_tile"))).alias(name) for i, name in enumerate(names)])
    return held.drop(*own).join(tiled, key)


def with_surrogate_key(
    df: DataFrame,
    key: str,
    order: list[str | Column],
    start: int = 0,
    keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Put dense keys ``start + 1``, ``start + 2``, ... in front, assigned in ``order``."""
    ranked = with_position(df, order, key, keep=keep)
    return ranked.select((F.col(key) + F.lit(start)).cast("bigint").alias(key), *df.columns)
