"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target of words and a schedule: its rate of words at training time t in [0, 1] is proportional to
1 + drift * (2 t - 1), so a positive drift brings it late and a negative one early. The integral of the rate up to t
is the source's cumulative demand. Its documents stand in a fixed random order, repeated as often as the target asks; the word
position of a copy on that line, put into the inverse of the demand, is its training position, and all copies are range
sorted by position. Running sums come from a range partitioned order: totals of each partition first, then sums inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.tables import stored

WEIGHTS = (5, 2, 1)
DRIFTS = (-0.5, 0.0, 0.5)
MAX_COPIES = 3

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, weight, drift, target`` per source of ``sizes`` (source, size).

    Sources by code point, null last, weigh ``weights`` in turn and share all words; none gets more than ``max_copies``
    times its size. Sorted by size per weight, the sources that reach their limit come first, so the level at which the
    others share the rest is read off running sums. The windows run over one row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (turn % len(values) + 1).cast("int"))
    sources = sources.withColumn("turn", turn).withColumn("weight", pick(weights).cast("long")).withColumn("drift", pick(DRIFTS)).withColumn("limit", F.col("source_size") * max_copies)

    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "turn")
    before = F.coalesce(F.sum("limit").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    waiting = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    sources = sources.withColumn("total", total).withColumn("full", (F.col("total") - before) * F.col("weight") >= F.col("limit") * waiting)
    spent = F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    sources = sources.withColumn("spent", spent).withColumn("open_weight", open_weight)
    share = (F.col("total") - F.col("spent")) * F.col("weight") / F.col("open_weight")
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share)
    return sources.select("source", "source_size", "weight", "drift", target.alias("target"))


def _position(at: Column, drift: Column) -> Column:
    """Time t at which (1 - drift) t + drift t^2, the share of the source's demand up to t, equals ``at``."""
    rest = 1 - drift
    return 2 * at / (rest + F.sqrt(rest * rest + 4 * drift * at))


def curriculum(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``sizes`` (row, doc_id, source, size; stored) with ``source_size, target, copies, positions``.

    A copy is taken if its middle word lies before the target, so a source misses its target by half a document at most.
    Documents without words get no copy. Rows that repeat a doc_id are documents of their own.
    """
    keys = [F.col("source").isNull(), F.col("source"), F.md5(F.col("doc_id").cast("string")), F.col("doc_id"), F.col("size"), F.col("row")]
    line = stored(sizes.repartitionByRange(*keys).select("*", F.spark_partition_id().alias("part")), "line")
    parts = line.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("source", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("offset"))
    goals = targets(line, weights, max_copies)
    parts = parts.join(goals, parts["source"].eqNullSafe(goals["source"])).drop(goals["source"])

    # a part is a range partition: its size is bounded whatever the source's
    within = Window.partitionBy("part", "source").orderBy(*keys[2:]).rowsBetween(Window.unboundedPreceding, 0)
    line = line.withColumn("inside", F.sum("size").over(within) - F.col("size"))
    parts = parts.withColumnRenamed("source", "part_source").withColumnRenamed("part", "part_id")
    line = line.join(parts, (F.col("part") == F.col("part_id")) & F.col("source").eqNullSafe(F.col("part_source")))
    start = F.col("offset") + F.col("inside")
    starts = F.transform(F.sequence(F.lit(0), F.lit(max_copies - 1)), lambda turn: start + turn * F.col("source_size"))
    taken = F.filter(starts, lambda x: (F.col("size") > 0) & (2 * x + F.col("size") <= 2 * F.col("target")))
    middle = lambda x: F.least((x + F.col("size") / 2) / F.col("target"), F.lit(1.0))
    return line.select(
        "row", "doc_id", "source", "size", "source_size", "target",
        F.size(taken).cast("long").alias("copies"),
        F.transform(taken, lambda x: _position(middle(x), F.col("drift"))).alias("positions"),
    )


def _sizes(docs: DataFrame, row: Column) -> DataFrame:
    return docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size"))


def mix_plan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: size, its source's size and target, words taken, and the first training position (null if not taken).

    A null text has size 0. Without rows the result is empty.
    """
    plan = curriculum(stored(_sizes(docs, F.monotonically_increasing_id()), "sizes"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), F.get("positions", F.lit(0)).alias("first_position"))


def mixed(docs: DataFrame) -> DataFrame:
    """The taken copies in the columns of ``docs``, range sorted by training position; a document taken twice is two rows."""
    rows = stored(docs.withColumn("_llm_row", F.monotonically_increasing_id()), "rows")
    plan = curriculum(stored(_sizes(rows, F.col("_llm_row")), "sizes"))
    copies = plan.where("copies > 0").select(F.col("row").alias("_llm_row"), F.explode("positions").alias("_llm_position"))
    copies = stored(copies, "copies")  # its true size decides how it meets the texts
    order = ["_llm_position", "_llm_row"]
    return rows.join(copies, "_llm_row").repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
