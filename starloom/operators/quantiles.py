"""Exact quantiles and the describe table without gathering the values in one task.

The built-in exact ``percentile`` keeps every distinct value of a group in one buffer. Here
values are counted first, the distinct values are range partitioned, and only the few rows
that hold a wanted rank leave the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialize

QUARTILES = (0.25, 0.5, 0.75)


def running_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per measure: distinct non-null values, the rows before each, and those up to it.

    All columns are ranked together, with the measure as leading sort key.
    """
    stacked = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "measure", "value")
    counted = stacked.filter("value is not null").groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.repartitionByRange("measure", "value").sortWithinPartitions("measure", "value")
    stored = materialize(ordered.withColumn("_slot", F.monotonically_increasing_id()), "ranks")
    stored = stored.withColumn("_part", F.shiftright("_slot", 33))
    sizes = stored.groupBy("measure", "_part").agg(F.sum("n").alias("_size"))
    earlier = Window.partitionBy("measure").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition and measure, whatever the data.
    offsets = sizes.select("measure", "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part", "measure").orderBy("_slot")
    upto = F.col("_offset") + F.sum("n").over(inside)
    joined = stored.join(F.broadcast(offsets), ["measure", "_part"]).withColumn("upto", upto)
    return joined.select("measure", "value", (F.col("upto") - F.col("n")).alias("before"), "upto")


def quantiles(
    df: DataFrame, columns: list[str], probabilities: tuple[float, ...] = QUARTILES
) -> dict[str, list[float | None]]:
    """Quantiles of each column with linear interpolation between neighbouring values."""
    ranks = running_counts(df, columns)
    totals = {r["measure"]: r["total"] for r in ranks.groupBy("measure").agg(F.max("upto").alias("total")).collect()}
    places = {c: [(totals[c] - 1) * p for p in probabilities] for c in totals}
    wanted = {c: sorted({r for h in hs for r in (math.floor(h), math.ceil(h))}) for c, hs in places.items()}
    if not wanted:
        return {c: [None] * len(probabilities) for c in columns}
    hits = F.array(
        *[
            F.when((F.col("measure") == c) & (F.col("before") <= r) & (F.col("upto") > r), F.lit(r).cast("bigint"))
            for c, ranks_of in wanted.items()
            for r in ranks_of
        ]
    )
    # Two rows per quantile and column at most.
    found = ranks.select("measure", "value", F.explode(F.array_compact(hits)).alias("rank")).collect()
    at = {(row["measure"], row["rank"]): row["value"] for row in found}

    def between(c: str, h: float) -> float:
        low, high = at[c, math.floor(h)], at[c, math.ceil(h)]
        return low + (high - low) * (h - math.floor(h))

    return {c: [between(c, h) for h in places[c]] if c in places else [None] * len(probabilities) for c in columns}


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std (sample), min, quartiles and max of numeric columns, one row per column.

    The input is stored once, as the quantiles and the other figures each read it.
    """
    stored = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "describe")
    quartiles = quantiles(stored, columns)
    figures = []
    results = []
    for name in columns:
        measures = {
            "count": F.count(name),
            "mean": F.avg(name),
            "std": F.stddev_samp(name),
            "min": F.min(name),
            "max": F.max(name),
        }
        figures += [m.alias(f"{name}.{label}") for label, m in measures.items()]
        at = {label: F.col(f"`{name}.{label}`").alias(label) for label in measures}
        q = [F.lit(v).cast("double").alias(f"q{int(p * 100)}") for p, v in zip(QUARTILES, quartiles[name])]
        results.append(F.struct(F.lit(name).alias("measure"), at["count"], at["mean"], at["std"], at["min"], *q, at["max"]))
    return stored.agg(*figures).select(F.inline(F.array(*results)))
