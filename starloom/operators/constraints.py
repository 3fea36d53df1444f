"""Constraints a database would enforce, measured on stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.dedup import repeated_groups
from starloom.schemas import WAREHOUSE


def orphan_rows(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Key values without a dimension row and how many fact rows carry them; null is an orphan.

    Fact rows are counted per key before the join, so a hot key is one row in it.
    """
    counted = fact.groupBy(key).agg(F.count(F.lit(1)).alias("orphans"))
    return counted.join(dimension.select(key), key, "left_anti")


def _labelled(table: str, kind: str, measures: dict[str, Column], frame: DataFrame) -> DataFrame:
    """One aggregate pass, one result row per measure."""
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(kind).alias("constraint_kind"),
            F.lit(name).alias("column_name"),
            F.col(f"m{i}").cast("bigint").alias("violations"),
        )
        for i, name in enumerate(measures)
    ]
    one = frame.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures.values())])
    return one.select(F.inline(F.array(*rows)))


def not_null_violations(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        _labelled(name, "not_null", {c: F.count_if(F.col(c).isNull()) for c in WAREHOUSE[name].required}, df)
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def unique_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Natural keys that occur more than once."""
    parts = []
    for name, df in tables.items():
        keys = list(WAREHOUSE[name].natural_key)
        parts.append(_labelled(name, "unique", {", ".join(keys): F.count(F.lit(1))}, repeated_groups(df, keys)))
    return reduce(DataFrame.unionByName, parts)


def foreign_key_violations(tables: dict[str, DataFrame], dimensions: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows whose key is in no row of its dimension, looked up in ``dimensions`` where the tables hold new rows only."""
    parts = []
    for name, df in tables.items():
        for key, dimension in WAREHOUSE[name].foreign_keys.items():
            orphans = orphan_rows(df, (dimensions or tables)[dimension], key)
            parts.append(_labelled(name, "foreign_key", {key: F.coalesce(F.sum("orphans"), F.lit(0))}, orphans))
    return reduce(DataFrame.unionByName, parts)


def check_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Values outside a declared range and texts longer than declared; null passes."""
    parts = []
    for name, df in tables.items():
        spec = WAREHOUSE[name]
        measures = {f"{c} range": F.count_if(~F.col(c).between(*bounds)) for c, bounds in spec.ranges.items()}
        measures |= {f"{c} length": F.count_if(F.length(c) > n) for c, n in spec.lengths.items()}
        parts.append(_labelled(name, "check", measures, df))
    return reduce(DataFrame.unionByName, parts)


class ConstraintError(ValueError):
    """Raised when stored rows break a declared constraint."""


def enforce(tables: dict[str, DataFrame], dimensions: dict[str, DataFrame] | None = None, met: dict[str, int] | None = None) -> None:
    """Raise with every broken constraint of the given tables.

    For a load's new rows, ``dimensions`` are the whole dimensions they refer to, and ``met`` tells how many natural keys of
    new rows are stored already.
    """
    kinds = (not_null_violations, unique_violations, lambda t: foreign_key_violations(t, dimensions), check_violations)
    report = reduce(DataFrame.unionByName, [kind(tables) for kind in kinds])
    counts = {(r["table_name"], r["constraint_kind"], r["column_name"]): r["violations"] for r in report.collect()}  # one row per declared constraint
    for table, n in (met or {}).items():
        counts[(table, "unique", ", ".join(WAREHOUSE[table].natural_key))] += n
    broken = {constraint: n for constraint, n in counts.items() if n}
    if broken:
        raise ConstraintError("\n".join(f"{table} {kind} ({column}): {n}" for (table, kind, column), n in broken.items()))
