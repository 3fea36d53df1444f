"""Idempotent merges into stored tables.

* Dimensions: a row whose natural key is stored is ignored, so keys and attributes never
  change; new rows are appended and nothing stored is rewritten.
* Facts: a row whose natural key is stored changes the listed measures only; foreign keys and
  the creation time stay. Only parts whose key filter admits a key of the load are read, and only periods in which a measure really
  changes are rewritten; new rows are added beside the stored ones. A fact without stored rows takes the load as it comes, with no
  copy in between.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starloom.operators.dedup import keep_first, keep_last
from starloom.operators.positions import with_surrogate_key
from starloom.operators.snapshot import Draft
from starloom.schemas import POS, WAREHOUSE, TableSpec

log = logging.getLogger(__name__)

SUB_POS = "_sub_pos"


@dataclass(frozen=True)
class MergeCount:
    """Rows offered by the load and what became of them."""

    offered: int = 0
    inserted: int = 0
    updated: int = 0


def ordering(df: DataFrame) -> list[str]:
    """The columns that give the arrival order of ``df``."""
    return [c for c in (POS, SUB_POS) if c in df.columns]


def unseen(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """First arriving row of every natural key that is not stored yet."""
    first = keep_first(incoming, keys, F.struct(*ordering(incoming)))
    return first.join(existing.select(*keys), keys, "left_anti")


def combined(existing: DataFrame, incoming: DataFrame, spec: TableSpec, next_key: int) -> DataFrame:
    """Stored rows with changed measures, plus the rows with a new natural key.

    ``incoming`` has one row per natural key. New rows get unique, increasing but not
    gap-free keys, which costs no sort.
    """
    old = existing.withColumn("_old", F.lit(True)).alias("old")
    new = incoming.withColumn("_new", F.lit(True)).alias("new")
    match = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in spec.natural_key]
    both = old.join(new, match, "full_outer")
    is_old, is_new = F.col("old._old").isNotNull(), F.col("new._new").isNotNull()

    def pick(name: str) -> Column:
        if name == spec.key:
            return F.coalesce(F.col(f"old.{name}"), F.monotonically_increasing_id() + next_key)
        if name == "created_at":
            return F.coalesce(F.col("old.created_at"), F.current_timestamp())
        if name in spec.update_columns:
            return F.when(is_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        return F.when(is_old, F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))

    return both.select(*[pick(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])


def merge_dimension(draft: Draft, table: str, incoming: DataFrame) -> MergeCount:
    """Append the unseen rows of ``incoming`` to a dimension with the next dense keys."""
    spec = WAREHOUSE[table]
    staged = draft.scratch.keep(incoming, table)
    offered = staged.count()
    if offered == 0:
        log.warning("%s: nothing to load", table)
        return MergeCount()
    existing = draft.read(table)
    fresh = unseen(existing, staged, list(spec.natural_key))
    if spec.key not in spec.natural_key:
        attributes = [f.name for f in spec.schema.fields if f.name not in (spec.key, "created_at")]
        fresh = fresh.select(*attributes, *ordering(fresh))
        fresh = with_surrogate_key(fresh, spec.key, ordering(fresh), draft.last_key(table), draft.scratch.keep)
        fresh = fresh.withColumn("created_at", F.current_timestamp())
    fresh = fresh.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema.fields])
    return MergeCount(offered, draft.append(table, fresh))


def _first_load(draft: Draft, table: str, last: DataFrame, columns: list[str]) -> MergeCount:
    """Store one row per natural key in a fact that holds none; the rows offered are counted on their way.

    Rows leave the aggregate sorted by their key, so a task that runs again gives each row the same surrogate key.
    """
    spec = WAREHOUSE[table]
    seen = Observation()
    rows = last.observe(seen, F.sum("_copies").alias("offered")).select(*columns)
    draft.replace_periods(table, combined(draft.read(table), rows, spec, draft.last_key(table) + 1), [])
    if not draft.holds(table):
        log.warning("%s: nothing to load", table)
        return MergeCount()
    return MergeCount(seen.get["offered"], sum(n for entry in draft.entries(table) for n in entry["rows"].values()))


def merge_fact(draft: Draft, table: str, incoming: DataFrame) -> MergeCount:
    """Merge ``incoming`` into a fact; of several rows with one natural key the last wins."""
    spec = WAREHOUSE[table]
    keys = list(spec.natural_key)
    columns = [f.name for f in spec.schema.fields if f.name not in (spec.key, "created_at")]
    last = keep_last(incoming.select(*columns, POS), keys, POS, copies="_copies")
    if not draft.holds(table):
        return _first_load(draft, table, last, columns)
    staged = draft.scratch.keep(last, table)
    offered, distinct = staged.agg(F.sum("_copies"), F.count(F.lit(1))).first()
    if distinct == 0:
        log.warning("%s: nothing to load", table)
        return MergeCount()
    staged = staged.select(*columns)

    matched = staged.limit(0).select(*keys)
    periods: dict[int, tuple[int, int]] = {}
    holding = draft.may_hold(table, staged)
    if holding:
        # Stored rows the load meets again, and whether a measure differs: at most one result row per calendar period.
        differs = F.lit(False)
        for column in spec.update_columns:
            differs = differs | ~F.col(f"old.{column}").eqNullSafe(F.col(f"new.{column}").cast(spec.schema[column].dataType))
        old = draft.read(table, parts=holding).withColumn("_period", draft.period()).alias("old")
        both = old.join(staged.alias("new"), [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys])
        matched = draft.scratch.keep(both.select(*[F.col(f"old.{k}").alias(k) for k in keys], F.col("old._period").alias("period"), differs.alias("changed")), f"{table}_matched")
        counts = matched.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.count_if("changed").alias("changed"))
        periods = {r["period"]: (r["n"], r["changed"]) for r in counts.collect()}
    updated = sum(n for n, _ in periods.values())
    replaced = sorted(period for period, (_, changed) in periods.items() if changed)
    if replaced or updated < distinct:
        settled = matched.filter(~F.col("period").isin(replaced)).select(*keys) if periods else matched
        fresh = staged.join(settled, keys, "left_anti").select(*columns)
        draft.replace_periods(table, combined(draft.read(table, periods=replaced), fresh, spec, draft.last_key(table) + 1), replaced)
    return MergeCount(offered, distinct - updated, updated)
