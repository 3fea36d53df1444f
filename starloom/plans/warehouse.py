"""Transform, load and the gated pipeline."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import constraints
from starloom.operators.merge import MergeCount, merge_dimension, merge_fact, ordering
from starloom.operators.positions import with_surrogate_key
from starloom.operators.snapshot import Draft, Store
from starloom.plans import dimensions, facts
from starloom.plans.quality import CheckSettings, run_gate
from starloom.schemas import DIMENSIONS, FACTS, POS, WAREHOUSE
from starloom.sources import dates, seeds

KEYED = {"customer": "dim_customer", "product": "dim_product", "seller": "dim_seller", "payment": "dim_payment"}


def key_maps(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Natural key to surrogate key, for each keyed dimension."""
    return {short: tables[t].select(WAREHOUSE[t].natural_key[0], WAREHOUSE[t].key) for short, t in KEYED.items()}


def build_dimensions(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_customer": dimensions.dim_customer(raw["customers"]),
        "dim_product": dimensions.dim_product(raw["products"], raw["category_translation"]),
        "dim_seller": dimensions.dim_seller(raw["sellers"]),
        "dim_payment": dimensions.dim_payment(raw["payments"]),
    }


def build_facts(raw: dict[str, DataFrame], delivered: DataFrame, keys: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "fact_sales": facts.fact_sales(raw, delivered, keys),
        "fact_payments": facts.fact_payments(raw, delivered, keys),
        "fact_order_experience": facts.fact_order_experience(raw, delivered),
    }


def transform(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four keyed dimensions and three facts of one batch, keys counted from 1 in file order.

    The payment type, by which a load finds the stored key, is no column of the payment fact.
    """
    dims = {
        name: with_surrogate_key(df, WAREHOUSE[name].key, ordering(df)) for name, df in build_dimensions(raw).items()
    }
    keys = key_maps(dims)
    built = build_facts(raw, facts.delivered_orders(raw, keys["customer"]), keys)
    return dims | built | {"fact_payments": built["fact_payments"].drop("payment_type")}


def _together(work: Callable[[str, DataFrame], MergeCount], frames: dict[str, DataFrame]) -> dict[str, MergeCount]:
    """Run independent merges side by side, so short stages of one fill the gaps of another."""
    with ThreadPoolExecutor(len(frames)) as pool:
        running = {name: pool.submit(work, name, df) for name, df in frames.items()}
        return {name: job.result() for name, job in running.items()}


def seed(draft: Draft, days: DataFrame) -> dict[str, MergeCount]:
    """Rows that exist before any file is read: payment types and the calendar."""
    calendar_rows = dimensions.dim_date(days)
    frames = {
        "dim_payment": seeds.payment_types(draft.store.spark),
        "dim_date": calendar_rows.withColumn(POS, calendar_rows["date_key"]),
    }
    return _together(lambda name, df: merge_dimension(draft, name, df), frames)


def load(draft: Draft, raw: dict[str, DataFrame]) -> dict[str, MergeCount]:
    """Merge one batch: dimensions first, then the facts with the keys now stored."""
    counts = _together(lambda name, df: merge_dimension(draft, name, df), build_dimensions(raw))
    keys = key_maps({t: draft.read(t) for t in DIMENSIONS})
    # Shared by the three facts: two joins on the customer ids are done once.
    delivered = draft.scratch.keep(facts.delivered_orders(raw, keys["customer"]), "delivered")
    return counts | _together(lambda name, df: merge_fact(draft, name, df), build_facts(raw, delivered, keys))


def publishable(tables: dict[str, DataFrame], settings: CheckSettings = CheckSettings()) -> None:
    """Raise unless the tables keep every declared constraint and pass every check."""
    constraints.enforce(tables)
    run_gate(tables, settings)


def settings_for(days: DataFrame) -> CheckSettings:
    """Check settings whose calendar is that of the given days."""
    first, last = days.agg(F.min("full_date").cast("string"), F.max("full_date").cast("string")).first()
    return CheckSettings(start=first, end=last)


def _met_keys(draft: Draft, table: str, new: DataFrame) -> int:
    """Natural keys of new rows that older folders hold too. Of a fact, only parts whose filter admits one are read."""
    keys = list(WAREHOUSE[table].natural_key)
    if table in FACTS:
        parts = draft.may_hold(table, new, stored_only=True)
        return new.join(draft.read(table, parts=parts).select(*keys), keys, "left_semi").count() if parts else 0
    return new.join(draft.earlier(table).select(*keys), keys, "left_semi").count() if draft.stored.get(table) else 0


def publishable_draft(draft: Draft, settings: CheckSettings) -> str:
    """Raise unless what the draft would publish keeps every constraint and passes every check; tells what was judged.

    Where the version below passed the same checks, its rows have no fault, and a load adds rows or replaces whole parts by rows of its own.
    Then only rows the draft has written are judged: among themselves, against the keys stored before, and against the whole dimensions.
    """
    whole = {t: draft.read(t) for t in WAREHOUSE}
    stored = {t: draft.kept_rows(t) for t in WAREHOUSE}
    judged = "new rows" if draft.manifest.get("checked") == json.loads(json.dumps(asdict(settings))) and None not in stored.values() else "all rows"
    if judged == "all rows":
        publishable(whole, settings)
    else:
        new = {t: draft.fresh(t) for t in WAREHOUSE}
        dimensions = {t: whole[t] for t in DIMENSIONS}
        met = {t: _met_keys(draft, t, df) for t, df in new.items()}
        constraints.enforce(new, dimensions, met)
        run_gate(new, settings, dimensions=dimensions, stored=stored, met=met)
    return judged


def run_pipeline(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    days: DataFrame | None = None,
    check: Callable[[dict[str, DataFrame]], object] | None = publishable,
    grain: str | None = None,
    batch: tuple[str, int] | None = None,
) -> list[dict]:
    """Load a batch into the warehouse at ``root`` and publish it if the checks pass.

    By default constraints and gate decide, for the calendar that ``days`` gives, and on new rows alone where the stored version passed
    the same checks. Any other ``check`` receives the tables of the draft and raises to refuse them; None publishes
    unchecked. A refused load leaves the stored version what it was. Returns one metrics row per stage.

    ``batch`` names a stream and numbers its batch: the version notes it, and a number not above the noted one is no load at all.
    """
    store = Store(spark, root, grain)
    draft = store.draft()
    if batch is not None:
        noted = draft.manifest.setdefault("batches", {})
        if batch[1] <= noted.get(batch[0], -1):
            return []
        noted[batch[0]] = batch[1]
    metrics: list[dict] = []
    calendar_days = days if days is not None else dates.date_series(spark)

    def stage(name: str, work) -> None:
        started = time.monotonic()
        counts = work() or {}
        seconds = round(time.monotonic() - started, 3)
        metrics.append({"stage": name, "seconds": seconds, "tables": {t: asdict(c) for t, c in counts.items()}})

    def judge() -> None:
        if check is publishable:
            settings = settings_for(calendar_days)
            publishable_draft(draft, settings)
            draft.manifest["checked"] = json.loads(json.dumps(asdict(settings)))
        else:
            draft.manifest.pop("checked", None)
            if check is not None:
                check({t: draft.read(t) for t in WAREHOUSE})

    try:
        stage("seed", lambda: seed(draft, calendar_days))
        stage("load", lambda: load(draft, raw))
        if check is None:
            judge()
        else:
            stage("check", judge)
        stage("commit", lambda: draft.commit() and None)
    finally:
        draft.scratch.clear()
    return metrics
