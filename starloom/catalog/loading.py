"""Sources, and sinks exercised by loading the test tables twice with changes in between."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.catalog.builders import COUNT_SQL, TRANSFORMED
from starloom.catalog.profiling import columns, relation
from starloom.catalog.registry import query
from starloom.operators.merge import merge_dimension, merge_fact
from starloom.operators.positions import with_position
from starloom.operators.snapshot import Store
from starloom.plans import dimensions
from starloom.plans.quality import QualityError
from starloom.plans.warehouse import load, run_pipeline, seed
from starloom.schemas import POS, RAW_SCHEMAS, WAREHOUSE
from starloom.session import Scratch, materialize, owned_copies, scratch_path
from starloom.sources import files, seeds
from starloom.sources.dates import days_between

TEXTS = {t: [f.name for f in RAW_SCHEMAS[t].fields if f.dataType.simpleString() == "string"] for t in RAW_SCHEMAS}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Sources ---------------------------------------------------------------------------------
@query(
    "SRC-01",
    "table:s rows:i text_length:i",
    " union all ".join(
        f"select '{t}' as \"table\", count(*) as rows, sum({' + '.join(f'coalesce(length({c}), 0)' for c in TEXTS[t])}) as text_length "
        f"from {relation(t)}"
        for t in RAW_SCHEMAS
    ),
)
def extracted(ws):
    """All nine files; the review texts hold quotes and line breaks."""
    parts = []
    for name, df in ws.extracted.items():
        length = reduce(lambda a, b: a + b, [F.coalesce(F.length(c), F.lit(0)) for c in TEXTS[name]])
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), F.sum(length).alias("text_length")).withColumn("table", F.lit(name)))
    return _union(parts)


@query(
    "SRC-02",
    "table:s column_name:s filled:i",
    " union all ".join(
        f"select '{t}' as \"table\", '{c}' as column_name, count({c}) as filled from {relation(t)}" for t in RAW_SCHEMAS for c in columns(t)
    ),
)
def registered_columns(ws):
    parts = []
    for name, df in ws.extracted.items():
        names = RAW_SCHEMAS[name].fieldNames()
        counts = df.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column_name", "filled")
        parts.append(counts.withColumn("table", F.lit(name)))
    return _union(parts)


@query(
    "SRC-02-orders",
    "seller_id:s seller_state:s seller_city:s",
    f"select seller_id, seller_state, seller_city from {relation('sellers')}",
)
def reordered_columns(ws):
    """Two files of one table with their columns in different orders, each read by its own header."""
    folder, names = scratch_path(ws.spark, "orders"), RAW_SCHEMAS["sellers"].fieldNames()
    half = F.pmod(F.xxhash64("seller_id"), F.lit(2)) == 0
    for n, (part, order) in enumerate([(half, names), (~half, names[::-1])]):
        writer = ws.raw["sellers"].filter(part).select(order).coalesce(1).write.option("header", True).option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.csv(f"{folder}/{n}_sellers_dataset.csv")
    found = files.locate(ws.spark, folder, {"sellers": files.FILE_PATTERNS["sellers"]})
    return files.read_table(ws.spark, "sellers", found["sellers"])


@query(
    "SRC-03",
    "table:s found:b rows:i",
    " union all ".join(f"select '{t}' as \"table\", true as found, count(*) as rows from {relation(t)}" for t in RAW_SCHEMAS),
)
def presence(ws):
    """Every registered table has files before any of them is read."""
    located = files.locate(ws.spark, ws.csv_folder)
    return _union(
        [
            files.read_table(ws.spark, name, found).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"), F.lit(bool(found)).alias("found"), "rows"
            )
            for name, found in located.items()
        ]
    )


@query(
    "SRC-04",
    "table:s rows:i columns:i",
    " union all ".join(f"select '{t}' as \"table\", count(*) as rows, {len(columns(t))} as columns from {relation(t)}" for t in RAW_SCHEMAS),
)
def row_report(ws):
    stored, report = files.ingest(ws.extracted, scratch_path(ws.spark, "report"))
    width = {name: r["columns"] for name, r in report.items()}
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("stored")).select(
                F.lit(name).alias("table"), F.lit(report[name]["rows"]).alias("rows"), F.lit(width[name]).alias("columns")
            )
            for name, df in stored.items()
        ]
    )


query("SRC-05", "full_date:s", "select full_date from dim_date")(lambda ws: ws.calendar_days)


def purchase_days(ws) -> DataFrame:
    """First and last purchase day."""
    bought = "order_purchase_timestamp"
    return ws.raw["orders"].agg(F.min(bought).cast("date").alias("start"), F.max(bought).cast("date").alias("end"))


def orders_per_day(ws) -> DataFrame:
    day = F.col("order_purchase_timestamp").cast("date").alias("full_date")
    return ws.raw["orders"].groupBy(day).agg(F.count(F.lit(1)).alias("orders"))


query(
    "SRC-06",
    "full_date:s orders:i",
    """select d::date as full_date, count(order_id) as orders
    from (select unnest(generate_series(min(order_purchase_timestamp)::date, max(order_purchase_timestamp)::date,
            interval '1' day)) as d from raw_orders) left join raw_orders on order_purchase_timestamp::date = d::date
    group by d""",
)(lambda ws: days_between(purchase_days(ws)).join(orders_per_day(ws), "full_date", "left").fillna(0))
query(
    "SRC-07",
    "payment_type:s installment_group:s payments:i",
    """select payment_type, installment_group,
        (select count(*) from raw_payments p where p.payment_type = k.payment_type) as payments from dim_payment k""",
)(
    lambda ws: seeds.payment_types(ws.spark).join(
        ws.raw["payments"].groupBy("payment_type").agg(F.count(F.lit(1)).alias("payments")), "payment_type", "left"
    ).fillna(0, ["payments"])
)
KEYED = ("dim_customer", "dim_product", "dim_seller", "dim_payment")
query(
    "SRC-08",
    "dimension:s natural_key:s key:i",
    " union all ".join(
        f"select '{t}' as dimension, {WAREHOUSE[t].natural_key[0]} as natural_key, {WAREHOUSE[t].key} as key from {t}" for t in KEYED
    ),
)(
    lambda ws: _union(
        [
            ws.dw[t].select(
                F.lit(t).alias("dimension"), F.col(WAREHOUSE[t].natural_key[0]).alias("natural_key"), F.col(WAREHOUSE[t].key).alias("key")
            )
            for t in KEYED
        ]
    )
)
query("SRC-09", "table:s rows:i", " union all ".join(f"select '{t}' as \"table\", count(*) as rows from {t}" for t in WAREHOUSE))(
    lambda ws: _union([df.agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(t)) for t, df in ws.dw.items()])
)
query("SRC-10", "order_id:s review_score:n place:i", "select order_id, review_score, row_number() over (order by pos) as place from raw_reviews")(
    # Kept first: a range partition reads its input twice, and here that means all files.
    lambda ws: with_position(materialize(ws.extracted["reviews"].select("order_id", "review_score", POS), "reviews"), [POS], "place")
)


# Sinks -----------------------------------------------------------------------------------
def fresh_store(ws) -> Store:
    return Store(ws.spark, scratch_path(ws.spark, "sink"))


def kept_batch(ws, owner: Scratch) -> dict[str, DataFrame]:
    """The raw tables for loads that read them again and again: item lines are numbered by a shuffle and a sort, so they are kept once."""
    return ws.raw | {"order_items": owner.keep(ws.raw["order_items"], "batch")}


@query(
    "SNK-01",
    "customer_key:i customer_unique_id:s customer_state:s",
    """select customer_key, customer_unique_id, customer_state from dim_customer
    union all select customer_key + (select count(*) from dim_customer), 'new' || customer_unique_id, 'ZZ' from dim_customer""",
)
def dimension_merge(ws):
    """The second batch changes every person, which is ignored, and adds as many new ones."""
    draft = fresh_store(ws).draft()
    people = dimensions.dim_customer(ws.raw["customers"])
    merge_dimension(draft, "dim_customer", people)
    changed = people.withColumn("customer_state", F.lit("ZZ"))
    renamed = changed.withColumn("customer_unique_id", F.concat(F.lit("new"), "customer_unique_id"))
    merge_dimension(draft, "dim_customer", changed.unionByName(renamed))
    return draft.read("dim_customer")


def stored_payments(ws) -> DataFrame:
    return ws.dw["fact_payments"].drop("payment_fact_key", "created_at").withColumn(POS, F.lit(1).cast("bigint"))


@query(
    "SNK-02",
    "order_id:s payment_sequential:i customer_key:i payment_value:d payment_installments:i",
    """select order_id, payment_sequential, customer_key, payment_value * 3 as payment_value, payment_installments + 1
        as payment_installments from fact_payments
    union all select 'x' || order_id, payment_sequential, customer_key, payment_value, payment_installments from fact_payments""",
)
def fact_merge(ws):
    """Measures of stored rows change, the last of two copies wins, keys stay, new orders arrive."""
    draft = fresh_store(ws).draft()
    paid = stored_payments(ws)
    merge_fact(draft, "fact_payments", paid)
    changed = paid.withColumns(
        {"customer_key": F.col("customer_key") + 1000, "payment_installments": F.col("payment_installments") + 1}
    )
    twice = changed.withColumn("payment_value", (F.col("payment_value") * 2).cast("decimal(10,2)"))
    thrice = changed.withColumns({"payment_value": (F.col("payment_value") * 3).cast("decimal(10,2)"), POS: F.col(POS) + 1})
    added = paid.withColumn("order_id", F.concat(F.lit("x"), "order_id"))
    merge_fact(draft, "fact_payments", thrice.unionByName(twice).unionByName(added))
    return draft.read("fact_payments")


@query(
    "SNK-03",
    "date_key:i full_date:s day_name:s",
    "select date_key, full_date, day_name from dim_date",
)
def calendar_merge(ws):
    """A calendar that overlaps the stored one adds the missing days only."""
    draft = fresh_store(ws).draft()
    purchases = ws.raw["orders"].select(F.col("order_purchase_timestamp").cast("date").alias("full_date")).distinct()
    for days in (purchases, ws.calendar_days):
        rows = dimensions.dim_date(days)
        merge_dimension(draft, "dim_date", rows.withColumn(POS, rows["date_key"]))
    return draft.read("dim_date")


@query("SNK-04", "payment_key:i payment_type:s installment_group:s", "select * from dim_payment")
def seed_merge(ws):
    """Seeding twice and loading the types that occur leaves the five seeded rows."""
    draft = fresh_store(ws).draft()
    for rows in (seeds.payment_types(ws.spark), seeds.payment_types(ws.spark), dimensions.dim_payment(ws.raw["payments"])):
        merge_dimension(draft, "dim_payment", rows)
    return draft.read("dim_payment")


@query(
    "SNK-05",
    "table:s rows:i keys:i",
    " union all ".join(f"select '{t}' as \"table\", count(*) as rows, count(*) as keys from {t}" for t in WAREHOUSE),
)
def warehouse_load(ws):
    """All tables of one load, their surrogate keys unique."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(WAREHOUSE[t].key).alias("keys")).withColumn("table", F.lit(t))
            for t, df in ws.dw.items()
        ]
    )


@query(
    "SNK-06",
    "step:s version:i orders:i",
    """select 'refused' as step, 1 as version, count(*) as orders from fact_order_experience
    union all select 'accepted', 2, count(*) from fact_order_experience""",
)
def commit(ws):
    """A refused load leaves the stored version; an accepted one replaces it as a whole."""
    store = fresh_store(ws)

    def refuse(tables):
        raise QualityError("refused")

    seen = []
    with owned_copies(ws.spark) as owner:
        raw = kept_batch(ws, owner)
        run_pipeline(ws.spark, raw, store.root, ws.calendar_days, check=None)
        for step, check in (("refused", refuse), ("accepted", None)):
            try:
                run_pipeline(ws.spark, raw, store.root, ws.calendar_days, check)
            except QualityError:
                pass
            manifest = store.manifest()
            rows = store.read("fact_order_experience", manifest).agg(F.count(F.lit(1)).alias("orders"))
            seen.append(rows.select(F.lit(step).alias("step"), F.lit(manifest["version"]).alias("version"), "orders"))
    return _union(seen)


@query(
    "SNK-07",
    "offered:i inserted:i rows:i",
    "select 0 as offered, 0 as inserted, count(*) as rows from fact_payments",
)
def empty_batch(ws):
    """A batch without rows changes nothing."""
    draft = fresh_store(ws).draft()
    merge_fact(draft, "fact_payments", stored_payments(ws))
    count = merge_fact(draft, "fact_payments", stored_payments(ws).filter(F.col("payment_value") < 0))
    rows = draft.read("fact_payments").agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(F.lit(count.offered).alias("offered"), F.lit(count.inserted).alias("inserted"), "rows")


@query(
    "SNK-08",
    "load:i table:s offered:i inserted:i updated:i",
    " union all ".join(
        f"select {n} as load, '{t}' as \"table\", ({COUNT_SQL[t]}) as offered, "
        f"{f'({COUNT_SQL[t]})' if n == 1 and t != 'dim_payment' else 0} as inserted, "
        f"{f'({COUNT_SQL[t]})' if n == 2 and t.startswith('fact') else 0} as updated"
        for n in (1, 2)
        for t in TRANSFORMED
    ),
)
def merge_counts(ws):
    """Rows offered, inserted and updated by a load and by the same load again."""
    draft = fresh_store(ws).draft()
    seed(draft, ws.calendar_days)
    rows = []
    with owned_copies(ws.spark) as owner:
        raw = kept_batch(ws, owner)
        for n in (1, 2):
            rows += [f"({n}, '{t}', {c.offered}L, {c.inserted}L, {c.updated}L)" for t, c in load(draft, raw).items()]
    return ws.spark.sql(f"select * from values {', '.join(rows)} as counts(load, table, offered, inserted, updated)")


@query(
    "SNK-09",
    "table:s column_name:s filled:i",
    " union all ".join(
        f"select '{t}' as \"table\", '{c}' as column_name, "
        + (f"count({c})" if c not in (WAREHOUSE[t].key, "created_at") else "count(*)")
        + f" as filled from {t}"
        for t in WAREHOUSE
        for c in WAREHOUSE[t].schema.fieldNames()
    ),
)
def declared_columns(ws):
    """Every declared column of every stored table, generated keys and load time included."""
    parts = []
    for name, df in ws.dw.items():
        names = WAREHOUSE[name].schema.fieldNames()
        counts = df.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column_name", "filled")
        parts.append(counts.withColumn("table", F.lit(name)))
    return _union(parts)


@query(
    "SNK-10",
    "order_id:s customer_key:i date_key:i delivery_days:i delay_days:i review_score:n is_late_delivery:b",
    """select order_id, customer_key, date_key, delivery_days + 1 as delivery_days, delay_days - 100 as delay_days,
        5 as review_score, false as is_late_delivery from fact_order_experience""",
)
def updated_measures(ws):
    """Only the measures listed for the fact take the new values."""
    draft = fresh_store(ws).draft()
    stored = ws.dw["fact_order_experience"].drop("experience_fact_key", "created_at").withColumn(POS, F.lit(1).cast("bigint"))
    merge_fact(draft, "fact_order_experience", stored)
    changed = stored.withColumns(
        {
            "customer_key": F.col("customer_key") + 7,
            "date_key": F.col("date_key") + 10000,
            "delivery_days": F.col("delivery_days") + 1,
            "delay_days": F.col("delay_days") - 100,
            "review_score": F.lit(5).cast("smallint"),
            "is_late_delivery": F.lit(False),
        }
    )
    merge_fact(draft, "fact_order_experience", changed)
    return draft.read("fact_order_experience")


# The warehouse as SQL views -------------------------------------------------------------
VIEW_SQL = {
    "SNK-09-sales": (
        "year:i category:s revenue:d lines:i",
        """select year, category_name_english as category, sum(price) as revenue, count(*) as lines
        from {dw}fact_sales join {dw}dim_date using (date_key) join {dw}dim_product using (product_key) group by year, category_name_english""",
    ),
    "SNK-09-payments": (
        "payment_type:s payments:i paid:d",
        "select payment_type, count(*) as payments, sum(payment_value) as paid from {dw}fact_payments join {dw}dim_payment using (payment_key) group by payment_type",
    ),
    "SNK-09-experience": (
        "review_score:n orders:i",
        "select review_score, count(*) as orders from {dw}fact_order_experience group by review_score",
    ),
}


def _register_view_query(name: str, columns_text: str, text: str) -> None:
    def build(ws):
        Store(ws.spark, ws.root).register_views()
        return ws.spark.sql(text.format(dw="dw_"))

    query(name, columns_text, text.format(dw=""))(build)


for _name, (_columns, _text) in VIEW_SQL.items():
    _register_view_query(_name, _columns, _text)
