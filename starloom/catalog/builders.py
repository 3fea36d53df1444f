"""Table builders and the pipeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.catalog.profiling import columns, relation
from starloom.catalog.registry import query
from starloom.operators.constraints import ConstraintError
from starloom.operators.merge import SUB_POS
from starloom.operators.positions import with_surrogate_key
from starloom.operators.snapshot import Store
from starloom.plans import dimensions, facts
from starloom.plans.quality import QualityError, run_gate
from starloom.plans.warehouse import key_maps, run_pipeline
from starloom.schemas import FACTS, POS, RAW_SCHEMAS, WAREHOUSE
from starloom.session import scratch_path
from starloom.sources.files import ingest

query("ETL-01", "row_key:i customer_id:s", "select row_number() over (order by pos) as row_key, customer_id from raw_customers")(
    lambda ws: with_surrogate_key(ws.raw["customers"].select("customer_id", POS), "row_key", [POS])
)
query("ETL-02", "customer_key:i customer_unique_id:s customer_state:s customer_city:s", "select * from dim_customer")(
    lambda ws: ws.transformed["dim_customer"]
)
query(
    "ETL-03",
    "product_key:i product_id:s category_name_english:s product_name_length:i product_description_length:i photos_qty:i weight_g:d",
    "select * from dim_product",
)(lambda ws: ws.transformed["dim_product"])
query("ETL-04", "seller_key:i seller_id:s seller_state:s seller_city:s", "select * from dim_seller")(
    lambda ws: ws.transformed["dim_seller"]
)
SEEN_TYPES = """(select row_number() over (order by min(pos)) as payment_key, payment_type, '1 installment' as installment_group
    from raw_payments group by payment_type)"""
query("ETL-05", "payment_key:i payment_type:s installment_group:s", f"select * from {SEEN_TYPES}")(
    lambda ws: ws.transformed["dim_payment"]
)
query(
    "ETL-06",
    "date_key:i full_date:s year:i quarter:i month:i month_name:s week_of_year:i day_of_month:i day_of_week:i day_name:s is_weekend:b",
    "select * from dim_date",
)(lambda ws: dimensions.dim_date(ws.calendar_days))
query(
    "ETL-07",
    "customer_id:s customer_key:i customer_unique_id:s",
    "select customer_id, customer_key, customer_unique_id from raw_customers left join dim_customer using (customer_unique_id)",
)(lambda ws: facts.customer_id_map(ws.raw["customers"], key_maps(ws.transformed)["customer"]))
query(
    "ETL-08",
    "order_id:s order_item_id:i customer_key:i customer_unique_id:s product_key:i product_id:s seller_key:i seller_id:s "
    "date_key:i price:d freight_value:d",
    """select f.*, c.customer_unique_id, p.product_id, s.seller_id from fact_sales f join dim_customer c using (customer_key)
        join dim_product p using (product_key) join dim_seller s using (seller_key)""",
)(lambda ws: ws.transformed["fact_sales"])
query(
    "ETL-09",
    "order_id:s payment_sequential:i customer_key:i customer_unique_id:s date_key:i payment_key:i payment_value:d payment_installments:i",
    f"""select p.order_id, p.payment_sequential, d.customer_key, d.customer_unique_id, d.date_key, k.payment_key, p.payment_value,
        coalesce(p.payment_installments, 1) as payment_installments
    from raw_payments p join delivered_base d using (order_id) join {SEEN_TYPES} k using (payment_type)""",
)(lambda ws: ws.transformed["fact_payments"])
query(
    "ETL-10",
    "order_id:s customer_key:i customer_unique_id:s date_key:i delivery_days:i delay_days:i review_score:n is_late_delivery:b",
    "select f.*, c.customer_unique_id from fact_order_experience f join dim_customer c using (customer_key)",
)(lambda ws: ws.transformed["fact_order_experience"])

TRANSFORMED = ("dim_customer", "dim_product", "dim_seller", "dim_payment", "fact_sales", "fact_payments", "fact_order_experience")
COUNT_SQL = {t: f"select count(*) from {t}" for t in WAREHOUSE} | {
    "dim_payment": f"select count(*) from {SEEN_TYPES}",
    "seed": "select count(*) from dim_payment",
}


def _counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows") for t, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


query("ETL-11", "table:s rows:i", " union all ".join(f"select '{t}' as \"table\", ({COUNT_SQL[t]}) as rows" for t in TRANSFORMED))(
    lambda ws: _counts({t: ws.transformed[t] for t in TRANSFORMED})
)


@query(
    "ETL-12",
    "order_id:s order_item_id:i customer_key:i product_key:i seller_key:i price:d",
    "select order_id, order_item_id, customer_key, product_key, seller_key, price from fact_sales",
)
def remapped(ws):
    """Keys assigned in memory are replaced by those stored, found through the natural keys."""
    stored = key_maps(ws.dw)
    fact = ws.transformed["fact_sales"].withColumns({k: -F.col(k) for k in ("customer_key", "product_key", "seller_key")})
    # Products first: the transform has looked them up last, so the rows still lie together by product.
    fact = facts.remap_key(fact, stored["product"], "product_id", "product_key")
    fact = facts.remap_key(fact, stored["seller"], "seller_id", "seller_key")
    return facts.remap_key(fact, stored["customer"], "customer_unique_id", "customer_key")


def metrics_frame(spark, metrics: list[dict]) -> DataFrame:
    """Merge counts of a run as rows: one per stage and table."""
    rows = [
        (m["stage"], table, c["offered"], c["inserted"], c["updated"]) for m in metrics for table, c in m["tables"].items()
    ]
    values = ", ".join(f"('{s}', '{t}', {o}L, {i}L, {u}L)" for s, t, o, i, u in rows)
    return spark.sql(f"select * from values {values} as metrics(stage, table, offered, inserted, updated)")


STAGES = [("seed", "dim_payment", "seed", "seed"), ("seed", "dim_date", "dim_date", "dim_date")] + [
    ("load", t, t, None if t == "dim_payment" else t) for t in TRANSFORMED
]


@query(
    "ETL-13",
    "stage:s table:s offered:i inserted:i updated:i",
    " union all ".join(
        f"select '{s}' as stage, '{t}' as \"table\", ({COUNT_SQL[offered]}) as offered, "
        f"{'(' + COUNT_SQL[new] + ')' if new else '0'} as inserted, 0 as updated"
        for s, t, offered, new in STAGES
    ),
)
def pipeline(ws):
    """The whole run into an empty warehouse, with the checks reporting instead of refusing."""
    metrics = run_pipeline(
        ws.spark,
        ws.raw,
        scratch_path(ws.spark, "pipeline"),
        ws.calendar_days,
        lambda tables: run_gate(tables, ws.settings, strict=False),
    )
    return metrics_frame(ws.spark, metrics)


def accepted(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw tables without what the gate refuses: card payments in no installments."""
    paid = raw["payments"].withColumn("payment_installments", F.greatest("payment_installments", F.lit(1)))
    return raw | {"payments": paid}


@query(
    "ETL-13-published",
    "table:s rows:i version:i",
    " union all ".join(f"select '{t}' as \"table\", ({COUNT_SQL[t]}) as rows, 1 as version" for t in FACTS),
)
def published(ws):
    """The default run, whose constraints and gate decide, on data that passes: the facts of the version it published."""
    root = scratch_path(ws.spark, "published")
    run_pipeline(ws.spark, accepted(ws.raw), root, ws.calendar_days)
    store = Store(ws.spark, root)
    return _counts({t: store.read(t) for t in FACTS}).withColumn("version", F.lit(store.versions()[-1]))


@query(
    "ETL-13-refused",
    "message:s versions:i",
    """select '1 of 20 checks failed:' || chr(10) || 'QC-10 credit_card_installments_valid → ' || format('{:,}', count(*)) as message, 0 as versions
        from fact_payments join dim_payment using (payment_key) where payment_type = 'credit_card' and payment_installments < 1 having count(*) > 0""",
)
def refused(ws):
    """The default run on the data as it is: what it said when it refused, and that it published nothing."""
    root = scratch_path(ws.spark, "refused")
    try:
        run_pipeline(ws.spark, ws.raw, root, ws.calendar_days)
        said = []
    except (ConstraintError, QualityError) as refusal:
        said = [(str(refusal), len(Store(ws.spark, root).versions()))]
    return ws.spark.createDataFrame(said, "message string, versions int")


@query(
    "ETL-14",
    "stage:s table:s rows:i columns:i",
    " union all ".join(
        [f"select 'extract' as stage, '{t}' as \"table\", count(*) as rows, {len(columns(t))} as columns from {relation(t)}" for t in RAW_SCHEMAS]
        + [
            f"select 'transform' as stage, '{t}' as \"table\", ({COUNT_SQL[t]}) as rows, {n} as columns"
            for t, n in zip(TRANSFORMED, (4, 7, 4, 3, 11, 8, 8))
        ]
    ),
)
def run_metrics(ws):
    """Rows and columns after each stage; the extract counts are observed while the rows are stored."""
    _, report = ingest(ws.extracted, scratch_path(ws.spark, "ingest"))
    values = ", ".join(f"('extract', '{t}', {r['rows']}L, {r['columns']})" for t, r in report.items())
    extracted = ws.spark.sql(f"select * from values {values} as report(stage, table, rows, columns)")
    helpers = {POS, SUB_POS}
    widths = {t: len(set(ws.transformed[t].columns) - helpers) for t in TRANSFORMED}
    shapes = _counts({t: ws.transformed[t] for t in TRANSFORMED}).withColumn("stage", F.lit("transform"))
    width = F.create_map(*[F.lit(v) for t, w in widths.items() for v in (t, w)])
    return extracted.unionByName(shapes.withColumn("columns", width[F.col("table")]))
