"""Projections, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.catalog.analytics import PAID, RFM_SCORES
from starloom.catalog.ctes import describe, half_up, mean, mean_money, pct
from starloom.catalog.exploration import DESCRIBE_COLUMNS, rounded
from starloom.catalog.profiling import lost, missing_per_column, relation
from starloom.catalog.registry import query
from starloom.functions import numeric
from starloom.functions.labels import delivery_bucket, delivery_status
from starloom.operators.constraints import orphan_rows
from starloom.operators.dedup import keep_first, keep_last, repeated_groups, surplus_rows
from starloom.operators.positions import with_ntile, with_position
from starloom.operators.quantiles import describe as described
from starloom.plans import customers as customer_reports
from starloom.plans import distincts
from starloom.plans import exploration as x
from starloom.plans import profiling as p
from starloom.plans import revenue
from starloom.plans.dimensions import dim_payment, translated_products
from starloom.plans.facts import customer_id_map, delivered_orders, last_review, remap_key
from starloom.plans.warehouse import key_maps
from starloom.schemas import POS


def rows():
    return F.count(F.lit(1))


# Projections -----------------------------------------------------------------------------
query("PRJ-01", "customer_state:s customer_unique_id:s", "select customer_state, customer_unique_id from raw_customers")(
    lambda ws: ws.raw["customers"].select("customer_state", "customer_unique_id")
)
query(
    "PRJ-02",
    "product_id:s product_name_length:d product_description_length:d",
    """select product_id, product_name_lenght as product_name_length,
        product_description_lenght as product_description_length from raw_products""",
)(
    lambda ws: ws.raw["products"].withColumnsRenamed(
        {"product_name_lenght": "product_name_length", "product_description_lenght": "product_description_length"}
    )
)
query(
    "PRJ-03",
    "customer_unique_id:s customer_state:s customer_city:s",
    "select * exclude (customer_key) from dim_customer",
)(lambda ws: ws.dw["dim_customer"].drop("customer_key", "created_at"))
query(
    "PRJ-04",
    "order_id:s order_item_id:i line_total:d is_heavy_freight:b",
    """select order_id, order_item_id, price + freight_value as line_total, freight_value * 20 > price as is_heavy_freight
    from raw_order_items""",
)(
    lambda ws: ws.raw["order_items"].withColumns(
        {"line_total": F.col("price") + F.col("freight_value"), "is_heavy_freight": F.col("freight_value") * 20 > F.col("price")}
    )
)
query(
    "PRJ-05",
    "payment_type:s installment_group:s",
    "select distinct payment_type, '1 installment' as installment_group from raw_payments",
)(lambda ws: dim_payment(ws.raw["payments"]))

# Filters ---------------------------------------------------------------------------------
ORDER_ROW = "order_id:s customer_id:s order_status:s"


def order_filter(id: str, where: str, condition):
    query(id, ORDER_ROW, f"select order_id, customer_id, order_status from raw_orders where {where}")(
        lambda ws: ws.raw["orders"].filter(condition())
    )


order_filter("FLT-01", "order_status = 'delivered'", lambda: F.col("order_status") == "delivered")
order_filter(
    "FLT-02",
    "order_status = 'delivered' and order_delivered_customer_date is not null",
    lambda: (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull(),
)
query("FLT-03", ORDER_ROW, "select * from raw_orders where order_delivered_customer_date is not null")(
    lambda ws: ws.raw["orders"].dropna(subset=["order_delivered_customer_date"])
)
query(
    "FLT-04",
    "order_id:s review_score:n reviewed:b",
    "select order_id, review_score, review_score is not null as reviewed from fact_order_experience",
)(
    lambda ws: ws.dw["fact_order_experience"].filter(F.col("review_score").isNotNull()).withColumn("reviewed", F.lit(True)).unionByName(
        ws.dw["fact_order_experience"].filter(F.col("review_score").isNull()).withColumn("reviewed", F.lit(False))
    )
)
query(
    "FLT-05",
    "order_id:s order_item_id:i price:d freight_value:d",
    "select * from fact_sales where price <= 50000 and price > 1000 and freight_value < 2000 and freight_value >= 1",
)(
    lambda ws: ws.dw["fact_sales"].filter(
        (F.col("price") <= 50000) & (F.col("price") > 1000) & (F.col("freight_value") < 2000) & (F.col("freight_value") >= 1)
    )
)
query(
    "FLT-06",
    "order_id:s delivery_days:i",
    "select order_id, delivery_days from fact_order_experience where delivery_days not between 5 and 30",
)(lambda ws: ws.dw["fact_order_experience"].filter(~F.col("delivery_days").between(5, 30)))
query(
    "FLT-07",
    "order_id:s payment_type:s",
    "select order_id, payment_type from raw_payments where payment_type not in ('voucher', 'boleto')",
)(lambda ws: ws.raw["payments"].filter(~F.col("payment_type").isin("voucher", "boleto")))
query("FLT-08", "date_key:i day_of_week:i", "select date_key, day_of_week from dim_date where day_of_week in (6, 7)")(
    lambda ws: ws.dw["dim_date"].filter(F.col("day_of_week").isin(6, 7))
)
query(
    "FLT-09",
    "seller_key:i orders:i",
    """select seller_key, count(distinct order_id) as orders from fact_sales group by seller_key
    having count(distinct order_id) >= 195""",
)(
    lambda ws: ws.dw["fact_sales"].groupBy("seller_key").agg(F.count_distinct("order_id").alias("orders")).filter("orders >= 195")
)
query(
    "FLT-10",
    "order_id:s payment_sequential:i payment_value:d",
    """select order_id, payment_sequential, payment_value from fact_payments join dim_payment using (payment_key)
    where payment_type = 'credit_card'""",
)(
    lambda ws: ws.dw["fact_payments"].join(ws.dw["dim_payment"], "payment_key").filter(F.col("payment_type") == "credit_card").select(
        "order_id", "payment_sequential", "payment_value"
    )
)
query(
    "FLT-11",
    "late:i on_time:i",
    """select count(*) filter (is_late_delivery) as late, count(*) filter (not is_late_delivery) as on_time
    from fact_order_experience""",
)(
    lambda ws: ws.dw["fact_order_experience"].agg(
        F.sum(F.when(F.col("is_late_delivery"), 1).otherwise(0)).alias("late"),
        F.sum(F.when(~F.col("is_late_delivery"), 1).otherwise(0)).alias("on_time"),
    )
)
query(
    "FLT-12",
    "date_key:i",
    "select date_key from dim_date where full_date < date '1995-03-01' or full_date > date '2001-06-30'",
)(
    lambda ws: ws.dw["dim_date"].filter(
        (F.col("full_date") < F.lit("1995-03-01").cast("date")) | (F.col("full_date") > F.lit("2001-06-30").cast("date"))
    )
)
query(
    "FLT-13",
    "order_id:s reviewed:b",
    """select order_id, true as reviewed from raw_orders where order_id in (select order_id from raw_reviews)
    union all select order_id, false from raw_orders where order_id not in (select order_id from raw_reviews)""",
)(
    lambda ws: ws.raw["orders"].join(ws.raw["reviews"], "order_id", "left_semi").select("order_id", F.lit(True).alias("reviewed")).unionByName(
        p.orphans(ws.raw["orders"], ws.raw["reviews"], "order_id").select("order_id", F.lit(False).alias("reviewed"))
    )
)

# Joins -----------------------------------------------------------------------------------
query(
    "JON-01",
    "order_id:s order_item_id:i customer_id:s",
    """select i.order_id, order_item_id, customer_id from raw_order_items i join raw_orders o on i.order_id = o.order_id
    where order_status = 'delivered'""",
)(
    lambda ws: ws.raw["order_items"].join(ws.raw["orders"].filter("order_status = 'delivered'"), "order_id", "inner").select(
        "order_id", "order_item_id", "customer_id"
    )
)
query(
    "JON-02",
    "order_id:s order_item_id:i product_key:i seller_key:i",
    """select order_id, order_item_id, product_key, seller_key from raw_order_items
    left join dim_product using (product_id) left join dim_seller using (seller_id)""",
)(
    lambda ws: ws.raw["order_items"]
    .join(key_maps(ws.dw)["product"], "product_id", "left")
    .join(key_maps(ws.dw)["seller"], "seller_id", "left")
)
query(
    "JON-03",
    "customer_id:s customer_unique_id:s customer_key:i",
    "select customer_id, customer_unique_id, customer_key from raw_customers left join dim_customer using (customer_unique_id)",
)(lambda ws: customer_id_map(ws.raw["customers"], key_maps(ws.dw)["customer"]))
query(
    "JON-04",
    "product_id:s category:s",
    """select product_id, coalesce(product_category_name_english, 'unknown') as category
    from raw_products left join raw_translation using (product_category_name)""",
)(
    lambda ws: translated_products(ws.raw["products"], ws.raw["category_translation"]).select(
        "product_id", F.coalesce("product_category_name_english", F.lit("unknown")).alias("category")
    )
)
query(
    "JON-05",
    "order_id:s review_score:n",
    """select d.order_id, r.review_score from delivered_base d left join (select order_id, arg_max(review_score, pos)
        as review_score from raw_reviews group by order_id) r using (order_id)""",
)(
    lambda ws: delivered_orders(ws.raw, key_maps(ws.dw)["customer"]).join(last_review(ws.raw["reviews"]), "order_id", "left")
)
RELATIONS = (
    ("orders", "customers", "customer_id"),
    ("order_items", "orders", "order_id"),
    ("payments", "orders", "order_id"),
    ("reviews", "orders", "order_id"),
    ("order_items", "products", "product_id"),
    ("order_items", "sellers", "seller_id"),
)


@query(
    "JON-06",
    "child:s parent:s orphans:i",
    " union all ".join(
        f"select '{c}' as child, '{m}' as parent, {lost(relation(c), relation(m), k)} as orphans" for c, m, k in RELATIONS
    ),
)
def source_orphans(ws):
    result = None
    for child, parent, key in RELATIONS:
        row = p.orphan_count(ws.raw[child], ws.raw[parent], key, "orphans").select(
            F.lit(child).alias("child"), F.lit(parent).alias("parent"), "orphans"
        )
        result = row if result is None else result.unionByName(row)
    return result


query(
    "JON-06-rows",
    "order_id:s customer_id:s",
    "select order_id, customer_id from raw_orders o where not exists (select 1 from raw_order_items i where i.order_id = o.order_id)",
)(lambda ws: p.orphans(ws.raw["orders"], ws.raw["order_items"], "order_id").select("order_id", "customer_id"))
query(
    "JON-07",
    "customer_key:i orphans:i",
    """select s.customer_key, count(*) as orphans from fact_sales s left join (select customer_key from fact_payments f
        join dim_payment using (payment_key) where payment_type = 'credit_card') c on s.customer_key = c.customer_key
    where c.customer_key is null group by s.customer_key""",
)(
    lambda ws: orphan_rows(
        ws.dw["fact_sales"],
        ws.dw["fact_payments"].join(ws.dw["dim_payment"].filter("payment_type = 'credit_card'"), "payment_key", "left_semi"),
        "customer_key",
    )
)
query(
    "JON-08",
    "year:i category_name_english:s seller_state:s revenue:d",
    """select year, category_name_english, seller_state, sum(price) as revenue from fact_sales join dim_date using (date_key)
        join dim_product using (product_key) join dim_seller using (seller_key)
    group by year, category_name_english, seller_state""",
)(
    lambda ws: ws.dw["fact_sales"]
    .join(ws.dw["dim_date"], "date_key")
    .join(ws.dw["dim_product"], "product_key")
    .join(ws.dw["dim_seller"], "seller_key")
    .groupBy("year", "category_name_english", "seller_state")
    .agg(F.sum("price").alias("revenue"))
)
query(
    "JON-09",
    "order_id:s order_item_id:i review_score:n delay_days:i",
    """select s.order_id, s.order_item_id, e.review_score, e.delay_days
    from fact_sales s join fact_order_experience e on s.order_id = e.order_id""",
)(
    lambda ws: ws.dw["fact_sales"].select("order_id", "order_item_id").join(
        ws.dw["fact_order_experience"].select("order_id", "review_score", "delay_days"), "order_id"
    )
)
query(
    "JON-10",
    "customer_key:i days:i",
    """select a.customer_key, b.full_date - a.full_date as days from (select customer_key, full_date,
            row_number() over (partition by customer_key order by full_date) as n
            from fact_payments join dim_date using (date_key)) a
        join (select customer_key, full_date, row_number() over (partition by customer_key order by full_date) as n
            from fact_payments join dim_date using (date_key)) b on a.customer_key = b.customer_key and a.n = 1 and b.n = 2""",
)(
    lambda ws: customer_reports.first_gaps(
        ws.dw["fact_payments"].groupBy("customer_key", "date_key").agg(rows().alias("events")).join(
            ws.dw["dim_date"].select("date_key", "full_date"), "date_key"
        )
    )
)
query(
    "JON-11",
    "order_id:s payment_sequential:i payment_key:i",
    "select order_id, payment_sequential, payment_key from fact_payments",
)(lambda ws: remap_key(ws.transformed["fact_payments"].join(key_maps(ws.transformed)["payment"], "payment_key"), key_maps(ws.dw)["payment"], "payment_type", "payment_key"))
query(
    "JON-12",
    "customer_key:i recency_days:i",
    """select customer_key, (select max(full_date) from fact_payments join dim_date using (date_key)) - max(full_date)
        as recency_days from fact_payments join dim_date using (date_key) group by customer_key""",
)(
    lambda ws: customer_reports.rfm_base(ws.dw).select(
        "customer_key", F.datediff(customer_reports.rfm_base(ws.dw).agg(F.max("last_day")).scalar(), "last_day").alias("recency_days")
    )
)
query(
    "JON-13",
    "order_id:s customer_id:s order_value:d",
    "select order_id, customer_id, order_value from raw_orders join order_totals using (order_id)",
)(lambda ws: ws.raw["orders"].select("order_id", "customer_id").join(x.order_totals(ws.raw), "order_id"))
query(
    "JON-14",
    "order_id:s product_id:s category:s scores:i",
    """select order_id, product_id, product_category_name_english as category, sum(review_score) as scores
    from named_items join raw_reviews using (order_id) group by order_id, product_id, product_category_name_english""",
)(
    # Lines per order and product, scores per order: an order with many of both does not multiply.
    lambda ws: ws.raw["order_items"].groupBy("order_id", "product_id").agg(rows().alias("lines"))
    .join(ws.raw["products"].select("product_id", "product_category_name"), "product_id")
    .join(ws.raw["category_translation"].drop(POS), "product_category_name", "left")
    .join(ws.raw["reviews"].groupBy("order_id").agg(F.sum("review_score").alias("score")), "order_id")
    .groupBy("order_id", "product_id", F.col("product_category_name_english").alias("category"))
    .agg(F.sum(F.col("lines") * F.col("score")).alias("scores"))
)

# Aggregates ------------------------------------------------------------------------------
query(
    "AGG-01",
    "year:i month:i payment_key:i revenue:d",
    f"select year, month, payment_key, sum(payment_value) as revenue from {PAID} group by year, month, payment_key",
)(
    lambda ws: ws.dw["fact_payments"].join(ws.dw["dim_date"], "date_key").groupBy("year", "month", "payment_key").agg(
        F.sum("payment_value").alias("revenue")
    )
)
query("AGG-02", "product_key:i units:i ones:i", "select product_key, count(*) as units, sum(1) as ones from fact_sales group by 1")(
    lambda ws: ws.dw["fact_sales"].groupBy("product_key").agg(rows().alias("units"), F.sum(F.lit(1)).alias("ones"))
)
query(
    "AGG-03",
    "product_key:i orders:i sellers:i",
    "select product_key, count(distinct order_id) as orders, count(distinct seller_key) as sellers from fact_sales group by 1",
)(
    lambda ws: ws.dw["fact_sales"].groupBy("product_key").agg(
        F.count_distinct("order_id").alias("orders"), F.count_distinct("seller_key").alias("sellers")
    )
)
for level, keys in distincts.LEVELS.items():
    for state in (False, True):
        by = keys + (["customer_state"] if state else [])
        listed = "".join(f"{k}, " for k in by)
        query(
            f"AGG-03-{level}{'-state' if state else ''}",
            " ".join(f"{k}:{'s' if k == 'customer_state' else 'i'}" for k in by) + " customers:i",
            f"select {listed}count(distinct customer_key) as customers from fact_sales join dim_date using (date_key) join dim_customer using (customer_key)"
            + (f" group by {listed[:-2]}" if by else ""),
        )(lambda ws, level=level, state=state: distincts.distinct_customers(distincts.customer_bitmaps(ws.dw), level, state))
query(
    "AGG-04",
    "customer_key:i avg_value:d avg_score:d",
    f"""select customer_key, {mean_money('payment_value')} as avg_value, (select {mean('review_score', 4)}
        from fact_order_experience e where e.customer_key = f.customer_key) as avg_score
    from fact_payments f group by customer_key""",
)(
    lambda ws: ws.dw["fact_payments"].groupBy("customer_key").agg(numeric.average_money(F.col("payment_value")).alias("avg_value")).join(
        ws.dw["fact_order_experience"].groupBy("customer_key").agg(numeric.average(F.col("review_score"), 4).alias("avg_score")),
        "customer_key",
        "left",
    )
)
query(
    "AGG-05",
    "customer_key:i first_day:i last_day:i cheapest:d dearest:d",
    """select customer_key, min(date_key) as first_day, max(date_key) as last_day, min(price) as cheapest, max(price) as dearest
    from fact_sales group by customer_key""",
)(
    lambda ws: ws.dw["fact_sales"].groupBy("customer_key").agg(
        F.min("date_key").alias("first_day"), F.max("date_key").alias("last_day"), F.min("price").alias("cheapest"), F.max("price").alias("dearest")
    )
)
query(
    "AGG-06",
    "product_key:i y1996:d y1997:d",
    """select product_key, sum(case when year = 1996 then price else 0 end) as y1996,
        sum(case when year = 1997 then price else 0 end) as y1997 from fact_sales join dim_date using (date_key) group by 1""",
)(
    lambda ws: ws.dw["fact_sales"].join(ws.dw["dim_date"], "date_key").groupBy("product_key").agg(
        *[F.sum(F.when(F.col("year") == y, F.col("price")).otherwise(0)).alias(f"y{y}") for y in (1996, 1997)]
    )
)
query(
    "AGG-07",
    "customer_key:i late:i poor:i",
    """select customer_key, sum(case when is_late_delivery then 1 else 0 end) as late,
        sum(case when review_score <= 2 then 1 else 0 end) as poor from fact_order_experience group by 1""",
)(
    lambda ws: ws.dw["fact_order_experience"].groupBy("customer_key").agg(
        F.count_if(F.col("is_late_delivery")).alias("late"), F.count_if(F.col("review_score") <= 2).alias("poor")
    )
)
query(
    "AGG-08",
    "customer_key:i avg_delay_when_late:d",
    f"""select customer_key, {half_up('sum(delay_days) filter (delay_days > 0)', 'count(*) filter (delay_days > 0)', 1)}
        as avg_delay_when_late from fact_order_experience group by 1""",
)(
    lambda ws: ws.dw["fact_order_experience"].groupBy("customer_key").agg(
        numeric.average(F.when(F.col("delay_days") > 0, F.col("delay_days")), 1).alias("avg_delay_when_late")
    )
)
query(
    "AGG-09",
    "seller_key:i free_pct:d per_free_line:d",
    f"""select seller_key, {pct('count(*) filter (freight_value = 0)', 'count(*)')} as free_pct,
        {half_up('count(*)', 'count(*) filter (freight_value = 0)', 2)} as per_free_line from fact_sales group by 1""",
)(
    lambda ws: ws.dw["fact_sales"].groupBy("seller_key").agg(
        numeric.percent(F.count_if(F.col("freight_value") == 0), rows()).alias("free_pct"),
        numeric.ratio(rows(), F.count_if(F.col("freight_value") == 0), 2).alias("per_free_line"),
    )
)
query(
    "AGG-10",
    "customer_unique_id:s customer_state:s customer_city:s",
    """select customer_unique_id, arg_max(customer_state, pos) as customer_state, arg_max(customer_city, pos) as customer_city
    from raw_customers group by 1""",
)(lambda ws: keep_last(ws.raw["customers"].drop("customer_id"), ["customer_unique_id"], POS))
query(
    "AGG-11",
    "geolocation_zip_code_prefix:s geolocation_lat:d",
    "select geolocation_zip_code_prefix, arg_min(geolocation_lat, pos) as geolocation_lat from raw_geolocation group by 1",
)(lambda ws: keep_first(ws.raw["geolocation"], ["geolocation_zip_code_prefix"], POS))
query("AGG-12", "payment_type:s", "select distinct payment_type from raw_payments")(
    lambda ws: ws.raw["payments"].select("payment_type").distinct()
)
query(
    "AGG-13",
    "repeated_keys:i",
    "select count(*) as repeated_keys from (select 1 from raw_order_items group by order_id, line_number having count(*) > 1)",
)(lambda ws: repeated_groups(ws.raw["order_items"], ["order_id", "line_number"]).agg(rows().alias("repeated_keys")))
query(
    "AGG-14",
    "surplus:i",
    "select count(*) - (select count(*) from (select distinct order_id, line_number from raw_order_items)) as surplus from raw_order_items",
)(lambda ws: surplus_rows(ws.raw["order_items"], ["order_id", "line_number"], "surplus"))
query(
    "AGG-15",
    "orders:i customers:i",
    "select n as orders, count(*) as customers from (select count(distinct order_id) as n from fact_payments group by customer_key) group by n",
)(
    lambda ws: ws.dw["fact_payments"].groupBy("customer_key").agg(F.count_distinct("order_id").alias("orders")).groupBy("orders").agg(
        rows().alias("customers")
    )
)
query(
    "AGG-16",
    "avg_order_value:d avg_payment:d",
    f"""select (select {mean_money('order_value', 4)} from order_totals) as avg_order_value,
        {mean_money('payment_value', 4)} as avg_payment from raw_payments""",
)(
    lambda ws: x.order_totals(ws.raw).agg(numeric.average_money(F.col("order_value"), 4).alias("avg_order_value")).withColumn(
        "avg_payment", ws.raw["payments"].agg(numeric.average_money(F.col("payment_value"), 4)).scalar()
    )
)
query(
    "AGG-17",
    "rows:i price:d freight:d",
    "select count(*) as rows, sum(price) as price, sum(freight_value) as freight from raw_order_items",
)(
    lambda ws: ws.raw["order_items"].agg(rows().alias("rows"), F.sum("price").alias("price"), F.sum("freight_value").alias("freight"))
)
query(
    "AGG-18",
    "bucket:s orders:i",
    """select case when delivery_days < 8 then '1. <= 7 days' when delivery_days < 15 then '2. 8-14 days'
        when delivery_days < 22 then '3. 15-21 days' when delivery_days < 31 then '4. 22-30 days' else '5. > 30 days' end
        as bucket, count(*) as orders from fact_order_experience group by bucket""",
)(
    lambda ws: ws.dw["fact_order_experience"].groupBy(delivery_bucket(F.col("delivery_days")).alias("bucket")).agg(rows().alias("orders"))
)
query(
    "AGG-19",
    "status:s orders:i",
    "select if(is_late_delivery, 'Late', 'On Time') as status, count(*) as orders from fact_order_experience group by is_late_delivery",
)(
    lambda ws: ws.dw["fact_order_experience"].groupBy("is_late_delivery").agg(rows().alias("orders")).select(
        delivery_status(F.col("is_late_delivery")).alias("status"), "orders"
    )
)
query(
    "AGG-20",
    "orders:i received_dates:i categories:i",
    """select count(distinct order_id) as orders, count(distinct order_delivered_customer_date) as received_dates,
        (select count(distinct product_category_name) from raw_products) as categories from raw_orders""",
)(
    lambda ws: ws.raw["orders"].agg(
        F.count_distinct("order_id").alias("orders"), F.count_distinct("order_delivered_customer_date").alias("received_dates")
    ).withColumn("categories", ws.raw["products"].agg(F.count_distinct("product_category_name")).scalar())
)
query(
    "AGG-21",
    "product_category_name:s n:i",
    """select product_category_name, count(*) as n from raw_products where product_category_name is not null group by 1
    order by n desc, product_category_name limit 4""",
)(lambda ws: p.value_counts(ws.raw["products"], "product_category_name").limit(4))
query(
    "AGG-22",
    DESCRIBE_COLUMNS,
    describe("raw_order_items", "price") + " union all " + describe("raw_order_items", "freight_value"),
)(lambda ws: rounded(described(ws.raw["order_items"], ["price", "freight_value"])))
query(
    "AGG-23",
    "product_category_name:s size:i",
    "select product_category_name, count(*) as size from raw_products where product_category_name is not null group by 1",
)(
    lambda ws: ws.raw["products"].filter("product_category_name is not null").groupBy("product_category_name").agg(rows().alias("size"))
)
query(
    "AGG-24",
    "customer_id:s late_rate:d",
    f"""select customer_unique_id as customer_id, {half_up('count(*) filter (delay_days > 0)', 'count(*)', 6)} as late_rate
    from received_orders join raw_customers using (customer_id) group by 1""",
)(
    lambda ws: x.received_orders(ws.raw).join(ws.raw["customers"], "customer_id").groupBy(
        F.col("customer_unique_id").alias("customer_id")
    ).agg(numeric.average(F.col("is_late").cast("int"), 6).alias("late_rate"))
)
query(
    "AGG-25",
    "r:d",
    "select round(corr(price, freight_value), 6) as r from raw_order_items",
)(
    lambda ws: ws.raw["order_items"].agg(
        F.round(F.corr(F.col("price").cast("double"), F.col("freight_value").cast("double")), 6).alias("r")
    )
)
query(
    "AGG-26",
    "order_id:s installments:n order_value:d payments:i mean_value:d spread:d",
    f"""select order_id, max(payment_installments) as installments, sum(payment_value) as order_value, count(*) as payments,
        {mean_money('payment_value')} as mean_value, max(payment_value) - min(payment_value) as spread
    from raw_payments group by order_id""",
)(
    lambda ws: ws.raw["payments"].groupBy("order_id").agg(
        F.max("payment_installments").alias("installments"),
        F.sum("payment_value").alias("order_value"),
        rows().alias("payments"),
        numeric.average_money(F.col("payment_value")).alias("mean_value"),
        (F.max("payment_value") - F.min("payment_value")).alias("spread"),
    )
)
query(
    "AGG-27",
    "column_name:s missing:i",
    f"select column_name, missing from ({missing_per_column(['orders'])})",
)(lambda ws: p.null_counts(p.source_columns("orders", ws.raw["orders"])))
query("AGG-28", "repeat_customers:i", "select count(*) filter (orders > 1) as repeat_customers from person_orders")(
    lambda ws: p.orders_per_person(ws.raw).agg(F.count_if(F.col("orders") > 1).alias("repeat_customers"))
)

# Windows ---------------------------------------------------------------------------------
query(
    "WIN-01",
    "year:i month:i revenue:d previous:d",
    f"""select year, month, revenue, lag(revenue) over (order by year, month) as previous
    from (select year, month, sum(payment_value) as revenue from {PAID} group by year, month)""",
)(
    lambda ws: ws.dw["fact_payments"].join(ws.dw["dim_date"], "date_key").groupBy("year", "month").agg(
        F.sum("payment_value").alias("revenue")
    ).withColumn("previous", F.lag("revenue").over(Window.orderBy("year", "month")))
)
query(
    "WIN-02",
    "category_name_english:s revenue:d total:d",
    """select category_name_english, sum(price) as revenue, sum(sum(price)) over () as total
    from fact_sales join dim_product using (product_key) group by 1""",
)(
    lambda ws: revenue.category_sums(ws.dw).select(
        "category_name_english", F.col("total_revenue").alias("revenue"), F.sum("total_revenue").over(Window.partitionBy()).alias("total")
    )
)
query(
    "WIN-03",
    "payment_key:i orders:i all_orders:i",
    """select payment_key, count(distinct order_id) as orders, sum(count(distinct order_id)) over () as all_orders
    from fact_payments group by 1""",
)(
    lambda ws: ws.dw["fact_payments"].groupBy("payment_key").agg(F.count_distinct("order_id").alias("orders")).withColumn(
        "all_orders", F.sum("orders").over(Window.partitionBy())
    )
)
query(
    "WIN-04",
    "customer_key:i date_key:i order_id:s nth:i",
    """select * from (select customer_key, date_key, order_id, row_number() over (partition by customer_key
        order by date_key, order_id) as nth from (select distinct customer_key, date_key, order_id from fact_payments))
    where nth <= 2""",
)(
    # The rank filter becomes a limit per group before the shuffle: two rows per customer and task move.
    lambda ws: ws.dw["fact_payments"].select("customer_key", "date_key", "order_id").distinct().withColumn(
        "nth", F.row_number().over(Window.partitionBy("customer_key").orderBy("date_key", "order_id"))
    ).filter("nth <= 2")
)
query(
    "WIN-05",
    "customer_key:i r_score:i f_score:i m_score:i",
    f"select customer_key, r_score, f_score, m_score from ({RFM_SCORES})",
)(lambda ws: customer_reports.rfm_scores(ws.dw))
query(
    "WIN-05-sevenths",
    "order_id:s order_item_id:i tile:i",
    "select order_id, order_item_id, ntile(7) over (order by price desc, order_id, order_item_id) as tile from fact_sales",
)(
    lambda ws: with_ntile(
        ws.dw["fact_sales"].select("order_id", "order_item_id", "price"), 7, [F.desc("price"), "order_id", "order_item_id"], "tile"
    )
)
query(
    "WIN-06",
    "order_id:s position:i",
    "select order_id, row_number() over (order by order_value desc, order_id) as position from order_totals",
)(lambda ws: with_position(x.order_totals(ws.raw), [F.desc("order_value"), "order_id"], "position"))

# Sorting ---------------------------------------------------------------------------------
query(
    "SRT-01",
    "place:i order_id:s",
    """select place, order_id from (select order_id, row_number() over (order by delay_days desc nulls first, review_score
        nulls last, order_id) as place from raw_orders left join fact_order_experience using (order_id))""",
)(
    lambda ws: with_position(
        ws.raw["orders"].select("order_id").join(ws.dw["fact_order_experience"], "order_id", "left").select(
            "order_id", "delay_days", "review_score"
        ),
        [F.desc_nulls_first("delay_days"), F.asc_nulls_last("review_score"), "order_id"],
        "place",
    )
)
query(
    "SRT-02",
    "product_key:i revenue:d",
    "select product_key, sum(price) as revenue from fact_sales group by 1 order by revenue desc, product_key limit 50",
)(
    lambda ws: ws.dw["fact_sales"].groupBy("product_key").agg(F.sum("price").alias("revenue")).orderBy(
        F.desc("revenue"), "product_key"
    ).limit(50)
)
query(
    "SRT-03",
    "seller_id:s revenue:d end:s",
    """(select seller_id, sum(price) as revenue, 'head' as "end" from raw_order_items group by 1
        order by revenue desc, seller_id limit 5)
    union all (select seller_id, sum(price) as revenue, 'tail' as "end" from raw_order_items group by 1
        order by revenue, seller_id limit 5)""",
)(lambda ws: _both_ends(ws.raw["order_items"].groupBy("seller_id").agg(F.sum("price").alias("revenue"))))


def _both_ends(df):
    head = df.orderBy(F.desc("revenue"), "seller_id").limit(5).withColumn("end", F.lit("head"))
    return head.unionByName(df.orderBy("revenue", "seller_id").limit(5).withColumn("end", F.lit("tail")))


query("SRT-04", "orders:i n:i", "select orders, count(*) as n from person_orders group by 1 order by orders")(
    lambda ws: p.value_counts(p.orders_per_person(ws.raw), "orders").orderBy("orders")
)
query(
    "SRT-05",
    "order_id:s customer_id:s end:s",
    """(select order_id, customer_id, 'head' as "end" from raw_orders order by pos limit 3)
    union all (select order_id, customer_id, 'tail' as "end" from raw_orders order by pos desc limit 3)""",
)(
    lambda ws: p.preview(ws.raw["orders"], [POS]).withColumn("end", F.lit("head")).unionByName(
        p.preview(ws.raw["orders"], [POS], last=True).withColumn("end", F.lit("tail"))
    )
)
query(
    "SRT-06",
    "is_late_delivery:b orders:i",
    "select is_late_delivery, count(*) as orders from fact_order_experience group by 1 order by 1",
)(
    lambda ws: ws.dw["fact_order_experience"].groupBy("is_late_delivery").agg(rows().alias("orders")).orderBy("is_late_delivery")
)

# Set operations --------------------------------------------------------------------------
query(
    "SET-01",
    "fact:s order_id:s",
    """select 'sales' as fact, order_id from fact_sales union all select 'payments', order_id from fact_payments
    union all select 'experience', order_id from fact_order_experience""",
)(
    lambda ws: ws.dw["fact_sales"].select(F.lit("sales").alias("fact"), "order_id")
    .unionByName(ws.dw["fact_payments"].select(F.lit("payments").alias("fact"), "order_id"))
    .unionByName(ws.dw["fact_order_experience"].select(F.lit("experience").alias("fact"), "order_id"))
)
query(
    "SET-02",
    "payment_type:s payment_installments:n",
    "select distinct payment_type, payment_installments from raw_payments",
)(lambda ws: ws.raw["payments"].select("payment_type", "payment_installments").dropDuplicates())
