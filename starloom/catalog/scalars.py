"""Scalar functions, each over a whole raw or warehouse column."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.catalog.ctes import half_up, title, whole_days
from starloom.catalog.registry import query
from starloom.functions import calendar, labels, numeric, text
from starloom.operators.positions import with_surrogate_key
from starloom.plans import exploration, profiling
from starloom.plans.facts import last_review
from starloom.schemas import POS

BOUGHT, RECEIVED, PROMISED = "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"


def on_orders(id: str, column: str, expression, sql: str):
    """A function of the purchase time of every order."""
    query(id, f"order_id:s {column}", f"select order_id, {sql} as {column.split(':')[0]} from raw_orders")(
        lambda ws: ws.raw["orders"].select("order_id", expression(F.col(BOUGHT)).alias(column.split(":")[0]))
    )


query(
    "FN-01",
    "seller_id:s seller_state:s seller_city:s",
    "select seller_id, trim(seller_state) as seller_state, trim(seller_city) as seller_city from raw_sellers",
)(lambda ws: ws.raw["sellers"].select("seller_id", *[text.strip(F.col(c)).alias(c) for c in ("seller_state", "seller_city")]))
query(
    "FN-02",
    "customer_id:s state_upper:s city_lower:s",
    "select customer_id, upper(customer_state) as state_upper, lower(customer_city) as city_lower from raw_customers",
)(
    lambda ws: ws.raw["customers"].select(
        "customer_id", F.upper("customer_state").alias("state_upper"), F.lower("customer_city").alias("city_lower")
    )
)
query(
    "FN-03",
    "customer_id:s customer_city:s",
    f"select customer_id, {title('customer_city')} as customer_city from raw_customers",
)(lambda ws: ws.raw["customers"].select("customer_id", text.clean_title(F.col("customer_city")).alias("customer_city")))
query(
    "FN-04",
    "product_id:s category:s weight:d",
    """select product_id, coalesce(product_category_name, 'unknown') as category, coalesce(product_weight_g, 0) as weight
    from raw_products""",
)(
    lambda ws: ws.raw["products"].fillna({"product_category_name": "unknown", "product_weight_g": 0}).select(
        "product_id", F.col("product_category_name").alias("category"), F.col("product_weight_g").alias("weight")
    )
)
query(
    "FN-05",
    "product_id:s photos:n weight_int:n weight_float:d",
    """select product_id, trunc(product_photos_qty)::int as photos, trunc(product_weight_g)::int as weight_int,
        product_weight_g::double as weight_float from raw_products""",
)(
    lambda ws: ws.raw["products"].select(
        "product_id",
        F.col("product_photos_qty").cast("int").alias("photos"),
        F.col("product_weight_g").cast("int").alias("weight_int"),
        F.col("product_weight_g").cast("double").alias("weight_float"),
    )
)
query(
    "FN-06",
    "order_id:s review_score:n",
    """select o.order_id, r.review_score from raw_orders o
    left join (select order_id, arg_max(review_score, pos) as review_score from raw_reviews group by order_id) r using (order_id)""",
)(lambda ws: ws.raw["orders"].select("order_id").join(last_review(ws.raw["reviews"]), "order_id", "left"))
query(
    "FN-07",
    "order_id:s bought:s received:s",
    f"""select order_id, strftime({BOUGHT}, '%Y-%m-%d %H:%M:%S') as bought,
        strftime({RECEIVED}, '%Y-%m-%d %H:%M:%S') as received from raw_orders""",
)(lambda ws: ws.extracted["orders"].select("order_id", F.col(BOUGHT).alias("bought"), F.col(RECEIVED).alias("received")))
on_orders("FN-08", "date_key:i", calendar.date_key, f"strftime({BOUGHT}, '%Y%m%d')::int")
query(
    "FN-09",
    "order_id:s delivery_days:n delay_days:n",
    f"""select order_id, {whole_days(RECEIVED, BOUGHT)} as delivery_days, {whole_days(RECEIVED, PROMISED)} as delay_days
    from raw_orders""",
)(
    lambda ws: ws.raw["orders"].select(
        "order_id",
        calendar.elapsed_days(F.col(RECEIVED), F.col(BOUGHT)).alias("delivery_days"),
        calendar.elapsed_days(F.col(RECEIVED), F.col(PROMISED)).alias("delay_days"),
    )
)
query(
    "FN-10",
    "order_id:s calendar_days:n",
    f"select order_id, {RECEIVED}::date - {BOUGHT}::date as calendar_days from raw_orders",
)(lambda ws: ws.raw["orders"].select("order_id", F.datediff(RECEIVED, BOUGHT).alias("calendar_days")))
query(
    "FN-11",
    "order_id:s is_late:b",
    f"select order_id, coalesce({whole_days(RECEIVED, PROMISED)} > 0, false) as is_late from raw_orders",
)(
    lambda ws: ws.raw["orders"].select(
        "order_id", calendar.is_late(calendar.elapsed_days(F.col(RECEIVED), F.col(PROMISED))).alias("is_late")
    )
)
query(
    "FN-12",
    "order_id:s year:i quarter:i month:i day:i",
    f"""select order_id, year({BOUGHT}) as year, quarter({BOUGHT}) as quarter, month({BOUGHT}) as month, day({BOUGHT}) as day
    from raw_orders""",
)(
    lambda ws: ws.raw["orders"].select(
        "order_id", F.year(BOUGHT).alias("year"), F.quarter(BOUGHT).alias("quarter"), F.month(BOUGHT).alias("month"), F.day(BOUGHT).alias("day")
    )
)
on_orders("FN-13", "week:i", F.weekofyear, f"weekofyear({BOUGHT})")
on_orders("FN-14", "weekday:i", calendar.iso_weekday, f"isodow({BOUGHT})")
query(
    "FN-15",
    "order_id:s month_name:s day_name:s",
    f"select order_id, strftime({BOUGHT}, '%B') as month_name, strftime({BOUGHT}, '%A') as day_name from raw_orders",
)(
    lambda ws: ws.raw["orders"].select(
        "order_id", F.date_format(BOUGHT, "MMMM").alias("month_name"), F.date_format(BOUGHT, "EEEE").alias("day_name")
    )
)
on_orders("FN-16", "is_weekend:b", lambda c: calendar.iso_weekday(c).isin(6, 7), f"isodow({BOUGHT}) in (6, 7)")
query(
    "FN-17",
    "product_id:s avg_price:d freight_pct:d",
    f"""select product_id, {half_up('sum((price * 100)::bigint)', 'count(price) * 100', 2)} as avg_price,
        {half_up('sum((freight_value * 100)::bigint) * 100', 'sum((price * 100)::bigint)', 1)} as freight_pct
    from raw_order_items group by product_id""",
)(
    lambda ws: ws.raw["order_items"].groupBy("product_id").agg(
        numeric.average_money(F.col("price")).alias("avg_price"),
        numeric.percent(F.sum("freight_value"), F.sum("price"), 1, numeric.WIDE).alias("freight_pct"),
    )
)
query(
    "FN-18",
    "order_id:s price:d freight_value:d lines:i",
    "select order_id, price, freight_value, count(*) as lines from raw_order_items group by order_id, price, freight_value",
)(
    lambda ws: ws.raw["order_items"].select(
        "order_id", F.round("price", 2).alias("price"), F.round("freight_value", 2).alias("freight_value")
    ).groupBy("order_id", "price", "freight_value").agg(F.count(F.lit(1)).alias("lines"))
)
on_orders(
    "FN-19",
    "quarter_label:s",
    lambda c: labels.quarter_label(F.year(c), F.quarter(c)),
    f"'Q' || quarter({BOUGHT}) || '-' || year({BOUGHT})",
)
query(
    "FN-20",
    "seller_id:s message:s",
    "select seller_id, seller_id || ' has ' || count(*) || ' items' as message from raw_order_items group by seller_id",
)(
    lambda ws: ws.raw["order_items"].groupBy("seller_id").agg(F.count(F.lit(1)).alias("n")).select(
        "seller_id", F.concat("seller_id", F.lit(" has "), F.col("n"), F.lit(" items")).alias("message")
    )
)
query(
    "FN-21",
    "order_id:s delivery_bucket:s delivery_status:s",
    """select order_id, case when delivery_days > 30 then '5. > 30 days' when delivery_days > 21 then '4. 22-30 days'
        when delivery_days > 14 then '3. 15-21 days' when delivery_days > 7 then '2. 8-14 days' else '1. <= 7 days' end
        as delivery_bucket, if(is_late_delivery, 'Late', 'On Time') as delivery_status from fact_order_experience""",
)(
    lambda ws: ws.dw["fact_order_experience"].select(
        "order_id",
        labels.delivery_bucket(F.col("delivery_days")).alias("delivery_bucket"),
        labels.delivery_status(F.col("is_late_delivery")).alias("delivery_status"),
    )
)
query(
    "FN-22",
    "order_id:s price_per_freight:d",
    f"""select order_id, {half_up('sum((price * 100)::bigint)', 'sum((freight_value * 100)::bigint)', 2)} as price_per_freight
    from fact_sales group by order_id""",
)(
    lambda ws: ws.dw["fact_sales"].groupBy("order_id").agg(
        F.round(
            F.sum("price").cast(numeric.WIDE) / F.nullif(F.sum("freight_value").cast(numeric.WIDE), F.lit(0).cast(numeric.WIDE)), 2
        ).alias("price_per_freight")
    )
)
query(
    "FN-23",
    "order_id:s number:i day:s paid:d",
    f"""select order_id, substr(order_id, 2)::bigint as number, {BOUGHT}::date as day, order_value::decimal(20,2) as paid
    from raw_orders join order_totals using (order_id)""",
)(
    lambda ws: ws.raw["orders"].join(exploration.order_totals(ws.raw), "order_id").select(
        "order_id",
        F.substr("order_id", F.lit(2)).cast("bigint").alias("number"),
        F.col(BOUGHT).cast("date").alias("day"),
        F.col("order_value").cast("decimal(20,2)").alias("paid"),
    )
)
on_orders("FN-24", "year_month:s", calendar.month_period, f"strftime({BOUGHT}, '%Y-%m')")
INSTALLMENT_SQL = """case when payment_installments > 6 then '7+' when payment_installments > 3 then '4-6'
    when payment_installments > 1 then '2-3' else '1 installment' end"""
query(
    "FN-25",
    "order_id:s payment_sequential:i installment_group:s",
    f"select order_id, payment_sequential, {INSTALLMENT_SQL} as installment_group from fact_payments",
)(
    lambda ws: ws.dw["fact_payments"].select(
        "order_id", "payment_sequential", labels.installment_group(F.col("payment_installments")).alias("installment_group")
    )
)
query(
    "FN-26",
    "first_month:s last_month:s first_day:s last_day:s",
    f"""select min(strftime({BOUGHT}, '%Y-%m')) as first_month, max(strftime({BOUGHT}, '%Y-%m')) as last_month,
        min({BOUGHT})::date as first_day, max({BOUGHT})::date as last_day from raw_orders""",
)(
    lambda ws: ws.raw["orders"].agg(
        calendar.month_period(F.min(BOUGHT)).alias("first_month"),
        calendar.month_period(F.max(BOUGHT)).alias("last_month"),
        F.min(BOUGHT).cast("date").alias("first_day"),
        F.max(BOUGHT).cast("date").alias("last_day"),
    )
)

query(
    "UDF-01",
    "installment_group:s payments:i paid:d",
    f"""select {INSTALLMENT_SQL} as installment_group, count(*) as payments, sum(payment_value) as paid
    from fact_payments group by installment_group""",
)(
    lambda ws: ws.dw["fact_payments"].groupBy(labels.installment_group(F.col("payment_installments")).alias("installment_group")).agg(
        F.count(F.lit(1)).alias("payments"), F.sum("payment_value").alias("paid")
    )
)
query(
    "UDF-02",
    "customer_unique_id:s recency:i",
    f"""select customer_unique_id, {whole_days(f'(select max({BOUGHT}) from raw_orders)', f'max({BOUGHT})')} as recency
    from raw_orders join raw_customers using (customer_id) group by customer_unique_id""",
)(
    lambda ws: ws.raw["orders"].join(ws.raw["customers"], "customer_id").groupBy("customer_unique_id").agg(
        F.max(BOUGHT).alias("last")
    ).select(
        "customer_unique_id",
        calendar.elapsed_days(ws.raw["orders"].agg(F.max(BOUGHT)).scalar(), F.col("last")).alias("recency"),
    )
)
query(
    "UDF-03",
    "row_key:i order_id:s",
    "select row_number() over (order by pos) as row_key, order_id from raw_reviews",
)(lambda ws: with_surrogate_key(ws.raw["reviews"].select("order_id", POS), "row_key", [POS]))
query(
    "UDF-04",
    "order_id:s received_key:n",
    f"select order_id, strftime({RECEIVED}, '%Y%m%d')::int as received_key from raw_orders",
)(lambda ws: ws.raw["orders"].select("order_id", calendar.date_key(F.col(RECEIVED)).alias("received_key")))


@query(
    "UDF-05",
    "rows:i columns:i missing_columns:i duplicates:i sample_rows:i",
    """select count(*) as rows, 6 as columns,
        (count(product_category_name) < count(*))::int + (count(product_name_lenght) < count(*))::int
            + (count(product_description_lenght) < count(*))::int + (count(product_photos_qty) < count(*))::int
            + (count(product_weight_g) < count(*))::int as missing_columns,
        count(*) - (select count(*) from (select distinct * exclude (pos) from raw_products)) as duplicates,
        3 as sample_rows from raw_products""",
)
def explored_products(ws):
    found = profiling.explore_table("products", ws.raw["products"])
    return found["shape"].select(
        "rows",
        "columns",
        found["missing"].agg(F.count(F.lit(1))).scalar().alias("missing_columns"),
        found["duplicates"].scalar().alias("duplicates"),
        found["sample"].agg(F.count(F.lit(1))).scalar().alias("sample_rows"),
    )
