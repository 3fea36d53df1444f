"""Exploratory questions over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.catalog.ctes import describe, half_up, mean, mean_money
from starloom.catalog.registry import query
from starloom.plans import exploration as x

DESCRIBE_COLUMNS = "measure:s count:i mean:d std:d min:d q25:d q50:d q75:d max:d"


def rounded(described: DataFrame) -> DataFrame:
    """Four digits: the last bits of a floating point mean depend on the order of addition."""
    return described.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


PAID_ORDERS = "raw_orders join order_totals using (order_id) join raw_customers using (customer_id)"

query(
    "XPL-01",
    "year_month:s revenue:d",
    """select strftime(order_purchase_timestamp, '%Y-%m') as year_month, sum(order_value) as revenue
    from raw_orders join order_totals using (order_id) group by year_month""",
)(lambda ws: x.monthly_revenue(ws.raw))
query(
    "XPL-02",
    "product_category_name_english:s revenue:d",
    """select product_category_name_english, sum(price) as revenue from named_items
    where product_category_name_english is not null group by product_category_name_english""",
)(lambda ws: x.category_revenue(ws.raw))
query(
    "XPL-03",
    "customer_state:s avg_order_value:d",
    f"select customer_state, {mean_money('order_value', 6)} as avg_order_value from {PAID_ORDERS} group by customer_state",
)(lambda ws: x.order_value_by_state(ws.raw))
query(
    "XPL-04",
    "customer_unique_id:s lifetime_value:d",
    f"select customer_unique_id, sum(order_value) as lifetime_value from {PAID_ORDERS} group by customer_unique_id",
)(lambda ws: x.lifetime_value(ws.raw))
query(
    "XPL-05",
    "total_customers:i repeat_customers:i repeat_rate_pct:d",
    f"""select count(*) as total_customers, count(*) filter (orders > 1) as repeat_customers,
        {half_up('count(*) filter (orders > 1) * 100', 'count(*)', 6)} as repeat_rate_pct from person_orders""",
)(lambda ws: x.repeat_rate(ws.raw))
query(
    "XPL-05-distribution",
    "orders:i customers:i",
    "select orders, count(*) as customers from person_orders group by orders order by orders limit 10",
)(lambda ws: x.order_count_distribution(ws.raw))
RFM = f"""(select customer_unique_id,
        floor(date_diff('second', max(order_purchase_timestamp), (select max(order_purchase_timestamp) from raw_orders))
            / 86400.0)::bigint as recency,
        count(order_id) as frequency, sum(order_value) as monetary from {PAID_ORDERS} group by customer_unique_id)"""
query(
    "XPL-06",
    "customer_unique_id:s recency:i frequency:i monetary:d",
    f"select customer_unique_id, recency, frequency, monetary from {RFM}",
)(lambda ws: x.rfm_base(ws.raw))
query(
    "XPL-06-describe",
    DESCRIBE_COLUMNS,
    " union all ".join(describe(RFM, c) for c in ("recency", "frequency", "monetary")),
)(lambda ws: rounded(x.rfm_profile(ws.raw)))
query(
    "XPL-07",
    "seller_id:s revenue:d avg_review:d",
    f"""select seller_id, revenue, avg_review
    from (select seller_id, sum(price) as revenue from raw_order_items group by seller_id)
    join (select seller_id, {mean('review_score', 6)} as avg_review
        from raw_order_items join raw_reviews using (order_id) group by seller_id) using (seller_id)""",
)(lambda ws: x.seller_performance(ws.raw))
query(
    "XPL-08",
    "seller_id:s avg_delay_days:d",
    f"""select seller_id, {mean('delay_days', 6)} as avg_delay_days
    from raw_order_items join received_orders using (order_id) group by seller_id""",
)(lambda ws: x.seller_delay(ws.raw))
query(
    "XPL-09",
    "customer_state:s revenue:d",
    f"select customer_state, sum(order_value) as revenue from {PAID_ORDERS} group by customer_state",
)(lambda ws: x.state_revenue(ws.raw))
query(
    "XPL-10",
    "payment_type:s payments:i",
    "select payment_type, count(*) as payments from raw_payments group by payment_type",
)(lambda ws: x.payment_distribution(ws.raw))
query(
    "XPL-10-value",
    "payment_type:s avg_order_value:d",
    f"""select payment_type, {mean_money('v', 6)} as avg_order_value
    from (select order_id, payment_type, sum(payment_value) as v from raw_payments group by order_id, payment_type)
    group by payment_type""",
)(lambda ws: x.order_value_by_payment_type(ws.raw))
query(
    "XPL-11",
    "installments:i avg_order_value:d",
    f"""select n as installments, {mean_money('v', 6)} as avg_order_value
    from (select order_id, max(payment_installments) as n, sum(payment_value) as v from raw_payments
        where payment_type = 'credit_card' group by order_id) where n is not null group by n""",
)(lambda ws: x.order_value_by_installments(ws.raw))
query(
    "XPL-12",
    "customer_state:s avg_delivery_days:d avg_delay_days:d",
    f"""select customer_state, {mean('delivery_days', 6)} as avg_delivery_days, {mean('delay_days', 6)} as avg_delay_days
    from received_orders join raw_customers using (customer_id) group by customer_state""",
)(lambda ws: x.delivery_by_state(ws.raw))
query(
    "XPL-13",
    "late_rate_pct:d on_time_rate_pct:d total_delivered:i",
    f"""select {half_up('count(*) filter (delay_days > 0) * 100', 'count(*)', 6)} as late_rate_pct,
        {half_up('count(*) filter (delay_days <= 0) * 100', 'count(*)', 6)} as on_time_rate_pct,
        count(*) as total_delivered from received_orders""",
)(lambda ws: x.late_rate(ws.raw))
query(
    "XPL-14",
    "is_late:b avg_review_score:d reviews:i",
    f"""select delay_days > 0 as is_late, {mean('review_score', 6)} as avg_review_score, count(*) as reviews
    from received_orders join raw_reviews using (order_id) group by is_late""",
)(lambda ws: x.review_by_lateness(ws.raw))
query(
    "XPL-15",
    "correlation:d",
    "select round(corr(delivery_days, review_score), 4) as correlation from received_orders join raw_reviews using (order_id)",
)(lambda ws: x.delivery_review_correlation(ws.raw))
RATED = f"""(select product_category_name_english, {mean('review_score', 6)} as avg_review_score
    from named_items join raw_reviews using (order_id) where product_category_name_english is not null
    group by product_category_name_english)"""
query(
    "XPL-16",
    "product_category_name_english:s avg_review_score:d",
    f"select * from {RATED}",
)(lambda ws: x.category_ratings(ws.raw))
query(
    "XPL-16-ends",
    "product_category_name_english:s avg_review_score:d end:s",
    f"""(select *, 'top' as "end" from {RATED} order by avg_review_score desc, product_category_name_english limit 5)
    union all (select *, 'bottom' as "end" from {RATED} order by avg_review_score, product_category_name_english desc limit 5)""",
)(lambda ws: x.best_and_worst_categories(ws.raw))
