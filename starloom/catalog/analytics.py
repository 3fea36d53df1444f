"""The business questions over the warehouse."""

from __future__ import annotations

from starloom.catalog.ctes import cents, half_up, mean, mean_money, pct
from starloom.catalog.registry import query
from starloom.plans import customers, logistics, payments, revenue, sellers

BASE_YEAR, NEXT_YEAR = 1996, 1997  # two full years of the test tables

PAID = "fact_payments f join dim_date d on f.date_key = d.date_key"

query(
    "QRY-01",
    "year:i month:i month_name:s total_revenue:d total_orders:i avg_order_value:d mom_growth_pct:d",
    f"""select year, month, month_name, total_revenue, total_orders, avg_order_value,
        {pct('((total_revenue - prev) * 100)::bigint', '(prev * 100)::bigint')} as mom_growth_pct
    from (select *, lag(total_revenue) over (order by year, month) as prev
        from (select year, month, month_name, sum(payment_value) as total_revenue, count(distinct order_id) as total_orders,
                {mean_money('payment_value')} as avg_order_value
            from {PAID} group by year, month, month_name))""",
)(lambda ws: revenue.monthly_revenue(ws.dw))

query(
    "QRY-02",
    "year:i quarter:i quarter_label:s total_revenue:d total_orders:i",
    f"""select year, quarter, 'Q' || quarter || '-' || year as quarter_label, sum(payment_value) as total_revenue,
        count(distinct order_id) as total_orders from {PAID} group by year, quarter""",
)(lambda ws: revenue.quarterly_revenue(ws.dw))

query(
    "QRY-03",
    "category_name_english:s total_revenue:d total_orders:i units_sold:i revenue_share_pct:d",
    f"""select category_name_english, sum(price) as total_revenue, count(distinct order_id) as total_orders,
        count(*) as units_sold, {pct(cents('price'), f"sum({cents('price')}) over ()")} as revenue_share_pct
    from fact_sales join dim_product using (product_key) group by category_name_english
    order by total_revenue desc, category_name_english limit 20""",
)(lambda ws: revenue.category_ranking(ws.dw))

_BASE = f"sum(case when year = {BASE_YEAR} then price else 0 end)"
_NEXT = f"sum(case when year = {NEXT_YEAR} then price else 0 end)"
query(
    "QRY-04",
    f"category_name_english:s revenue_{BASE_YEAR}:d revenue_{NEXT_YEAR}:d yoy_growth_pct:d",
    f"""select category_name_english, {_BASE} as revenue_{BASE_YEAR}, {_NEXT} as revenue_{NEXT_YEAR},
        {pct(f'(({_NEXT} - {_BASE}) * 100)::bigint', f'({_BASE} * 100)::bigint')} as yoy_growth_pct
    from fact_sales join dim_product using (product_key) join dim_date using (date_key)
    group by category_name_english having {_BASE} > 0""",
)(lambda ws: revenue.category_growth(ws.dw, BASE_YEAR, NEXT_YEAR))

query(
    "QRY-05",
    "customer_state:s total_orders:i total_revenue:d avg_order_value:d",
    f"""select customer_state, count(distinct order_id) as total_orders, sum(payment_value) as total_revenue,
        {mean_money('payment_value')} as avg_order_value
    from fact_payments join dim_customer using (customer_key) group by customer_state""",
)(lambda ws: revenue.order_value_by_state(ws.dw))

query(
    "QRY-06",
    "customer_unique_id:s customer_state:s customer_city:s total_orders:i lifetime_value:d avg_order_value:d",
    f"""select customer_unique_id, customer_state, customer_city, count(distinct order_id) as total_orders,
        sum(payment_value) as lifetime_value, {mean_money('payment_value')} as avg_order_value
    from fact_payments join dim_customer using (customer_key)
    group by customer_unique_id, customer_state, customer_city
    order by lifetime_value desc, customer_unique_id limit 50""",
)(lambda ws: customers.lifetime_value(ws.dw))

query(
    "QRY-07",
    "total_customers:i repeat_customers:i repeat_rate_pct:d avg_orders_per_customer:d",
    f"""select count(*) as total_customers, count(*) filter (n > 1) as repeat_customers,
        {pct('count(*) filter (n > 1)', 'count(*)')} as repeat_rate_pct, {mean('n', 2)} as avg_orders_per_customer
    from (select customer_key, count(distinct order_id) as n from fact_payments group by customer_key)""",
)(lambda ws: customers.repeat_rate(ws.dw))

_GAP = """select {avg} as avg_days_to_second_order, min(b.full_date - a.full_date) as min_days,
        max(b.full_date - a.full_date) as max_days
    from ({ranked}) a join ({ranked}) b on a.customer_key = b.customer_key and a.nth = 1 and b.nth = 2"""
_RANK = """select customer_key, full_date, row_number() over (partition by customer_key order by full_date) as nth
    from ({rows}) join dim_date using (date_key)"""
_DAYS = mean("b.full_date - a.full_date", 0)
query(
    "QRY-08",
    "avg_days_to_second_order:d min_days:i max_days:i",
    _GAP.format(avg=_DAYS, ranked=_RANK.format(rows="select customer_key, date_key from fact_payments")),
)(lambda ws: customers.days_to_second_payment(ws.dw))
query(
    "QRY-08b",
    "avg_days_to_second_order:d min_days:i max_days:i",
    _GAP.format(
        avg=_DAYS,
        ranked=_RANK.format(rows="select distinct customer_key, order_id, date_key from fact_payments"),
    ),
)(lambda ws: customers.days_to_second_order(ws.dw))

RFM_SCORES = """select *, ntile(5) over (order by recency_days desc, customer_key) as r_score,
        ntile(5) over (order by frequency, customer_key) as f_score,
        ntile(5) over (order by monetary, customer_key) as m_score
    from (select customer_key, (select max(full_date) from fact_payments join dim_date using (date_key)) - max(full_date)
            as recency_days, count(distinct order_id) as frequency, sum(payment_value) as monetary
        from fact_payments join dim_date using (date_key) group by customer_key)"""
# Names and thresholds of the segments.
query(
    "QRY-09",
    "segment:s customer_count:i avg_recency_days:d avg_frequency:d avg_monetary:d",
    f"""select segment, count(*) as customer_count, {mean('recency_days', 0)} as avg_recency_days,
        {mean('frequency', 2)} as avg_frequency, {mean_money('monetary')} as avg_monetary
    from (select *, case when r_score >= 4 and f_score >= 4 then 'Champions' when r_score >= 3 and f_score >= 3 then 'Loyal Customers'
            when r_score >= 4 and f_score <= 2 then 'Recent Customers' when r_score <= 2 and f_score >= 3 then 'At Risk'
            when r_score = 1 and f_score = 1 then 'Lost' else 'Potential Loyalists' end as segment
        from ({RFM_SCORES})) group by segment""",
)(lambda ws: customers.rfm_segments(ws.dw))

query(
    "QRY-10",
    "customer_state:s unique_customers:i total_orders:i total_revenue:d avg_order_value:d",
    f"""select customer_state, count(distinct customer_key) as unique_customers, count(distinct order_id) as total_orders,
        sum(payment_value) as total_revenue, {mean_money('payment_value')} as avg_order_value
    from fact_payments join dim_customer using (customer_key) group by customer_state""",
)(lambda ws: revenue.revenue_by_state(ws.dw))

SOLD_AND_RECEIVED = "fact_sales s join fact_order_experience e on s.order_id = e.order_id"
query(
    "QRY-11",
    "seller_id:s seller_state:s seller_city:s total_orders:i total_revenue:d avg_review_score:d",
    f"""select seller_id, seller_state, seller_city, count(distinct s.order_id) as total_orders, sum(price) as total_revenue,
        {mean('review_score', 2)} as avg_review_score
    from {SOLD_AND_RECEIVED} join dim_seller using (seller_key) where review_score is not null
    group by seller_id, seller_state, seller_city having count(distinct s.order_id) >= 10
    order by avg_review_score desc, total_revenue desc, seller_id limit 20""",
)(lambda ws: sellers.best_sellers(ws.dw))

query(
    "QRY-12",
    "seller_id:s seller_state:s total_orders:i late_orders:i late_delivery_rate_pct:d avg_delay_days:d",
    f"""select seller_id, seller_state, count(distinct s.order_id) as total_orders,
        count(*) filter (is_late_delivery) as late_orders,
        {pct('count(*) filter (is_late_delivery)', 'count(distinct s.order_id)')} as late_delivery_rate_pct,
        {mean('delay_days', 1)} as avg_delay_days
    from {SOLD_AND_RECEIVED} join dim_seller using (seller_key)
    group by seller_id, seller_state having count(distinct s.order_id) >= 10
    order by late_delivery_rate_pct desc, seller_id limit 20""",
)(lambda ws: sellers.delayed_sellers(ws.dw))

query(
    "QRY-13",
    "payment_type:s total_orders:i total_revenue:d avg_order_value:d order_share_pct:d",
    f"""select *, {pct('total_orders', 'sum(total_orders) over ()')} as order_share_pct
    from (select payment_type, count(distinct order_id) as total_orders, sum(payment_value) as total_revenue,
            {mean_money('payment_value')} as avg_order_value
        from fact_payments join dim_payment using (payment_key) group by payment_type)""",
)(lambda ws: payments.payment_mix(ws.dw))

query(
    "QRY-14",
    "payment_installments:i total_orders:i avg_order_value:d total_revenue:d",
    f"""select payment_installments, count(distinct order_id) as total_orders, {mean_money('payment_value')} as avg_order_value,
        sum(payment_value) as total_revenue
    from fact_payments join dim_payment using (payment_key) where payment_type = 'credit_card' group by payment_installments""",
)(lambda ws: payments.installments(ws.dw))

query(
    "QRY-15",
    "customer_state:s delivered_orders:i avg_delivery_days:d min_delivery_days:i max_delivery_days:i",
    f"""select customer_state, count(*) as delivered_orders, {mean('delivery_days', 1)} as avg_delivery_days,
        min(delivery_days) as min_delivery_days, max(delivery_days) as max_delivery_days
    from fact_order_experience join dim_customer using (customer_key) where delivery_days is not null
    group by customer_state""",
)(lambda ws: logistics.delivery_time_by_state(ws.dw))

query(
    "QRY-16",
    "total_delivered:i late_orders:i on_time_orders:i late_delivery_rate_pct:d on_time_rate_pct:d",
    f"""select count(*) as total_delivered, count(*) filter (is_late_delivery) as late_orders,
        count(*) filter (not is_late_delivery) as on_time_orders,
        {pct('count(*) filter (is_late_delivery)', 'count(*)')} as late_delivery_rate_pct,
        {pct('count(*) filter (not is_late_delivery)', 'count(*)')} as on_time_rate_pct
    from fact_order_experience""",
)(lambda ws: logistics.late_rate(ws.dw))

query(
    "QRY-17",
    "customer_state:s total_orders:i late_orders:i late_rate_pct:d avg_delay_days_when_late:d",
    f"""select customer_state, count(*) as total_orders, count(*) filter (is_late_delivery) as late_orders,
        {pct('count(*) filter (is_late_delivery)', 'count(*)')} as late_rate_pct,
        {half_up('sum(delay_days) filter (delay_days > 0)', 'count(*) filter (delay_days > 0)', 1)} as avg_delay_days_when_late
    from fact_order_experience join dim_customer using (customer_key) group by customer_state""",
)(lambda ws: logistics.delay_by_state(ws.dw))

query(
    "QRY-18",
    "delivery_bucket:s order_count:i avg_review_score:d",
    f"""select delivery_bucket, count(*) as order_count, {mean('review_score', 2)} as avg_review_score
    from (select review_score, case when delivery_days < 8 then '1. <= 7 days' when delivery_days < 15 then '2. 8-14 days'
            when delivery_days < 22 then '3. 15-21 days' when delivery_days < 31 then '4. 22-30 days'
            else '5. > 30 days' end as delivery_bucket
        from fact_order_experience where delivery_days is not null and review_score is not null)
    group by delivery_bucket""",
)(lambda ws: logistics.rating_by_delivery_time(ws.dw))

query(
    "QRY-19",
    "delivery_status:s total_orders:i avg_review_score:d negative_reviews:i negative_review_rate_pct:d "
    "five_star_reviews:i five_star_rate_pct:d",
    f"""select if(is_late_delivery, 'Late', 'On Time') as delivery_status, count(*) as total_orders,
        {mean('review_score', 2)} as avg_review_score, count(*) filter (review_score < 3) as negative_reviews,
        {pct('count(*) filter (review_score < 3)', 'count(*)')} as negative_review_rate_pct,
        count(*) filter (review_score = 5) as five_star_reviews,
        {pct('count(*) filter (review_score = 5)', 'count(*)')} as five_star_rate_pct
    from fact_order_experience where review_score is not null group by is_late_delivery""",
)(lambda ws: logistics.rating_by_lateness(ws.dw))

query(
    "QRY-20",
    "product_id:s category_name_english:s orders:i units_sold:i total_revenue:d avg_price:d",
    f"""select product_id, category_name_english, count(distinct order_id) as orders, count(*) as units_sold,
        sum(price) as total_revenue, {mean_money('price')} as avg_price
    from fact_sales join dim_product using (product_key) group by product_id, category_name_english
    order by total_revenue desc, product_id limit 20""",
)(lambda ws: revenue.top_products(ws.dw))

query(
    "QRY-21",
    "category_name_english:s total_reviews:i avg_review_score:d five_star:i one_star:i positive_rate_pct:d",
    f"""select category_name_english, count(*) as total_reviews, {mean('review_score', 2)} as avg_review_score,
        count(*) filter (review_score = 5) as five_star, count(*) filter (review_score = 1) as one_star,
        {pct('count(*) filter (review_score > 3)', 'count(*)')} as positive_rate_pct
    from {SOLD_AND_RECEIVED} join dim_product using (product_key) where review_score is not null
    group by category_name_english having count(*) >= 50""",
)(lambda ws: sellers.category_ratings(ws.dw))

query(
    "QRY-22",
    "seller_id:s seller_state:s total_orders:i units_sold:i total_revenue:d",
    """select seller_id, seller_state, count(distinct order_id) as total_orders, count(*) as units_sold,
        sum(price) as total_revenue
    from fact_sales join dim_seller using (seller_key) group by seller_id, seller_state
    order by total_revenue desc, seller_id limit 20""",
)(lambda ws: sellers.top_sellers(ws.dw))
