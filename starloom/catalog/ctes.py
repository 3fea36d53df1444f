"""Building blocks of the SQL counterparts: raw tables and warehouse as common table expressions.

Written for an engine other than Spark and independently of the DataFrame code, so that a
mistake on one side shows.
"""

from __future__ import annotations

import re


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """Exact quotient of two integers rounded half away from zero; null for denominator 0."""
    n, d, scale = f"({numerator})::hugeint", f"({denominator})::hugeint", 10**digits
    return f"(sign({n}) * ((2 * abs({n}) * {scale} + {d}) // nullif(2 * {d}, 0)))::double / {scale}"


def cents(expression: str) -> str:
    """Sum of amounts in cents."""
    return f"sum((({expression}) * 100)::bigint)"


def mean(expression: str, digits: int) -> str:
    return half_up(f"sum({expression})", f"count({expression})", digits)


def mean_money(expression: str, digits: int = 2) -> str:
    return half_up(cents(expression), f"count({expression}) * 100", digits)


def pct(numerator: str, denominator: str, digits: int = 2) -> str:
    return half_up(f"({numerator}) * 100", denominator, digits)


def title(expression: str) -> str:
    runs = f"regexp_extract_all(lower(trim({expression})), '[a-z]+|[^a-z]+')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1:1]) || w[2:]), '')"


def whole_days(end: str, start: str) -> str:
    return f"floor(date_diff('second', {start}, {end}) / 86400.0)::bigint"


def describe(relation: str, column: str) -> str:
    """One row of the describe table of a column."""
    return (
        f"select '{column}' as measure, count({column}) as count, round(avg({column}), 4) as mean, "
        f"round(stddev_samp({column}), 4) as std, min({column}) as min, "
        f"round(quantile_cont({column}::double, 0.25), 4) as q25, round(quantile_cont({column}::double, 0.5), 4) as q50, "
        f"round(quantile_cont({column}::double, 0.75), 4) as q75, max({column}) as max from {relation}"
    )


CTES: dict[str, str] = {
    "raw_customers": """
        select concat('c', o_orderkey) as customer_id, concat('u', o_custkey) as customer_unique_id,
            concat(' x', chr(cast(97 + c_nationkey as int)), ' ') as customer_state,
            lower(concat(o_orderpriority, ' d''oeste')) as customer_city, o_orderkey as pos
        from orders join customer on o_custkey = c_custkey""",
    "raw_orders": """
        select concat('o', o_orderkey) as order_id, concat('c', o_orderkey) as customer_id,
            case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'processing' end as order_status,
            o_orderdate + (o_orderkey % 24) * interval '1' hour as order_purchase_timestamp,
            o_orderdate + (o_orderkey % 24 + 1) * interval '1' hour as order_approved_at,
            case when o_orderstatus = 'F' and o_orderkey % 50 <> 0 then o_orderdate
                + (o_orderkey % 24 + o_orderkey % 17 + 24 * (o_orderkey * 11 % 45)) * interval '1' hour end
                as order_delivered_customer_date,
            o_orderdate + interval '21' day as order_estimated_delivery_date, o_orderkey as pos
        from orders""",
    "raw_order_items": """
        select concat('o', l_orderkey) as order_id,
            row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax) as order_item_id,
            concat('p', l_partkey) as product_id, concat('s', l_suppkey) as seller_id,
            cast(l_extendedprice as decimal(10,2)) as price,
            cast(cast(l_extendedprice as decimal(10,2)) * cast(l_tax as decimal(4,2)) as decimal(10,2)) as freight_value,
            l_linenumber as line_number, l_orderkey * 10 + l_linenumber as pos
        from lineitem""",
    "raw_payments": """
        select concat('o', o_orderkey) as order_id, seq as payment_sequential,
            case when seq = 2 then 'voucher' when o_orderpriority in ('1-URGENT', '2-HIGH') then 'credit_card'
                when o_orderpriority = '3-MEDIUM' then 'boleto' when o_orderpriority = '4-NOT SPECIFIED' then 'voucher'
                else 'debit_card' end as payment_type,
            case when o_orderkey % 40 = 0 then null when o_orderkey % 1000 = 7 then 0
                when seq = 1 and o_orderpriority in ('1-URGENT', '2-HIGH') then cast(1 + o_orderkey % 10 as int)
                else 1 end as payment_installments,
            case when o_orderkey % 3 <> 0 then cast(o_totalprice as decimal(10,2))
                when seq = 1 then cast(cast(o_totalprice as decimal(10,2)) * 0.7 as decimal(10,2))
                else cast(cast(o_totalprice as decimal(10,2)) - cast(cast(o_totalprice as decimal(10,2)) * 0.7
                    as decimal(10,2)) as decimal(10,2)) end as payment_value,
            o_orderkey * 2 + seq - 1 as pos
        from orders, (values (1), (2)) copies(seq) where seq = 1 or o_orderkey % 3 = 0""",
    "raw_reviews": """
        select concat('o', o_orderkey) as order_id, cast(1 + (o_orderkey * (31 + seq)) % 5 as smallint) as review_score,
            case when o_orderkey % 4 = 0 then concat('order ', o_orderkey) end as review_comment_title,
            case when o_orderkey % 3 = 0 then concat('status "', o_orderstatus, '",', chr(10), 'prio ', o_orderpriority) end
                as review_comment_message,
            o_orderkey * 2 + seq as pos
        from orders, (values (0), (1)) copies(seq)
        where (seq = 0 and o_orderkey % 10 <> 0) or (seq = 1 and o_orderkey % 97 = 0)""",
    "raw_products": """
        select concat('p', p_partkey) as product_id,
            case when p_partkey % 20 <> 0 then lower(p_type) end as product_category_name,
            case when p_partkey % 20 <> 0 then cast(length(p_name) as double) end as product_name_lenght,
            case when p_partkey % 20 <> 0 then cast(p_size * 10 as double) end as product_description_lenght,
            case when p_partkey % 20 <> 0 then cast(p_size % 5 as double) end as product_photos_qty,
            case when p_partkey % 33 <> 0 then p_retailprice end as product_weight_g, p_partkey as pos
        from part""",
    "raw_sellers": """
        select concat('s', s_suppkey) as seller_id, concat(chr(cast(97 + s_nationkey as int)), 'x ') as seller_state,
            concat('  ', lower(s_name)) as seller_city, s_suppkey as pos
        from supplier""",
    "raw_geolocation": """
        select lpad(cast(c_custkey % 100 as varchar), 5, '0') as geolocation_zip_code_prefix,
            c_acctbal / 100 as geolocation_lat, -c_acctbal / 50 as geolocation_lng, c_custkey as pos
        from customer""",
    "raw_translation": """
        select lower(p_type) as product_category_name, concat(' ', p_type, ' GOODS ') as product_category_name_english,
            min(p_partkey) as pos
        from part where p_type <> 'PROMO' group by p_type""",
    "dim_customer": f"""
        select row_number() over (order by last_pos) as customer_key, customer_unique_id,
            upper(trim(state)) as customer_state, {title('city')} as customer_city
        from (select customer_unique_id, max(pos) as last_pos, arg_max(customer_state, pos) as state,
                arg_max(customer_city, pos) as city
            from raw_customers group by customer_unique_id)""",
    "dim_product": """
        select row_number() over (order by p.pos, t.pos) as product_key, p.product_id,
            lower(trim(coalesce(t.product_category_name_english, 'unknown'))) as category_name_english,
            coalesce(p.product_name_lenght, 0)::int as product_name_length,
            coalesce(p.product_description_lenght, 0)::int as product_description_length,
            coalesce(p.product_photos_qty, 0)::int as photos_qty,
            coalesce(p.product_weight_g, 0)::decimal(10,2) as weight_g
        from raw_products p left join raw_translation t on p.product_category_name = t.product_category_name""",
    "dim_seller": f"""
        select row_number() over (order by pos) as seller_key, seller_id, upper(trim(seller_state)) as seller_state,
            {title('seller_city')} as seller_city
        from raw_sellers""",
    "dim_payment": """
        select payment_key, payment_type, '1 installment' as installment_group
        from (values (1, 'credit_card'), (2, 'boleto'), (3, 'voucher'), (4, 'debit_card'), (5, 'not_defined'))
            seeds(payment_key, payment_type)""",
    "dim_date": """
        select (year(d) * 10000 + month(d) * 100 + day(d))::int as date_key, d::date as full_date, year(d) as year,
            quarter(d) as quarter, month(d) as month, strftime(d, '%B') as month_name, weekofyear(d) as week_of_year,
            day(d) as day_of_month, isodow(d) as day_of_week, strftime(d, '%A') as day_name, isodow(d) >= 6 as is_weekend
        from (select unnest(generate_series(date_trunc('year', min(order_purchase_timestamp)),
                date_trunc('year', max(order_purchase_timestamp)) + interval '1' year - interval '1' day,
                interval '1' day)) as d
            from raw_orders)""",
    "delivered_base": """
        select o.order_id, k.customer_key, k.customer_unique_id, strftime(order_purchase_timestamp, '%Y%m%d')::int as date_key,
            order_purchase_timestamp as bought, order_delivered_customer_date as received,
            order_estimated_delivery_date as promised
        from raw_orders o left join raw_customers c on o.customer_id = c.customer_id
            left join dim_customer k on c.customer_unique_id = k.customer_unique_id
        where order_status = 'delivered'""",
    "fact_sales": """
        select i.order_id, i.order_item_id, d.customer_key, p.product_key, s.seller_key, d.date_key, i.price, i.freight_value
        from raw_order_items i join delivered_base d on i.order_id = d.order_id
            left join dim_product p on i.product_id = p.product_id left join dim_seller s on i.seller_id = s.seller_id""",
    "fact_payments": """
        select p.order_id, p.payment_sequential, d.customer_key, d.date_key, k.payment_key, p.payment_value,
            coalesce(p.payment_installments, 1) as payment_installments
        from raw_payments p join delivered_base d on p.order_id = d.order_id
            left join dim_payment k on p.payment_type = k.payment_type""",
    "fact_order_experience": f"""
        select d.order_id, d.customer_key, d.date_key, {whole_days('received', 'bought')} as delivery_days,
            {whole_days('received', 'promised')} as delay_days, r.review_score,
            {whole_days('received', 'promised')} > 0 as is_late_delivery
        from delivered_base d left join (select order_id, arg_max(review_score, pos) as review_score
                from raw_reviews group by order_id) r on d.order_id = r.order_id
        where received is not null""",
    "person_orders": """
        select customer_unique_id, count(*) as orders
        from raw_orders join raw_customers using (customer_id) group by customer_unique_id""",
    "order_totals": "select order_id, sum(payment_value) as order_value from raw_payments group by order_id",
    "received_orders": f"""
        select order_id, customer_id, {whole_days('order_delivered_customer_date', 'order_purchase_timestamp')} as delivery_days,
            {whole_days('order_delivered_customer_date', 'order_estimated_delivery_date')} as delay_days
        from raw_orders where order_delivered_customer_date is not null""",
    "named_items": """
        select i.*, t.product_category_name_english from raw_order_items i
            join raw_products p on i.product_id = p.product_id
            left join raw_translation t on p.product_category_name = t.product_category_name""",
}


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with the expressions it uses, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "with " + ",\n".join(f"{name} as ({CTES[name]})" for name in needed) + "\n" + sql
