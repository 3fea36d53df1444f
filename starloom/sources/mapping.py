"""Marketplace raw tables derived from order/line/customer/part/supplier Parquet tables.

Gives the warehouse realistic input at any scale where no marketplace files are at hand.
Every column is one expression over one table (see FIXTURES.md), so no step sorts or numbers
rows within a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.schemas import POS

# Raw table -> (source relation, {column: expression}).
RULES: dict[str, tuple[str, dict[str, str]]] = {
    "customers": (
        "{orders} join {customer} on o_custkey = c_custkey",
        {
            "customer_id": "concat('c', o_orderkey)",
            "customer_unique_id": "concat('u', o_custkey)",
            "customer_state": "concat(' x', chr(cast(97 + c_nationkey as int)), ' ')",
            "customer_city": "lower(concat(o_orderpriority, ' d''oeste'))",
            POS: "o_orderkey",
        },
    ),
    "orders": (
        "{orders}",
        {
            "order_id": "concat('o', o_orderkey)",
            "customer_id": "concat('c', o_orderkey)",
            "order_status": "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' else 'processing' end",
            "order_purchase_timestamp": "cast(o_orderdate + (o_orderkey % 24) * interval '1' hour as timestamp)",
            "order_approved_at": "cast(o_orderdate + (o_orderkey % 24) * interval '1' hour + interval '1' hour as timestamp)",
            "order_delivered_customer_date": "cast(case when o_orderstatus = 'F' and o_orderkey % 50 <> 0 then o_orderdate "
            "+ (o_orderkey % 24 + o_orderkey % 17 + 24 * (o_orderkey * 11 % 45)) * interval '1' hour end as timestamp)",
            "order_estimated_delivery_date": "cast(o_orderdate + interval '21' day as timestamp)",
            POS: "o_orderkey",
        },
    ),
    "order_items": (
        # Numbered by the order id itself: whatever follows by order finds the lines of an order together and moves them no second time.
        "(select *, row_number() over (partition by order_id order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax) as item "
        "from (select *, concat('o', l_orderkey) as order_id from {lineitem}))",
        {
            "order_id": "order_id",
            "order_item_id": "cast(item as bigint)",
            "product_id": "concat('p', l_partkey)",
            "seller_id": "concat('s', l_suppkey)",
            "price": "cast(l_extendedprice as decimal(10,2))",
            "freight_value": "cast(cast(l_extendedprice as decimal(10,2)) * cast(l_tax as decimal(4,2)) as decimal(10,2))",
            "line_number": "l_linenumber",
            POS: "l_orderkey * 10 + l_linenumber",
        },
    ),
    "payments": (
        "(select *, explode(array(1, 2)) as seq from {orders})",
        {
            "order_id": "concat('o', o_orderkey)",
            "payment_sequential": "seq",
            "payment_type": "case when seq = 2 then 'voucher' when o_orderpriority in ('1-URGENT', '2-HIGH') then 'credit_card' "
            "when o_orderpriority = '3-MEDIUM' then 'boleto' when o_orderpriority = '4-NOT SPECIFIED' then 'voucher' "
            "else 'debit_card' end",
            "payment_installments": "case when o_orderkey % 40 = 0 then null when o_orderkey % 1000 = 7 then 0 "
            "when seq = 1 and o_orderpriority in ('1-URGENT', '2-HIGH') then cast(1 + o_orderkey % 10 as int) else 1 end",
            "payment_value": "case when o_orderkey % 3 <> 0 then cast(o_totalprice as decimal(10,2)) "
            "when seq = 1 then cast(cast(o_totalprice as decimal(10,2)) * 0.7 as decimal(10,2)) "
            "else cast(cast(o_totalprice as decimal(10,2)) - cast(cast(o_totalprice as decimal(10,2)) * 0.7 as decimal(10,2)) "
            "as decimal(10,2)) end",
            POS: "o_orderkey * 2 + seq - 1",
        },
    ),
    "reviews": (
        "(select *, explode(array(0, 1)) as seq from {orders})",
        {
            "order_id": "concat('o', o_orderkey)",
            "review_score": "cast(1 + (o_orderkey * (31 + seq)) % 5 as smallint)",
            "review_comment_title": "case when o_orderkey % 4 = 0 then concat('order ', o_orderkey) end",
            "review_comment_message": "case when o_orderkey % 3 = 0 then concat('status \"', o_orderstatus, '\",', chr(10), 'prio ', o_orderpriority) end",
            POS: "o_orderkey * 2 + seq",
        },
    ),
    "products": (
        "{part}",
        {
            "product_id": "concat('p', p_partkey)",
            "product_category_name": "case when p_partkey % 20 <> 0 then lower(p_type) end",
            "product_name_lenght": "case when p_partkey % 20 <> 0 then cast(length(p_name) as double) end",
            "product_description_lenght": "case when p_partkey % 20 <> 0 then cast(p_size * 10 as double) end",
            "product_photos_qty": "case when p_partkey % 20 <> 0 then cast(p_size % 5 as double) end",
            "product_weight_g": "case when p_partkey % 33 <> 0 then p_retailprice end",
            POS: "p_partkey",
        },
    ),
    "sellers": (
        "{supplier}",
        {
            "seller_id": "concat('s', s_suppkey)",
            "seller_state": "concat(chr(cast(97 + s_nationkey as int)), 'x ')",
            "seller_city": "concat('  ', lower(s_name))",
            POS: "s_suppkey",
        },
    ),
    "geolocation": (
        "{customer}",
        {
            "geolocation_zip_code_prefix": "lpad(cast(c_custkey % 100 as string), 5, '0')",
            "geolocation_lat": "c_acctbal / 100",
            "geolocation_lng": "-c_acctbal / 50",
            POS: "c_custkey",
        },
    ),
    "category_translation": (
        "(select p_type, min(p_partkey) as first_part from {part} where p_type <> 'PROMO' group by p_type)",
        {
            "product_category_name": "lower(p_type)",
            "product_category_name_english": "concat(' ', p_type, ' GOODS ')",
            POS: "first_part",
        },
    ),
}

# Which exploded rows of a table exist.
FILTERS = {
    "payments": "seq = 1 or o_orderkey % 3 = 0",
    "reviews": "(seq = 0 and o_orderkey % 10 <> 0) or (seq = 1 and o_orderkey % 97 = 0)",
}

SOURCE_TABLES = ("orders", "lineitem", "customer", "part", "supplier")


def mapped_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The raw tables as lazy DataFrames over ``<folder>/<table>.parquet``."""
    paths = {t: f"parquet.`{folder.rstrip('/')}/{t}.parquet`" for t in SOURCE_TABLES}
    raw = {}
    for name, (relation, columns) in RULES.items():
        projection = ", ".join(f"{expr} as {column}" for column, expr in columns.items())
        where = f" where {FILTERS[name]}" if name in FILTERS else ""
        raw[name] = spark.sql(f"select {projection} from {relation.format(**paths)}{where}")
    return raw
