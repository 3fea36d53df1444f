"""Revenue and sales reports. ``dw`` maps table names to warehouse DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.labels import quarter_label
from starloom.functions.numeric import WIDE, average_money, money_sum, percent, ratio

Tables = dict[str, DataFrame]

# Null order of the reports: descending puts nulls first, ascending puts them last.
desc, asc = F.desc_nulls_first, F.asc_nulls_last


def monthly_revenue(dw: Tables) -> DataFrame:
    """Revenue, orders, payment average and growth over the previous month with sales."""
    paid = dw["fact_payments"].join(dw["dim_date"].select("date_key", "year", "month", "month_name"), "date_key")
    months = paid.groupBy("year", "month", "month_name").agg(
        money_sum("payment_value").alias("total_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
        average_money(F.col("payment_value")).alias("avg_order_value"),
    )
    # Unpartitioned on purpose: one row per calendar month.
    previous = F.lag("total_revenue").over(Window.orderBy("year", "month"))
    growth = percent(F.col("total_revenue") - previous, previous, kind=WIDE)
    return months.withColumn("mom_growth_pct", growth).orderBy("year", "month")


def quarterly_revenue(dw: Tables) -> DataFrame:
    paid = dw["fact_payments"].join(dw["dim_date"].select("date_key", "year", "quarter"), "date_key")
    quarters = paid.groupBy("year", "quarter").agg(
        money_sum("payment_value").alias("total_revenue"), F.count_distinct("order_id").alias("total_orders")
    )
    label = quarter_label(F.col("year"), F.col("quarter")).alias("quarter_label")
    return quarters.select("year", "quarter", label, "total_revenue", "total_orders").orderBy("year", "quarter")


def category_sums(dw: Tables) -> DataFrame:
    # Summed per product and order first, so a hot product is a few rows in the join.
    sold = dw["fact_sales"].groupBy("product_key", "order_id").agg(money_sum("price").alias("revenue"), F.count(F.lit(1)).alias("units"))
    named = sold.join(dw["dim_product"].select("product_key", "category_name_english"), "product_key")
    return named.groupBy("category_name_english").agg(
        money_sum("revenue").alias("total_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("units").alias("units_sold"),
    )


def category_ranking(dw: Tables, top: int = 20) -> DataFrame:
    """Categories by item price with their share of all categories, then the first ``top``."""
    # One row per category; the shares need the total before the cut.
    total = F.sum("total_revenue").over(Window.partitionBy())
    shares = category_sums(dw).withColumn("revenue_share_pct", percent(F.col("total_revenue"), total, kind=WIDE))
    return shares.orderBy(desc("total_revenue"), "category_name_english").limit(top)


def category_growth(dw: Tables, base_year: int = 2017, next_year: int = 2018) -> DataFrame:
    """Category revenue in two years and the change, for categories that sold in the first."""
    days = dw["dim_date"].filter(F.col("year").isin(base_year, next_year)).select("date_key", "year")
    sold = dw["fact_sales"].join(days, "date_key")
    products = dw["dim_product"].select("product_key", "category_name_english")
    base, after = f"revenue_{base_year}", f"revenue_{next_year}"
    # Products are far fewer than items: sum per product first, name the category after.
    per_product = sold.groupBy("product_key").agg(
        money_sum(F.when(F.col("year") == base_year, F.col("price")).otherwise(0)).alias(base),
        money_sum(F.when(F.col("year") == next_year, F.col("price")).otherwise(0)).alias(after),
    )
    categories = per_product.join(products, "product_key").groupBy("category_name_english").agg(
        money_sum(base).alias(base), money_sum(after).alias(after)
    )
    grown = categories.filter(F.col(base) > 0).withColumn(
        "yoy_growth_pct", percent(F.col(after) - F.col(base), F.col(base), kind=WIDE)
    )
    return grown.orderBy(desc("yoy_growth_pct"), "category_name_english")


def _paid_by(dw: Tables, *keys: str) -> DataFrame:
    """Amount and number of payments per key, with the customer's state."""
    paid = dw["fact_payments"].groupBy(*keys).agg(money_sum("payment_value").alias("paid"), F.count("payment_value").alias("payments"))
    return paid.join(dw["dim_customer"].select("customer_key", "customer_state"), "customer_key")


def order_value_by_state(dw: Tables) -> DataFrame:
    """Average per payment row, as the report defines it: a split payment lowers it."""
    states = _paid_by(dw, "customer_key", "order_id").groupBy("customer_state").agg(
        F.count_distinct("order_id").alias("total_orders"),
        money_sum("paid").alias("total_revenue"),
        ratio(money_sum("paid"), F.sum("payments"), 2, WIDE).alias("avg_order_value"),
    )
    return states.orderBy(desc("avg_order_value"), "customer_state")


def revenue_by_state(dw: Tables) -> DataFrame:
    """Customers and orders are counted by aggregates of their own: two distinct counts in one would triple the rows."""
    states = _paid_by(dw, "customer_key").groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("unique_customers"),
        money_sum("paid").alias("total_revenue"),
        ratio(money_sum("paid"), F.sum("payments"), 2, WIDE).alias("avg_order_value"),
    )
    orders = _paid_by(dw, "customer_key", "order_id").groupBy(F.col("customer_state").alias("state")).agg(F.count_distinct("order_id").alias("total_orders"))
    states = states.join(orders, F.col("customer_state").eqNullSafe(F.col("state")))
    return states.select("customer_state", "unique_customers", "total_orders", "total_revenue", "avg_order_value").orderBy(desc("total_revenue"), "customer_state")


def top_products(dw: Tables, top: int = 20) -> DataFrame:
    """Best selling products. Summed by key, so only the products are joined, not the items."""
    per_product = dw["fact_sales"].groupBy("product_key").agg(
        F.count_distinct("order_id").alias("orders"),
        F.count(F.lit(1)).alias("units_sold"),
        money_sum("price").alias("total_revenue"),
        average_money(F.col("price")).alias("avg_price"),
    )
    named = per_product.join(dw["dim_product"].select("product_key", "product_id", "category_name_english"), "product_key")
    columns = ["product_id", "category_name_english", "orders", "units_sold", "total_revenue", "avg_price"]
    return named.select(*columns).orderBy(desc("total_revenue"), "product_id").limit(top)
