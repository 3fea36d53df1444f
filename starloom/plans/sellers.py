"""Seller and category reports that drill across item lines and order experience.

Item lines are summed per order and seller (or category) before the two facts meet on the
order id, so an order with very many lines is one row in the join. Scores and delays remain
weighted by item line, which is how the reports define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.numeric import money_sum, percent, ratio
from starloom.plans.revenue import Tables, desc


def _order_seller(dw: Tables) -> DataFrame:
    return dw["fact_sales"].groupBy("order_id", "seller_key").agg(
        F.count(F.lit(1)).alias("lines"), money_sum("price").alias("revenue")
    )


def best_sellers(dw: Tables, min_orders: int = 10, top: int = 20) -> DataFrame:
    """Sellers by review average, then revenue, among reviewed orders."""
    reviewed = dw["fact_order_experience"].filter(F.col("review_score").isNotNull()).select("order_id", "review_score")
    per_seller = _order_seller(dw).join(reviewed, "order_id").groupBy("seller_key").agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum("revenue").alias("total_revenue"),
        ratio(F.sum(F.col("review_score") * F.col("lines")), F.sum("lines"), 2).alias("avg_review_score"),
    )
    named = per_seller.filter(F.col("total_orders") >= min_orders).join(
        dw["dim_seller"].select("seller_key", "seller_id", "seller_state", "seller_city"), "seller_key"
    )
    columns = ["seller_id", "seller_state", "seller_city", "total_orders", "total_revenue", "avg_review_score"]
    return named.select(*columns).orderBy(desc("avg_review_score"), desc("total_revenue"), "seller_id").limit(top)


def delayed_sellers(dw: Tables, min_orders: int = 10, top: int = 20) -> DataFrame:
    """Late item lines per distinct order: the rate may exceed 100 when late orders have many lines."""
    experience = dw["fact_order_experience"].select("order_id", "is_late_delivery", "delay_days")
    late = F.sum(F.when(F.col("is_late_delivery"), F.col("lines")).otherwise(0))
    known = F.when(F.col("delay_days").isNotNull(), F.col("lines"))
    per_seller = _order_seller(dw).join(experience, "order_id").groupBy("seller_key").agg(
        F.count(F.lit(1)).alias("total_orders"),
        late.alias("late_orders"),
        percent(late, F.count(F.lit(1))).alias("late_delivery_rate_pct"),
        ratio(F.sum(F.col("delay_days") * F.col("lines")), F.sum(known), 1).alias("avg_delay_days"),
    )
    named = per_seller.filter(F.col("total_orders") >= min_orders).join(
        dw["dim_seller"].select("seller_key", "seller_id", "seller_state"), "seller_key"
    )
    columns = ["seller_id", "seller_state", "total_orders", "late_orders", "late_delivery_rate_pct", "avg_delay_days"]
    return named.select(*columns).orderBy(desc("late_delivery_rate_pct"), "seller_id").limit(top)


def top_sellers(dw: Tables, top: int = 20) -> DataFrame:
    per_seller = dw["fact_sales"].groupBy("seller_key").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count(F.lit(1)).alias("units_sold"),
        money_sum("price").alias("total_revenue"),
    )
    named = per_seller.join(dw["dim_seller"].select("seller_key", "seller_id", "seller_state"), "seller_key")
    columns = ["seller_id", "seller_state", "total_orders", "units_sold", "total_revenue"]
    return named.select(*columns).orderBy(desc("total_revenue"), "seller_id").limit(top)


def category_ratings(dw: Tables, min_reviews: int = 50) -> DataFrame:
    """Review scores per category, one score per item line."""
    reviewed = dw["fact_order_experience"].filter(F.col("review_score").isNotNull()).select("order_id", "review_score")
    products = dw["dim_product"].select("product_key", "category_name_english")
    lines = dw["fact_sales"].groupBy("order_id", "product_key").agg(F.count(F.lit(1)).alias("lines"))
    # Five scores at most per product: the category is looked up on that small result.
    per_product = lines.join(reviewed, "order_id").groupBy("product_key", "review_score").agg(F.sum("lines").alias("lines"))
    score, n = F.col("review_score"), F.col("lines")

    def lines_where(condition):
        return F.sum(F.when(condition, n).otherwise(0))

    categories = per_product.join(products, "product_key").groupBy("category_name_english").agg(
        F.sum(n).alias("total_reviews"),
        ratio(F.sum(score * n), F.sum(n), 2).alias("avg_review_score"),
        lines_where(score == 5).alias("five_star"),
        lines_where(score == 1).alias("one_star"),
        percent(lines_where(score >= 4), F.sum(n)).alias("positive_rate_pct"),
    )
    return categories.filter(F.col("total_reviews") >= min_reviews).orderBy(desc("avg_review_score"), "category_name_english")
