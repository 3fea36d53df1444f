"""Exploratory questions answered from the raw tables.

They differ from the warehouse reports on purpose: every order status counts unless said
otherwise, payments are added up per order first, nothing is filtered by volume, reviews are
not reduced to one per order, and groups without a name are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import calendar
from starloom.functions.numeric import average, average_money, money_sum, ratio
from starloom.operators.quantiles import describe
from starloom.plans.profiling import Raw, orders_per_person, value_counts

DIGITS = 6


def order_totals(raw: Raw) -> DataFrame:
    """What was paid per order; adding up first keeps a split payment from counting an order twice."""
    return raw["payments"].groupBy("order_id").agg(money_sum("payment_value").alias("order_value"))


def _paid_orders(raw: Raw, *columns: str) -> DataFrame:
    return raw["orders"].select("order_id", *columns).join(order_totals(raw), "order_id")


def _paid_by_customer(raw: Raw, attribute: str, *columns: str) -> DataFrame:
    people = raw["customers"].select("customer_id", attribute)
    return _paid_orders(raw, "customer_id", *columns).join(people, "customer_id").filter(F.col(attribute).isNotNull())


def monthly_revenue(raw: Raw) -> DataFrame:
    paid = _paid_orders(raw, "order_purchase_timestamp")
    month = calendar.month_period(F.col("order_purchase_timestamp")).alias("year_month")
    paid = paid.filter("order_purchase_timestamp is not null")
    return paid.groupBy(month).agg(money_sum("order_value").alias("revenue")).orderBy("year_month")


def _english(raw: Raw, per_product: DataFrame, how: str) -> DataFrame:
    """Name the category of per-product figures; products without a translated name drop out."""
    categories = raw["products"].select("product_id", "product_category_name")
    names = raw["category_translation"].select("product_category_name", "product_category_name_english")
    named = per_product.join(categories, "product_id", how).join(names, "product_category_name", "left")
    return named.filter("product_category_name_english is not null").groupBy("product_category_name_english")


def category_revenue(raw: Raw) -> DataFrame:
    per_product = raw["order_items"].groupBy("product_id").agg(money_sum("price").alias("revenue"))
    return _english(raw, per_product, "left").agg(money_sum("revenue").alias("revenue")).orderBy(
        F.desc("revenue"), "product_category_name_english"
    )


def order_value_by_state(raw: Raw) -> DataFrame:
    """Mean of order totals per state: the true average order value."""
    paid = _paid_by_customer(raw, "customer_state")
    return paid.groupBy("customer_state").agg(average_money(F.col("order_value"), DIGITS).alias("avg_order_value")).orderBy(
        F.desc("avg_order_value"), "customer_state"
    )


def lifetime_value(raw: Raw) -> DataFrame:
    """Total spend of every person, highest first."""
    paid = _paid_by_customer(raw, "customer_unique_id")
    return paid.groupBy("customer_unique_id").agg(money_sum("order_value").alias("lifetime_value")).orderBy(
        F.desc("lifetime_value"), "customer_unique_id"
    )


def repeat_rate(raw: Raw) -> DataFrame:
    """Share of persons with several orders, paid or not."""
    counted = orders_per_person(raw)
    repeats = F.count_if(F.col("orders") > 1)
    return counted.agg(
        F.count(F.lit(1)).alias("total_customers"),
        repeats.alias("repeat_customers"),
        ratio(repeats * 100, F.count(F.lit(1)), DIGITS).alias("repeat_rate_pct"),
    )


def order_count_distribution(raw: Raw, first: int = 10) -> DataFrame:
    """How many persons have 1, 2, ... orders, for the ``first`` smallest order counts."""
    return value_counts(orders_per_person(raw), "orders", "customers").orderBy("orders").limit(first)


def rfm_base(raw: Raw) -> DataFrame:
    """Whole days since the last purchase, number of paid orders and spend of every person.

    The reference point is the latest purchase of all orders, to the second.
    """
    paid = _paid_by_customer(raw, "customer_unique_id", "order_purchase_timestamp")
    per_person = paid.groupBy("customer_unique_id").agg(
        F.max("order_purchase_timestamp").alias("last_purchase"),
        F.count("order_id").alias("frequency"),
        money_sum("order_value").alias("monetary"),
    )
    snapshot = raw["orders"].agg(F.max("order_purchase_timestamp")).scalar()
    recency = calendar.elapsed_days(snapshot, F.col("last_purchase")).alias("recency")
    return per_person.select("customer_unique_id", recency, "frequency", "monetary")


def rfm_profile(raw: Raw) -> DataFrame:
    return describe(rfm_base(raw), ["recency", "frequency", "monetary"])


def seller_performance(raw: Raw) -> DataFrame:
    """Revenue and mean review of the sellers that have both; one score per item line and review."""
    items = raw["order_items"]
    revenue = items.groupBy("seller_id").agg(money_sum("price").alias("revenue"))
    # Lines per order and seller, scores per order: an order with many of both stays one row each.
    lines = items.groupBy("order_id", "seller_id").agg(F.count(F.lit(1)).alias("lines"))
    scores = _scores_per_order(raw)
    reviewed = lines.join(scores, "order_id").groupBy("seller_id").agg(
        ratio(F.sum(F.col("score_sum") * F.col("lines")), F.sum(F.col("reviews") * F.col("lines")), DIGITS).alias("avg_review")
    )
    return revenue.join(reviewed, "seller_id").orderBy(F.desc("revenue"), "seller_id")


def _scores_per_order(raw: Raw) -> DataFrame:
    return raw["reviews"].groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"), F.count("review_score").alias("reviews")
    )


def received_orders(raw: Raw) -> DataFrame:
    """Orders with a delivery date, whatever their status, with days and delay."""
    received = F.col("order_delivered_customer_date")
    delay = calendar.elapsed_days(received, F.col("order_estimated_delivery_date"))
    return raw["orders"].dropna(subset=["order_delivered_customer_date"]).select(
        "order_id",
        "customer_id",
        calendar.elapsed_days(received, F.col("order_purchase_timestamp")).alias("delivery_days"),
        delay.alias("delay_days"),
        calendar.is_late(delay).alias("is_late"),
    )


def seller_delay(raw: Raw) -> DataFrame:
    """Mean delay per seller, weighted by item line."""
    items = raw["order_items"].filter("seller_id is not null")
    lines = items.groupBy("order_id", "seller_id").agg(F.count(F.lit(1)).alias("lines"))
    joined = lines.join(received_orders(raw).select("order_id", "delay_days"), "order_id")
    known = F.when(F.col("delay_days").isNotNull(), F.col("lines"))
    return joined.groupBy("seller_id").agg(
        ratio(F.sum(F.col("delay_days") * F.col("lines")), F.sum(known), DIGITS).alias("avg_delay_days")
    ).orderBy(F.desc("avg_delay_days"), "seller_id")


def state_revenue(raw: Raw) -> DataFrame:
    paid = _paid_by_customer(raw, "customer_state")
    return paid.groupBy("customer_state").agg(money_sum("order_value").alias("revenue")).orderBy(
        F.desc("revenue"), "customer_state"
    )


def payment_distribution(raw: Raw) -> DataFrame:
    return value_counts(raw["payments"], "payment_type", "payments")


def order_value_by_payment_type(raw: Raw) -> DataFrame:
    """Mean, per type, of what an order paid with that type."""
    per_order = raw["payments"].dropna(subset=["order_id", "payment_type"]).groupBy("order_id", "payment_type").agg(
        money_sum("payment_value").alias("order_value")
    )
    return per_order.groupBy("payment_type").agg(average_money(F.col("order_value"), DIGITS).alias("avg_order_value")).orderBy(
        F.desc("avg_order_value"), "payment_type"
    )


def order_value_by_installments(raw: Raw, payment_type: str = "credit_card") -> DataFrame:
    """Mean order value by the largest number of installments of the order."""
    kind = raw["payments"].filter((F.col("payment_type") == payment_type) & F.col("order_id").isNotNull())
    per_order = kind.groupBy("order_id").agg(
        F.max("payment_installments").alias("installments"), money_sum("payment_value").alias("order_value")
    )
    return per_order.filter("installments is not null").groupBy("installments").agg(
        average_money(F.col("order_value"), DIGITS).alias("avg_order_value")
    ).orderBy("installments")


def delivery_by_state(raw: Raw) -> DataFrame:
    """Mean delivery time and mean of all delays, early ones included."""
    states = raw["customers"].select("customer_id", "customer_state")
    joined = received_orders(raw).join(states, "customer_id").filter("customer_state is not null")
    return joined.groupBy("customer_state").agg(
        average(F.col("delivery_days"), DIGITS).alias("avg_delivery_days"),
        average(F.col("delay_days"), DIGITS).alias("avg_delay_days"),
    ).orderBy(F.desc("avg_delay_days"), "customer_state")


def late_rate(raw: Raw) -> DataFrame:
    rows = F.count(F.lit(1))
    late = F.count_if(F.col("is_late"))
    return received_orders(raw).agg(
        ratio(late * 100, rows, DIGITS).alias("late_rate_pct"),
        ratio((rows - late) * 100, rows, DIGITS).alias("on_time_rate_pct"),
        rows.alias("total_delivered"),
    )


def _reviewed_deliveries(raw: Raw) -> DataFrame:
    return received_orders(raw).join(raw["reviews"].select("order_id", "review_score"), "order_id")


def review_by_lateness(raw: Raw) -> DataFrame:
    return _reviewed_deliveries(raw).groupBy("is_late").agg(
        average(F.col("review_score"), DIGITS).alias("avg_review_score"), F.count(F.lit(1)).alias("reviews")
    ).orderBy("is_late")


def delivery_review_correlation(raw: Raw) -> DataFrame:
    """Pearson correlation of delivery days and score, four digits; pairs with a null are skipped."""
    return _reviewed_deliveries(raw).agg(F.round(F.corr("delivery_days", "review_score"), 4).alias("correlation"))


def category_ratings(raw: Raw) -> DataFrame:
    """Mean score per category, one score per item line and review, best first."""
    lines = raw["order_items"].groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("lines"))
    per_product = lines.join(_scores_per_order(raw), "order_id").groupBy("product_id").agg(
        F.sum(F.col("score_sum") * F.col("lines")).alias("score_sum"), F.sum(F.col("reviews") * F.col("lines")).alias("reviews")
    )
    return _english(raw, per_product, "inner").agg(
        ratio(F.sum("score_sum"), F.sum("reviews"), DIGITS).alias("avg_review_score")
    ).orderBy(F.desc_nulls_last("avg_review_score"), "product_category_name_english")


def best_and_worst_categories(raw: Raw, n: int = 5) -> DataFrame:
    """The ``n`` best and the ``n`` worst rated categories."""
    rated = category_ratings(raw).filter("avg_review_score is not null")
    best = rated.orderBy(F.desc("avg_review_score"), "product_category_name_english").limit(n)
    worst = rated.orderBy(F.asc("avg_review_score"), F.desc("product_category_name_english")).limit(n)
    return best.withColumn("end", F.lit("top")).unionByName(worst.withColumn("end", F.lit("bottom")))
