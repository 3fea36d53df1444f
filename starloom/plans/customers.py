"""Customer reports: value, repeat purchases, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.labels import rfm_segment
from starloom.functions.numeric import average, average_money, money_sum, percent
from starloom.operators.positions import with_ntiles
from starloom.plans.revenue import Tables, desc

SCORES = 5


def lifetime_value(dw: Tables, top: int = 50) -> DataFrame:
    """Customers by total spend. Summed by key first; only the result meets the dimension."""
    per_customer = dw["fact_payments"].groupBy("customer_key").agg(
        F.count_distinct("order_id").alias("total_orders"),
        money_sum("payment_value").alias("lifetime_value"),
        average_money(F.col("payment_value")).alias("avg_order_value"),
    )
    people = dw["dim_customer"].select("customer_key", "customer_unique_id", "customer_state", "customer_city")
    named = per_customer.join(people, "customer_key").select(
        "customer_unique_id", "customer_state", "customer_city", "total_orders", "lifetime_value", "avg_order_value"
    )
    return named.orderBy(desc("lifetime_value"), "customer_unique_id").limit(top)


def repeat_rate(dw: Tables) -> DataFrame:
    per_customer = dw["fact_payments"].groupBy("customer_key").agg(F.count_distinct("order_id").alias("orders"))
    repeats = F.count_if(F.col("orders") > 1)
    return per_customer.agg(
        F.count(F.lit(1)).alias("total_customers"),
        repeats.alias("repeat_customers"),
        percent(repeats, F.count(F.lit(1))).alias("repeat_rate_pct"),
        average(F.col("orders"), 2).alias("avg_orders_per_customer"),
    )


def first_gaps(events_per_day: DataFrame) -> DataFrame:
    """Days from the first to the second event of each customer that has two.

    Input: customer_key, full_date, events. Two events on the first day are 0 days apart,
    otherwise the next day with an event counts. A customer has at most one row per calendar
    day here, and the rank filter keeps two of them before anything is shuffled.
    """
    by_day = Window.partitionBy("customer_key").orderBy("full_date")
    first_days = events_per_day.withColumn("nth", F.row_number().over(by_day)).filter("nth <= 2")
    pairs = first_days.groupBy("customer_key").agg(
        F.min("full_date").alias("first_day"),
        F.max(F.when(F.col("nth") == 2, F.col("full_date"))).alias("next_day"),
        F.max(F.when(F.col("nth") == 1, F.col("events"))).alias("first_events"),
    )
    gap = F.when(F.col("first_events") > 1, 0).otherwise(F.datediff("next_day", "first_day"))
    return pairs.select("customer_key", gap.alias("days")).filter("days is not null")


def _gap_summary(events_per_day: DataFrame) -> DataFrame:
    return first_gaps(events_per_day).agg(
        average(F.col("days"), 0).alias("avg_days_to_second_order"),
        F.min("days").alias("min_days"),
        F.max("days").alias("max_days"),
    )


def days_to_second_payment(dw: Tables) -> DataFrame:
    """First to second payment row, as the report defines a second order: a split payment is 0 days."""
    days = dw["dim_date"].select("date_key", "full_date")
    per_day = dw["fact_payments"].groupBy("customer_key", "date_key").agg(F.count(F.lit(1)).alias("events"))
    return _gap_summary(per_day.join(days, "date_key").select("customer_key", "full_date", "events"))


def days_to_second_order(dw: Tables) -> DataFrame:
    """First to second distinct order."""
    days = dw["dim_date"].select("date_key", "full_date")
    orders = dw["fact_payments"].groupBy("customer_key", "order_id").agg(F.min("date_key").alias("date_key"))
    per_day = orders.groupBy("customer_key", "date_key").agg(F.count(F.lit(1)).alias("events"))
    return _gap_summary(per_day.join(days, "date_key").select("customer_key", "full_date", "events"))


def rfm_base(dw: Tables) -> DataFrame:
    """Last purchase day, number of orders and spend of every customer."""
    paid = dw["fact_payments"].join(dw["dim_date"].select("date_key", "full_date"), "date_key")
    return paid.groupBy("customer_key").agg(
        F.max("full_date").alias("last_day"),
        F.count_distinct("order_id").alias("frequency"),
        money_sum("payment_value").alias("monetary"),
    )


# Order of the tiles of each score: the longest recency comes first, which is the order of the last day.
RFM_ORDERS = {"r_score": "last_day", "f_score": "frequency", "m_score": "monetary"}


def rfm_scores(dw: Tables, wanted: tuple[str, ...] = tuple(RFM_ORDERS)) -> DataFrame:
    """Scores 1..5 for recency (5 = most recent), frequency and spend, or those ``wanted``, ranked in one global sort.

    Ties are broken by customer key, so the scores are reproducible.
    """
    scored = with_ntiles(rfm_base(dw), SCORES, "customer_key", {score: RFM_ORDERS[score] for score in wanted})
    snapshot = scored.agg(F.max("last_day")).scalar()
    return scored.withColumn("recency_days", F.datediff(snapshot, "last_day"))


def rfm_segments(dw: Tables) -> DataFrame:
    segments = rfm_scores(dw, ("r_score", "f_score")).groupBy(rfm_segment(F.col("r_score"), F.col("f_score")).alias("segment")).agg(
        F.count(F.lit(1)).alias("customer_count"),
        average(F.col("recency_days"), 0).alias("avg_recency_days"),
        average(F.col("frequency"), 2).alias("avg_frequency"),
        average_money(F.col("monetary")).alias("avg_monetary"),
    )
    return segments.orderBy(desc("customer_count"), "segment")
