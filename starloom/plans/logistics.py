"""Delivery and satisfaction reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.labels import delivery_bucket, delivery_status
from starloom.functions.numeric import average, percent, ratio
from starloom.plans.revenue import Tables, desc

def _by_customer_state(dw: Tables, measures: dict[str, Column], orders: DataFrame) -> DataFrame:
    """Sums per customer first, then per state: the dimension is joined to customers, not orders."""
    per_customer = orders.groupBy("customer_key").agg(*[c.alias(n) for n, c in measures.items()])
    return per_customer.join(dw["dim_customer"].select("customer_key", "customer_state"), "customer_key").groupBy("customer_state")


def delivery_time_by_state(dw: Tables) -> DataFrame:
    known = dw["fact_order_experience"].filter(F.col("delivery_days").isNotNull())
    days = F.col("delivery_days")
    states = _by_customer_state(
        dw, {"n": F.count(F.lit(1)), "days": F.sum(days), "low": F.min(days), "high": F.max(days)}, known
    ).agg(
        F.sum("n").alias("delivered_orders"),
        ratio(F.sum("days"), F.sum("n"), 1).alias("avg_delivery_days"),
        F.min("low").alias("min_delivery_days"),
        F.max("high").alias("max_delivery_days"),
    )
    return states.orderBy(desc("avg_delivery_days"), "customer_state")


def late_rate(dw: Tables) -> DataFrame:
    late = F.count_if(F.col("is_late_delivery"))
    on_time = F.count_if(~F.col("is_late_delivery"))
    rows = F.count(F.lit(1))
    return dw["fact_order_experience"].agg(
        rows.alias("total_delivered"),
        late.alias("late_orders"),
        on_time.alias("on_time_orders"),
        percent(late, rows).alias("late_delivery_rate_pct"),
        percent(on_time, rows).alias("on_time_rate_pct"),
    )


def delay_by_state(dw: Tables) -> DataFrame:
    delay = F.when(F.col("delay_days") > 0, F.col("delay_days"))
    states = _by_customer_state(
        dw,
        {"n": F.count(F.lit(1)), "late": F.count_if(F.col("is_late_delivery")), "days": F.sum(delay), "delayed": F.count(delay)},
        dw["fact_order_experience"],
    ).agg(
        F.sum("n").alias("total_orders"),
        F.sum("late").alias("late_orders"),
        percent(F.sum("late"), F.sum("n")).alias("late_rate_pct"),
        ratio(F.sum("days"), F.sum("delayed"), 1).alias("avg_delay_days_when_late"),
    )
    return states.orderBy(desc("late_rate_pct"), "customer_state")


def rating_by_delivery_time(dw: Tables) -> DataFrame:
    rated = dw["fact_order_experience"].dropna(subset=["delivery_days", "review_score"])
    return rated.groupBy(delivery_bucket(F.col("delivery_days")).alias("delivery_bucket")).agg(
        F.count(F.lit(1)).alias("order_count"), average(F.col("review_score"), 2).alias("avg_review_score")
    ).orderBy("delivery_bucket")


def rating_by_lateness(dw: Tables) -> DataFrame:
    rated = dw["fact_order_experience"].filter(F.col("review_score").isNotNull())
    rows = F.count(F.lit(1))
    negative, best = F.count_if(F.col("review_score") <= 2), F.count_if(F.col("review_score") == 5)
    groups = rated.groupBy("is_late_delivery").agg(
        rows.alias("total_orders"),
        average(F.col("review_score"), 2).alias("avg_review_score"),
        negative.alias("negative_reviews"),
        percent(negative, rows).alias("negative_review_rate_pct"),
        best.alias("five_star_reviews"),
        percent(best, rows).alias("five_star_rate_pct"),
    )
    status = delivery_status(F.col("is_late_delivery")).alias("delivery_status")
    measures = [c for c in groups.columns if c != "is_late_delivery"]
    return groups.orderBy("is_late_delivery").select(status, *measures)
