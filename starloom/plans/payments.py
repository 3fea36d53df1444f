"""Payment reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.numeric import average_money, money_sum, percent
from starloom.plans.revenue import Tables, asc, desc


def payment_mix(dw: Tables) -> DataFrame:
    """Orders and revenue per payment type. An order paid in two ways counts once for each,
    in its row and in the total the share refers to."""
    per_type = dw["fact_payments"].groupBy("payment_key").agg(
        F.count_distinct("order_id").alias("total_orders"),
        money_sum("payment_value").alias("total_revenue"),
        average_money(F.col("payment_value")).alias("avg_order_value"),
    )
    named = per_type.join(dw["dim_payment"].select("payment_key", "payment_type"), "payment_key")
    # One row per payment type.
    everything = F.sum("total_orders").over(Window.partitionBy())
    share = percent(F.col("total_orders"), everything).alias("order_share_pct")
    return named.select("payment_type", "total_orders", "total_revenue", "avg_order_value", share).orderBy(
        desc("total_orders"), "payment_type"
    )


def installments(dw: Tables, payment_type: str = "credit_card") -> DataFrame:
    """Order value by number of installments for one payment type."""
    kind = dw["dim_payment"].filter(F.col("payment_type") == payment_type).select("payment_key")
    paid = dw["fact_payments"].join(kind, "payment_key")
    return paid.groupBy("payment_installments").agg(
        F.count_distinct("order_id").alias("total_orders"),
        average_money(F.col("payment_value")).alias("avg_order_value"),
        money_sum("payment_value").alias("total_revenue"),
    ).orderBy(asc("payment_installments"))
