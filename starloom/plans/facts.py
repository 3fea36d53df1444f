"""Fact rows with the keys of their dimensions.

``keys`` maps customer, product, seller and payment to two-column frames (natural key,
surrogate key): those of a transform in memory or those stored in the warehouse.

The person behind an order is looked up once, at order grain. Item lines meet the delivered
orders first, so only lines that become rows travel on, and products last: whatever looks up
products next finds the rows of a product together. Payments meet them last: the merge then finds
the rows of an order together and needs no further shuffle to reduce them to one per natural key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import calendar
from starloom.operators.dedup import keep_last
from starloom.operators.keyfilter import likely
from starloom.schemas import MONEY, POS

DELIVERED = "delivered"


def customer_id_map(customers: DataFrame, customer_keys: DataFrame) -> DataFrame:
    """customer_id (one per order) to the person and the person's key."""
    return customers.select("customer_id", "customer_unique_id").join(customer_keys, "customer_unique_id", "left")


def delivered_orders(raw: dict[str, DataFrame], customer_keys: DataFrame) -> DataFrame:
    """Delivered orders with date key and person."""
    orders = raw["orders"].filter(F.col("order_status") == DELIVERED)
    people = customer_id_map(raw["customers"], customer_keys)
    return orders.join(people, "customer_id", "left").select(
        "order_id",
        "customer_key",
        "customer_unique_id",
        calendar.date_key(F.col("order_purchase_timestamp")).alias("date_key"),
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        POS,
    )


def fact_sales(raw: dict[str, DataFrame], delivered: DataFrame, keys: dict[str, DataFrame]) -> DataFrame:
    """One row per item line of a delivered order."""
    lines = likely(raw["order_items"], raw["orders"].filter(F.col("order_status") == DELIVERED), "order_id")
    lines = lines.join(delivered.drop(POS), "order_id", "inner")
    return lines.join(keys["seller"], "seller_id", "left").join(keys["product"], "product_id", "left").select(
        "order_id",
        "order_item_id",
        "customer_key",
        "customer_unique_id",
        "product_key",
        "product_id",
        "seller_key",
        "seller_id",
        "date_key",
        F.round("price", 2).cast(MONEY).alias("price"),
        F.round("freight_value", 2).cast(MONEY).alias("freight_value"),
        POS,
    )


def fact_payments(raw: dict[str, DataFrame], delivered: DataFrame, keys: dict[str, DataFrame]) -> DataFrame:
    """One row per payment record of a delivered order; an unknown number of installments is 1."""
    keyed = raw["payments"].join(keys["payment"], "payment_type", "left")
    return keyed.join(delivered.drop(POS), "order_id", "inner").select(
        "order_id",
        "payment_sequential",
        "customer_key",
        "customer_unique_id",
        "date_key",
        "payment_key",
        "payment_type",
        F.round("payment_value", 2).cast(MONEY).alias("payment_value"),
        F.coalesce("payment_installments", F.lit(1)).cast("int").alias("payment_installments"),
        POS,
    )


def last_review(reviews: DataFrame) -> DataFrame:
    """The review that arrived last, one per order."""
    return keep_last(reviews.select("order_id", "review_score", POS), ["order_id"], POS).drop(POS)


def fact_order_experience(raw: dict[str, DataFrame], delivered: DataFrame) -> DataFrame:
    """One row per delivered order with a delivery date: days, delay, last review."""
    done = delivered.filter(F.col("order_delivered_customer_date").isNotNull())
    received = F.col("order_delivered_customer_date")
    measured = done.withColumns(
        {
            "delivery_days": calendar.elapsed_days(received, F.col("order_purchase_timestamp")),
            "delay_days": calendar.elapsed_days(received, F.col("order_estimated_delivery_date")),
        }
    )
    return measured.join(last_review(raw["reviews"]), "order_id", "left").select(
        "order_id",
        "customer_key",
        "customer_unique_id",
        "date_key",
        "delivery_days",
        "delay_days",
        "review_score",
        calendar.is_late(F.col("delay_days")).alias("is_late_delivery"),
        POS,
    )


def remap_key(fact: DataFrame, key_map: DataFrame, natural: str, key: str) -> DataFrame:
    """Replace a key assigned in memory by the stored one, found through the natural key."""
    return fact.drop(key).join(key_map.select(natural, key), natural, "left")
