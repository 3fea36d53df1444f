"""Exact distinct counts that roll up: bitmaps of dense surrogate keys per period and state, merged by OR.

``count(distinct)`` has to go back to the facts for every level. Here each customer key sets one bit of a bitmap of 32,768 keys;
bitmaps of months merge to quarters, years and the whole, and states to the country, without reading a fact again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = dict[str, DataFrame]
LEVELS = {"month": ["year", "quarter", "month"], "quarter": ["year", "quarter"], "year": ["year"], "all": []}


def customer_bitmaps(dw: Tables) -> DataFrame:
    """``year, quarter, month, customer_state, bucket, bits``: the customers with a sale, the finest level that is kept.

    Sales reduce to distinct customers per day first, so a hot customer is a few rows in the joins.
    """
    seen = dw["fact_sales"].select("customer_key", "date_key").distinct()
    days = dw["dim_date"].select("date_key", "year", "quarter", "month")
    states = dw["dim_customer"].select("customer_key", "customer_state")
    placed = seen.join(days, "date_key").join(states, "customer_key")
    keys = [*LEVELS["month"], "customer_state", F.bitmap_bucket_number("customer_key").alias("bucket")]
    return placed.groupBy(*keys).agg(F.bitmap_construct_agg(F.bitmap_bit_position("customer_key")).alias("bits"))


def distinct_customers(bitmaps: DataFrame, level: str, by_state: bool = False) -> DataFrame:
    """Customers per period of ``level`` (month, quarter, year or all), optionally per state, from the kept bitmaps alone."""
    keys = LEVELS[level] + (["customer_state"] if by_state else [])
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("customers"))
