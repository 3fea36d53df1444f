"""Dimension rows without keys, in arrival order. Keys come from the merge or the transform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import calendar
from starloom.functions.text import clean_title, clean_upper, strip
from starloom.operators.dedup import keep_last
from starloom.operators.merge import SUB_POS
from starloom.schemas import MONEY, POS
from starloom.sources.seeds import DEFAULT_INSTALLMENT_GROUP


def dim_customer(customers: DataFrame) -> DataFrame:
    """One row per person with the state and city of the person's last order."""
    latest = keep_last(customers.select("customer_unique_id", "customer_state", "customer_city", POS), ["customer_unique_id"], POS)
    return latest.withColumns(
        {"customer_state": clean_upper(F.col("customer_state")), "customer_city": clean_title(F.col("customer_city"))}
    )


def translated_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category; a missing category only meets a missing translation key."""
    names = translation.select(
        F.col("product_category_name").alias("_category"), "product_category_name_english", F.col(POS).alias(SUB_POS)
    )
    joined = products.join(names, products["product_category_name"].eqNullSafe(names["_category"]), "left")
    return joined.drop("_category").withColumn(SUB_POS, F.coalesce(SUB_POS, F.lit(0)))


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products in English: no translation gives 'unknown', missing numbers give 0."""
    p = translated_products(products, translation)
    return p.select(
        "product_id",
        F.lower(strip(F.coalesce("product_category_name_english", F.lit("unknown")))).alias("category_name_english"),
        F.coalesce("product_name_lenght", F.lit(0)).cast("int").alias("product_name_length"),
        F.coalesce("product_description_lenght", F.lit(0)).cast("int").alias("product_description_length"),
        F.coalesce("product_photos_qty", F.lit(0)).cast("int").alias("photos_qty"),
        F.coalesce("product_weight_g", F.lit(0)).cast(MONEY).alias("weight_g"),
        POS,
        SUB_POS,
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        clean_upper(F.col("seller_state")).alias("seller_state"),
        clean_title(F.col("seller_city")).alias("seller_city"),
        POS,
    )


def dim_payment(payments: DataFrame) -> DataFrame:
    """Payment types that occur, in order of their first row."""
    kinds = payments.groupBy("payment_type").agg(F.min(POS).alias(POS))
    return kinds.select("payment_type", F.lit(DEFAULT_INSTALLMENT_GROUP).alias("installment_group"), POS)


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes of each ``full_date``; ISO week and weekday, names without padding."""
    day = F.col("full_date")
    return days.select(
        calendar.date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        calendar.iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        calendar.iso_weekday(day).isin(6, 7).alias("is_weekend"),
    )
