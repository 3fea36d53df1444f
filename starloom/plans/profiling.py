"""Profiles of the raw tables and reconciliation between them.

``raw`` maps table names to raw DataFrames; the position column is ours and never counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.numeric import money_sum
from starloom.operators.dedup import keep_first, surplus_rows
from starloom.operators.quantiles import describe
from starloom.plans.dimensions import translated_products
from starloom.schemas import POS, RAW_SCHEMAS

Raw = dict[str, DataFrame]


def source_columns(name: str, df: DataFrame) -> DataFrame:
    return df.select(*[c for c in RAW_SCHEMAS[name].fieldNames() if c in df.columns])


def overview(raw: Raw) -> DataFrame:
    """Rows and columns of every table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(source_columns(name, df).columns)).alias("columns")
        )
        for name, df in raw.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass, for the columns that have any."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column_name", "missing").filter("missing > 0")


def preview(df: DataFrame, order: list[str], n: int = 3, last: bool = False) -> DataFrame:
    """The first (or last) ``n`` rows in an explicit order."""
    return df.orderBy(*[F.desc(c) if last else F.asc(c) for c in order]).limit(n)


def explore_table(name: str, df: DataFrame) -> dict[str, DataFrame]:
    """Shape, missing values, duplicate rows and a sample of one table."""
    content = source_columns(name, df)
    return {
        "shape": overview({name: df}),
        "missing": null_counts(content),
        "duplicates": surplus_by_hash(content),
        "sample": preview(df, [POS]).drop(POS),
    }


def surplus_by_hash(df: DataFrame, name: str = "duplicates") -> DataFrame:
    """Rows beyond the first of equal rows, as ``surplus_rows`` counts them, without a shuffle of whole rows.

    Hashes are counted first; only rows whose hash occurs again are compared in full, so the count stays exact.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    repeated = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")
    return surplus_rows(hashed.join(repeated, "_hash", "left_semi").drop("_hash"), name=name)


def quality_report(raw: Raw) -> DataFrame:
    """Rows, missing values, share of missing cells in percent and duplicate rows per table."""
    parts = []
    for name, df in raw.items():
        content = source_columns(name, df)
        width = len(content.columns)
        empty_cells = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in content.columns])
        one = content.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(empty_cells), F.lit(0)).alias("missing_values"))
        one = one.withColumn("duplicates", surplus_by_hash(content).scalar())
        cells = F.nullif(F.col("rows") * width, F.lit(0)).cast("decimal(19,0)")
        share = F.round(F.col("missing_values").cast("decimal(19,0)") * F.lit(100).cast("decimal(3,0)") / cells, 2)
        parts.append(one.select(F.lit(name).alias("table"), "rows", "missing_values", share.alias("missing_pct"), "duplicates"))
    return reduce(DataFrame.unionByName, parts)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key is not in ``parent``."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Number of orphan rows, counted per key before the join."""
    counted = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = counted.join(parent.select(key).distinct(), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def _side_by_side(parts: list[DataFrame]) -> DataFrame:
    """Put one-row results next to each other through scalar subqueries."""
    base, *others = parts
    return base.select("*", *[p.scalar().alias(p.columns[0]) for p in others])


def customer_coverage(raw: Raw) -> DataFrame:
    customers, orders = raw["customers"], raw["orders"]
    return _side_by_side(
        [
            customers.agg(F.count_distinct("customer_id").alias("customers")),
            orders.agg(F.count_distinct("customer_id").alias("ordering_customers")),
            orphan_count(orders, customers, "customer_id", "orders_without_customer"),
        ]
    )


def orders_per_person(raw: Raw) -> DataFrame:
    """One row per person with the number of their orders; persons without id are left out."""
    people = raw["customers"].select("customer_id", "customer_unique_id")
    owned = raw["orders"].select("customer_id").join(people, "customer_id")
    return owned.filter("customer_unique_id is not null").groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("orders"))


def orders_per_person_profile(raw: Raw) -> DataFrame:
    """Distribution of orders per person and the number of persons with several."""
    counted = orders_per_person(raw)
    repeat = counted.agg(F.count_if(F.col("orders") > 1).alias("repeat_customers"))
    return describe(counted, ["orders"]).withColumn("repeat_customers", repeat.scalar())


def rows_per_order(df: DataFrame, name: str) -> DataFrame:
    return df.filter("order_id is not null").groupBy("order_id").agg(F.count(F.lit(1)).alias(name))


def items_per_order_profile(raw: Raw) -> DataFrame:
    lost = orphan_count(raw["order_items"], raw["orders"], "order_id", "orphan_items")
    return describe(rows_per_order(raw["order_items"], "items"), ["items"]).withColumn("orphan_items", lost.scalar())


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Number of rows per non-null value, most frequent first."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), column)


def split_payments(raw: Raw, top: int = 5) -> DataFrame:
    """How many orders were paid in 1, 2, ... records, most frequent first, with the orphan count."""
    lost = orphan_count(raw["payments"], raw["orders"], "order_id", "orphan_payments")
    counts = value_counts(rows_per_order(raw["payments"], "payments"), "payments", "orders").limit(top)
    return counts.withColumn("orphan_payments", lost.scalar())


def lookup_orphans(raw: Raw) -> DataFrame:
    items = raw["order_items"]
    return _side_by_side(
        [
            orphan_count(raw["reviews"], raw["orders"], "order_id", "orphan_reviews"),
            orphan_count(items, raw["products"], "product_id", "orphan_products"),
            orphan_count(items, raw["sellers"], "seller_id", "orphan_sellers"),
        ]
    )


def grain_check(raw: Raw, key: list[str] | None = None) -> DataFrame:
    """Is the line key unique, and how many orders, products and sellers do the lines name."""
    items = raw["order_items"]
    return _side_by_side(
        [
            surplus_rows(items, key or ["order_id", "order_item_id"], "duplicate_keys"),
            items.agg(F.count(F.lit(1)).alias("total_rows")),
            items.agg(F.count_distinct("order_id").alias("orders")),
            items.agg(F.count_distinct("product_id").alias("products")),
            items.agg(F.count_distinct("seller_id").alias("sellers")),
        ]
    )


def revenue_reconciliation(raw: Raw) -> DataFrame:
    """Item prices plus freight against what was paid."""
    sold = raw["order_items"].agg(
        money_sum("price").alias("price_total"),
        money_sum("freight_value").alias("freight_total"),
        money_sum(F.col("price") + F.col("freight_value")).alias("price_and_freight"),
    )
    paid = raw["payments"].agg(money_sum("payment_value").alias("payment_total"))
    both = _side_by_side([sold, paid])
    return both.withColumn("difference", F.round(F.col("payment_total") - F.col("price_and_freight"), 2))


def payment_breakdown(raw: Raw) -> DataFrame:
    """Payment rows per type, and the total paid by voucher."""
    vouchers = raw["payments"].filter(F.col("payment_type") == "voucher").agg(money_sum("payment_value").alias("voucher_total"))
    return value_counts(raw["payments"], "payment_type", "payments").withColumn("voucher_total", vouchers.scalar())


def first_location_per_zip(raw: Raw) -> DataFrame:
    """The first row of every zip code prefix."""
    return keep_first(raw["geolocation"], ["geolocation_zip_code_prefix"], POS)


def dimension_candidates(raw: Raw) -> DataFrame:
    """Rows and distinct keys of the tables dimensions come from, and the purchase date range."""
    products = translated_products(raw["products"], raw["category_translation"])
    sources = (
        ("customer", raw["customers"], "customer_unique_id"),
        ("product", products, "product_id"),
        ("seller", raw["sellers"], "seller_id"),
        ("location", first_location_per_zip(raw), "geolocation_zip_code_prefix"),
        ("payment", raw["payments"], "payment_type"),
    )
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("unique_keys")).select(
            F.lit(name).alias("dimension"),
            "rows",
            "unique_keys",
            F.lit(None).cast("date").alias("first_day"),
            F.lit(None).cast("date").alias("last_day"),
        )
        for name, df, key in sources
    ]
    bought = F.col("order_purchase_timestamp").cast("date")
    parts.append(
        raw["orders"].agg(
            F.count(bought).alias("rows"),
            F.count_distinct(bought).alias("unique_keys"),
            F.min(bought).alias("first_day"),
            F.max(bought).alias("last_day"),
        ).select(F.lit("date").alias("dimension"), "rows", "unique_keys", "first_day", "last_day")
    )
    return reduce(DataFrame.unionByName, parts)
