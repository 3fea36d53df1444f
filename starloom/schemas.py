"""Declared schemas and constraints of the raw and the warehouse layer."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
POS = "_ingest_pos"


_TYPES = {
    "string": T.StringType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(10,2)": MONEY,
}


def _struct(columns: str) -> T.StructType:
    """Schema from ``"name type [not null], ..."``; usable before a session exists."""
    fields = []
    for column in columns.split(", "):
        name, kind, *required = column.split(" ")
        fields.append(T.StructField(name, _TYPES[kind], not required))
    return T.StructType(fields)


# Raw layer -----------------------------------------------------------------------------
# Column names as the source files spell them (two are misspelt there).
RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _struct("customer_id string, customer_unique_id string, customer_state string, customer_city string"),
    "orders": _struct(
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
    ),
    "order_items": _struct(
        "order_id string, order_item_id bigint, product_id string, seller_id string, "
        "price decimal(10,2), freight_value decimal(10,2)"
    ),
    "payments": _struct(
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value decimal(10,2)"
    ),
    "reviews": _struct("order_id string, review_score smallint, review_comment_title string, review_comment_message string"),
    "products": _struct(
        "product_id string, product_category_name string, product_name_lenght double, "
        "product_description_lenght double, product_photos_qty double, product_weight_g double"
    ),
    "sellers": _struct("seller_id string, seller_state string, seller_city string"),
    "geolocation": _struct("geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double"),
    "category_translation": _struct("product_category_name string, product_category_name_english string"),
}


# Warehouse layer -----------------------------------------------------------------------
@dataclass(frozen=True)
class TableSpec:
    """What the warehouse promises about one table."""

    schema: T.StructType
    key: str
    natural_key: tuple[str, ...]
    foreign_keys: dict[str, str] = field(default_factory=dict)  # column -> dimension with the same key column
    update_columns: tuple[str, ...] = ()  # measures a reload may change; empty means rows never change
    lengths: dict[str, int] = field(default_factory=dict)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


WAREHOUSE: dict[str, TableSpec] = {
    "dim_customer": TableSpec(
        _struct(
            "customer_key bigint not null, customer_unique_id string not null, customer_state string not null, "
            "customer_city string not null, created_at timestamp"
        ),
        key="customer_key",
        natural_key=("customer_unique_id",),
        lengths={"customer_unique_id": 50, "customer_state": 2, "customer_city": 100},
    ),
    "dim_product": TableSpec(
        _struct(
            "product_key bigint not null, product_id string not null, category_name_english string, "
            "product_name_length int, product_description_length int, photos_qty int, weight_g decimal(10,2), "
            "created_at timestamp"
        ),
        key="product_key",
        natural_key=("product_id",),
        lengths={"product_id": 50, "category_name_english": 100},
    ),
    "dim_seller": TableSpec(
        _struct(
            "seller_key bigint not null, seller_id string not null, seller_state string not null, "
            "seller_city string not null, created_at timestamp"
        ),
        key="seller_key",
        natural_key=("seller_id",),
        lengths={"seller_id": 50, "seller_state": 2, "seller_city": 100},
    ),
    "dim_date": TableSpec(
        _struct(
            "date_key int not null, full_date date not null, year int not null, quarter int not null, "
            "month int not null, month_name string not null, week_of_year int not null, day_of_month int not null, "
            "day_of_week int not null, day_name string not null, is_weekend boolean not null"
        ),
        key="date_key",
        natural_key=("date_key",),
        lengths={"month_name": 10, "day_name": 10},
        ranges={"quarter": (1, 4), "month": (1, 12), "week_of_year": (1, 53), "day_of_month": (1, 31), "day_of_week": (1, 7)},
    ),
    "dim_payment": TableSpec(
        _struct("payment_key bigint not null, payment_type string not null, installment_group string not null, created_at timestamp"),
        key="payment_key",
        natural_key=("payment_type",),
        lengths={"payment_type": 30, "installment_group": 20},
    ),
    "fact_sales": TableSpec(
        _struct(
            "sales_key bigint not null, order_id string not null, order_item_id bigint not null, "
            "customer_key bigint not null, product_key bigint not null, seller_key bigint not null, "
            "date_key int not null, price decimal(10,2) not null, freight_value decimal(10,2) not null, created_at timestamp"
        ),
        key="sales_key",
        natural_key=("order_id", "order_item_id"),
        foreign_keys={
            "customer_key": "dim_customer",
            "product_key": "dim_product",
            "seller_key": "dim_seller",
            "date_key": "dim_date",
        },
        update_columns=("price", "freight_value"),
        lengths={"order_id": 50},
    ),
    "fact_payments": TableSpec(
        _struct(
            "payment_fact_key bigint not null, order_id string not null, payment_sequential int not null, "
            "customer_key bigint not null, date_key int not null, payment_key bigint not null, "
            "payment_value decimal(10,2) not null, payment_installments int not null, created_at timestamp"
        ),
        key="payment_fact_key",
        natural_key=("order_id", "payment_sequential"),
        foreign_keys={"customer_key": "dim_customer", "date_key": "dim_date", "payment_key": "dim_payment"},
        update_columns=("payment_value", "payment_installments"),
        lengths={"order_id": 50},
    ),
    "fact_order_experience": TableSpec(
        _struct(
            "experience_fact_key bigint not null, order_id string not null, customer_key bigint not null, "
            "date_key int not null, delivery_days int, delay_days int, review_score smallint, "
            "is_late_delivery boolean not null, created_at timestamp"
        ),
        key="experience_fact_key",
        natural_key=("order_id",),
        foreign_keys={"customer_key": "dim_customer", "date_key": "dim_date"},
        update_columns=("delivery_days", "delay_days", "review_score", "is_late_delivery"),
        lengths={"order_id": 50},
        ranges={"review_score": (1, 5)},
    ),
}

DIMENSIONS = tuple(name for name in WAREHOUSE if name.startswith("dim_"))
FACTS = tuple(name for name in WAREHOUSE if name.startswith("fact_"))
