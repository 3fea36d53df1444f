"""Rows every warehouse starts with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Payment types known before any file is read, in key order.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
DEFAULT_INSTALLMENT_GROUP = "1 installment"


def payment_types(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{name}', '{DEFAULT_INSTALLMENT_GROUP}', {i}L)" for i, name in enumerate(PAYMENT_TYPES))
    return spark.sql(f"select * from values {rows} as seeds(payment_type, installment_group, _ingest_pos)")
