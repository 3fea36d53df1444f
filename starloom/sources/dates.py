"""Calendar rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The range the date dimension covers unless told otherwise.
DATE_START = "2016-01-01"
DATE_END = "2018-12-31"


def days_between(bounds: DataFrame) -> DataFrame:
    """One ``full_date`` row per day for each row of ``bounds`` (columns start, end), ends included."""
    return bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date"))


def date_series(spark: SparkSession, start: str = DATE_START, end: str = DATE_END) -> DataFrame:
    """One ``full_date`` row per day from ``start`` to ``end``, both included."""
    return days_between(spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")))


def covering_years(df: DataFrame, column: str) -> DataFrame:
    """First and last day (start, end) of the calendar years a timestamp column falls in."""
    return df.agg(
        F.trunc(F.min(column), "year").cast("date").alias("start"),
        F.date_sub(F.add_months(F.trunc(F.max(column), "year"), 12), 1).alias("end"),
    )
