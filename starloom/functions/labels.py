"""Labels derived from numbers. The texts are fixed values reports depend on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound and label, lowest first; None is the open end.
INSTALLMENT_GROUPS = ((1, "1 installment"), (3, "2-3"), (6, "4-6"), (None, "7+"))
DELIVERY_BUCKETS = (
    (7, "1. <= 7 days"), (14, "2. 8-14 days"), (21, "3. 15-21 days"), (30, "4. 22-30 days"), (None, "5. > 30 days"),
)


def banded(c: Column, bands: tuple[tuple[int | None, str], ...]) -> Column:
    """Label of the first band whose upper bound is not exceeded."""
    *closed, (_, last) = bands
    label = None
    for upper, text in closed:
        label = F.when(c <= upper, text) if label is None else label.when(c <= upper, text)
    return label.otherwise(last)


def installment_group(c: Column) -> Column:
    return banded(c, INSTALLMENT_GROUPS)


def delivery_bucket(c: Column) -> Column:
    return banded(c, DELIVERY_BUCKETS)


def delivery_status(is_late: Column) -> Column:
    return F.when(is_late, "Late").otherwise("On Time")


def quarter_label(year: Column, quarter: Column) -> Column:
    return F.concat(F.lit("Q"), quarter.cast("string"), F.lit("-"), year.cast("string"))


def rfm_segment(r: Column, f: Column) -> Column:
    """Segment from the recency and frequency scores; the first rule that fits wins."""
    return (
        F.when((r >= 4) & (f >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "Recent Customers")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r == 1) & (f == 1), "Lost")
        .otherwise("Potential Loyalists")
    )
