"""Data quality: twenty checks after a load, in one pass per table, and a gate."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from starloom.operators.constraints import orphan_rows
from starloom.operators.dedup import repeated_groups
from starloom.sources.dates import DATE_END, DATE_START

# Orders whose card payments are known to carry zero installments.
KNOWN_ZERO_INSTALLMENTS = ("744bade1fcf9ff3f31d860ace076d422", "1a57108394169c0b47d8f876acc9ba2d")

FILLED, CLEAN, RANGE = "filled", "clean", "range"


@dataclass(frozen=True)
class Check:
    """A check and its texts; ``{n}`` stands for the measured value."""

    id: str
    name: str
    table: str
    kind: str
    good: str
    bad: str
    brief: str | None = None  # text in the summary; None leaves the check out of it


# Ids, names and texts reports are compared by.
CHECKS = (
    Check("QC-01", "fact_sales_not_empty", "fact_sales", FILLED,
          "fact_sales has {n} rows", "FAIL: fact_sales is empty", "fact_sales rows: {n}"),
    Check("QC-02", "fact_sales_no_null_customer_key", "fact_sales", CLEAN,
          "No NULL customer_key found", "FAIL: {n} rows have NULL customer_key", "NULL customer_key count: {n}"),
    Check("QC-03", "fact_sales_no_null_product_key", "fact_sales", CLEAN,
          "No NULL product_key found", "FAIL: {n} rows have NULL product_key"),
    Check("QC-04", "fact_sales_price_positive", "fact_sales", CLEAN,
          "All prices are positive", "FAIL: {n} rows have price <= 0", "Invalid price count: {n}"),
    Check("QC-05", "fact_sales_freight_non_negative", "fact_sales", CLEAN,
          "All freight values are non-negative", "FAIL: {n} rows have negative freight_value"),
    Check("QC-06", "fact_sales_no_duplicates", "fact_sales", CLEAN,
          "No duplicate order_id + order_item_id found", "FAIL: {n} duplicate combinations found"),
    Check("QC-07", "fact_payments_not_empty", "fact_payments", FILLED,
          "fact_payments has {n} rows", "FAIL: fact_payments is empty", "fact_payments rows: {n}"),
    Check("QC-08", "fact_payments_value_non_negative", "fact_payments", CLEAN,
          "All payment values are non-negative", "FAIL: {n} rows have negative payment_value", "Negative payment_value count: {n}"),
    Check("QC-09", "fact_payments_no_null_customer_key", "fact_payments", CLEAN,
          "No NULL customer_key found", "FAIL: {n} rows have NULL customer_key"),
    Check("QC-10", "credit_card_installments_valid", "fact_payments", CLEAN,
          "All credit_card installments >= 1", "FAIL: {n} credit_card rows have installments < 1"),
    Check("QC-11", "fact_order_experience_not_empty", "fact_order_experience", FILLED,
          "fact_order_experience has {n} rows", "FAIL: fact_order_experience is empty", "fact_order_experience rows: {n}"),
    Check("QC-12", "fact_experience_delivery_days_non_negative", "fact_order_experience", CLEAN,
          "All delivery_days are non-negative", "FAIL: {n} rows have negative delivery_days"),
    Check("QC-13", "fact_experience_review_score_valid", "fact_order_experience", CLEAN,
          "All review scores are between 1 and 5", "FAIL: {n} rows have invalid review_score"),
    Check("QC-14", "dim_customer_not_empty", "dim_customer", FILLED,
          "dim_customer has {n} rows", "FAIL: dim_customer is empty", "dim_customer rows: {n}"),
    Check("QC-15", "dim_customer_unique_id_unique", "dim_customer", CLEAN,
          "customer_unique_id is unique in dim_customer", "FAIL: {n} duplicate customer_unique_id found"),
    Check("QC-16", "dim_product_not_empty", "dim_product", FILLED,
          "dim_product has {n} rows", "FAIL: dim_product is empty"),
    Check("QC-17", "dim_date_range_valid", "dim_date", RANGE,
          "Date range: {low} → {high}", "Date range: {low} → {high}", "dim_date rows: {n}"),
    Check("QC-18", "fact_sales_customer_fk_valid", "fact_sales", CLEAN,
          "All customer_key in fact_sales exist in dim_customer", "FAIL: {n} orphan customer_key in fact_sales"),
    Check("QC-19", "fact_sales_product_fk_valid", "fact_sales", CLEAN,
          "All product_key in fact_sales exist in dim_product", "FAIL: {n} orphan product_key in fact_sales"),
    Check("QC-20", "fact_sales_date_fk_valid", "fact_sales", CLEAN,
          "All date_key in fact_sales exist in dim_date", "FAIL: {n} orphan date_key in fact_sales"),
)

COVERS, NONE_OUTSIDE, EXACT_DAYS, STRICT = "covers", "none_outside", "exact_days", "strict"


@dataclass(frozen=True)
class CheckSettings:
    """The calendar that must be loaded, known exceptions, and how the calendar is judged.

    ``covers``: first and last day are present or passed. ``none_outside``: no day lies outside.
    ``exact_days``: the number of days fits. ``strict``: covers and exact_days.
    """

    start: str = DATE_START
    end: str = DATE_END
    known_zero_installments: tuple[str, ...] = KNOWN_ZERO_INSTALLMENTS
    range_rule: str = STRICT

    @property
    def days(self) -> int:
        return (date.fromisoformat(self.end) - date.fromisoformat(self.start)).days + 1


def _measures(
    tables: dict[str, DataFrame], settings: CheckSettings, dimensions: dict[str, DataFrame] | None = None
) -> list[tuple[dict[str, Column], DataFrame]]:
    """Frames to aggregate and, per frame, the value of each check it answers; keys are looked up in ``dimensions``."""
    sales, paid, done = tables["fact_sales"], tables["fact_payments"], tables["fact_order_experience"]
    whole = dimensions or tables
    kinds = whole["dim_payment"].select("payment_key", "payment_type")
    card = (F.col("payment_type") == "credit_card") & (F.col("payment_installments") < 1)
    first, last = F.lit(settings.start).cast("date"), F.lit(settings.end).cast("date")
    rows = F.count(F.lit(1))
    day = F.col("full_date")

    def null(c: str) -> Column:
        return F.count_if(F.col(c).isNull())

    scans = [
        (
            {
                "QC-01": rows,
                "QC-02": null("customer_key"),
                "QC-03": null("product_key"),
                "QC-04": F.count_if(F.col("price") <= 0),
                "QC-05": F.count_if(F.col("freight_value") < 0),
            },
            sales,
        ),
        (
            {
                "QC-07": rows,
                "QC-08": F.count_if(F.col("payment_value") < 0),
                "QC-09": null("customer_key"),
                "QC-10": F.count_if(card & ~F.col("order_id").isin(*settings.known_zero_installments)),
            },
            paid.join(kinds, "payment_key", "left"),
        ),
        (
            {
                "QC-11": rows,
                "QC-12": F.count_if(F.col("delivery_days") < 0),
                "QC-13": F.count_if(~F.col("review_score").between(1, 5)),
            },
            done,
        ),
        ({"QC-14": rows}, tables["dim_customer"]),
        ({"QC-16": rows}, tables["dim_product"]),
        (
            {"QC-17": rows, "low": F.min(day), "high": F.max(day), "outside": F.count_if((day < first) | (day > last))},
            whole["dim_date"],
        ),
        ({"QC-06": rows}, repeated_groups(sales, ["order_id", "order_item_id"])),
        ({"QC-15": rows}, repeated_groups(tables["dim_customer"], ["customer_unique_id"])),
    ]
    for check_id, key, dim in (
        ("QC-18", "customer_key", "dim_customer"),
        ("QC-19", "product_key", "dim_product"),
        ("QC-20", "date_key", "dim_date"),
    ):
        scans.append(({check_id: F.coalesce(F.sum("orphans"), F.lit(0))}, orphan_rows(sales, whole[dim], key)))
    return scans


def _text(template: str) -> Column:
    """Message with the measured numbers put in."""
    filled = F.lit(template)
    for mark, column in (("n", "n"), ("low", "low"), ("high", "high")):
        if "{" + mark + "}" in template:
            filled = F.replace(filled, F.lit("{" + mark + "}"), F.coalesce(F.col(column).cast("string"), F.lit("none")))
    return filled


def _in_range(settings: CheckSettings, rule: str) -> Column:
    covers = (F.col("low") <= F.lit(settings.start).cast("date")) & (F.col("high") >= F.lit(settings.end).cast("date"))
    exact = F.col("QC-17") == settings.days
    rules = {COVERS: covers, NONE_OUTSIDE: F.col("outside") == 0, EXACT_DAYS: exact, STRICT: covers & exact}
    return F.coalesce(rules[rule], F.lit(False))


def _rows(
    tables: dict[str, DataFrame],
    settings: CheckSettings,
    only: list[str] | None,
    rule: str,
    brief: bool,
    gate: bool,
    dimensions: dict[str, DataFrame] | None = None,
) -> DataFrame:
    wanted = {c.id: c for c in CHECKS if (only is None or c.id in only) and (c.brief or not brief)}
    parts = []
    for measures, frame in _measures(tables, settings, dimensions):
        here = [wanted[name] for name in measures if name in wanted]
        if not here:
            continue
        needed = [m for m in measures if m in wanted or not m.startswith("QC-")]
        one = frame.agg(*[measures[m].alias(m) for m in needed])
        for helper in ("low", "high", "outside"):
            if helper not in needed:
                one = one.withColumn(helper, F.lit(None))
        results = []
        for check in here:
            value = F.col("outside") if gate and check.kind == RANGE else F.col(check.id)
            passed = {FILLED: value > 0, CLEAN: value == 0}.get(check.kind)
            passed = _in_range(settings, rule) if passed is None else passed
            threshold = {FILLED: 1, CLEAN: 0, RANGE: settings.days}[check.kind]
            results.append(
                F.struct(
                    F.lit(check.id).alias("check_id"),
                    F.lit(check.name).alias("check_name"),
                    F.when(passed, "PASS").otherwise("FAIL").alias("status"),
                    value.cast("bigint").alias("value"),
                    F.lit(threshold).cast("bigint").alias("threshold"),
                    F.col("low").cast("string").alias("low"),
                    F.col("high").cast("string").alias("high"),
                )
            )
        parts.append(one.select(F.inline(F.array(*results))))
    measured = reduce(DataFrame.unionByName, parts).withColumn("n", F.col("value"))
    message = None
    for check in wanted.values():
        text = _text(check.brief) if brief else F.when(F.col("status") == "PASS", _text(check.good)).otherwise(_text(check.bad))
        here = F.col("check_id") == check.id
        message = F.when(here, text) if message is None else message.when(here, text)
    columns = ["check_id", "check_name", "status", "value", "threshold"]
    return measured.select(*columns, message.alias("message")).orderBy("check_id")


def check_report(
    tables: dict[str, DataFrame], settings: CheckSettings = CheckSettings(), only: list[str] | None = None
) -> DataFrame:
    """Result row of every check (or of those in ``only``), all checks of a table in one scan."""
    return _rows(tables, settings, only, settings.range_rule, brief=False, gate=False)


def check_summary(tables: dict[str, DataFrame], settings: CheckSettings = CheckSettings()) -> DataFrame:
    """The eight headline checks with short texts; the calendar is judged by its number of days."""
    return _rows(tables, settings, None, EXACT_DAYS, brief=True, gate=False)


class QualityError(ValueError):
    """Raised when a load does not pass its checks."""


def gate_report(tables: dict[str, DataFrame], settings: CheckSettings = CheckSettings(), dimensions: dict[str, DataFrame] | None = None) -> DataFrame:
    """The checks as the gate sees them: for the calendar, the days outside the range."""
    rows = _rows(tables, settings, None, NONE_OUTSIDE, brief=False, gate=True, dimensions=dimensions)
    return rows.select("check_id", "check_name", "value", "status")


def run_gate(
    tables: dict[str, DataFrame],
    settings: CheckSettings = CheckSettings(),
    strict: bool = True,
    dimensions: dict[str, DataFrame] | None = None,
    stored: dict[str, int] | None = None,
    met: dict[str, int] | None = None,
) -> list[Row]:
    """Evaluate all checks; raise with the list of failures, or return the rows if not ``strict``.

    For a load's new rows, ``dimensions`` are the whole dimensions, ``stored`` the numbers of rows stored before, and
    ``met`` tells how many natural keys of new rows are stored already. All other checks count faults, of which the stored rows have none.
    """
    kinds = {check.id: check for check in CHECKS}
    duplicates = {"QC-06": "fact_sales", "QC-15": "dim_customer"}
    rows = []
    for row in gate_report(tables, settings, dimensions).collect():  # twenty rows
        value, status, check = row["value"], row["status"], kinds[row["check_id"]]
        if check.kind == FILLED:
            value += (stored or {}).get(check.table, 0)
            status = "PASS" if value else "FAIL"
        elif check.id in duplicates:
            value += (met or {}).get(check.table, 0)
            status = "FAIL" if value else "PASS"
        rows.append(Row(check_id=check.id, check_name=check.name, value=value, status=status))
    failed = [f"{r['check_id']} {r['check_name']} → {r['value']:,}" for r in rows if r["status"] == "FAIL"]
    if failed and strict:
        raise QualityError(f"{len(failed)} of {len(rows)} checks failed:\n" + "\n".join(failed))
    return rows
