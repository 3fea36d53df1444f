import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import make_raw, rows
from starloom.operators import constraints
from starloom.operators.snapshot import Store
from starloom.plans import quality as q
from starloom.plans.warehouse import run_pipeline


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dw"))
    run_pipeline(spark, make_raw(spark), root, check=None)
    return Store(spark, root).tables()


SETTINGS = q.CheckSettings(known_zero_installments=("o3",))


def with_change(tables, name, **columns):
    return tables | {name: tables[name].withColumns(columns)}


def test_good_load_passes(tables):
    report = q.check_report(tables, SETTINGS).collect()
    assert [r["check_id"] for r in report] == [c.id for c in q.CHECKS]
    assert {r["status"] for r in report} == {"PASS"}
    assert len(q.run_gate(tables, SETTINGS)) == 20


def first_row(df, order, **columns):
    """The table with one changed row, the first in ``order``."""
    key = df.orderBy(order).first()[order]
    return df.withColumns({c: F.when(F.col(order) == key, v).otherwise(F.col(c)) for c, v in columns.items()})


BROKEN = {
    "QC-01": lambda t: t | {"fact_sales": t["fact_sales"].limit(0)},
    "QC-02": lambda t: t | {"fact_sales": first_row(t["fact_sales"], "sales_key", customer_key=F.lit(None))},
    "QC-03": lambda t: t | {"fact_sales": first_row(t["fact_sales"], "sales_key", product_key=F.lit(None))},
    "QC-04": lambda t: t | {"fact_sales": first_row(t["fact_sales"], "sales_key", price=F.lit(Decimal("0.00")))},
    "QC-05": lambda t: t | {"fact_sales": first_row(t["fact_sales"], "sales_key", freight_value=F.lit(Decimal("-0.01")))},
    "QC-06": lambda t: t | {"fact_sales": t["fact_sales"].unionByName(t["fact_sales"].filter("order_id = 'o1' and order_item_id = 1"))},
    "QC-07": lambda t: t | {"fact_payments": t["fact_payments"].limit(0)},
    "QC-08": lambda t: t | {"fact_payments": first_row(t["fact_payments"], "payment_fact_key", payment_value=F.lit(Decimal("-1.00")))},
    "QC-09": lambda t: t | {"fact_payments": first_row(t["fact_payments"], "payment_fact_key", customer_key=F.lit(None))},
    "QC-10": lambda t: t | {"fact_payments": t["fact_payments"].withColumn("order_id", F.when(F.col("order_id") == "o3", "o9").otherwise(F.col("order_id")))},
    "QC-11": lambda t: t | {"fact_order_experience": t["fact_order_experience"].limit(0)},
    "QC-12": lambda t: t | {"fact_order_experience": first_row(t["fact_order_experience"], "experience_fact_key", delivery_days=F.lit(-1))},
    "QC-13": lambda t: t | {"fact_order_experience": first_row(t["fact_order_experience"], "experience_fact_key", review_score=F.lit(6))},
    "QC-14": lambda t: t | {"dim_customer": t["dim_customer"].limit(0)},
    "QC-15": lambda t: t | {"dim_customer": t["dim_customer"].unionByName(t["dim_customer"].filter("customer_key = 1"))},
    "QC-16": lambda t: t | {"dim_product": t["dim_product"].limit(0)},
    "QC-17": lambda t: t | {"dim_date": t["dim_date"].filter("date_key <> 20170615")},
    "QC-18": lambda t: t | {"dim_customer": t["dim_customer"].filter("customer_key <> 1")},
    "QC-19": lambda t: t | {"dim_product": t["dim_product"].filter("product_key <> 1")},
    "QC-20": lambda t: t | {"dim_date": t["dim_date"].filter("date_key <> 20170110")},
}
VALUES = {"QC-01": 0, "QC-07": 0, "QC-11": 0, "QC-14": 0, "QC-16": 0, "QC-17": 1095, "QC-18": 3, "QC-19": 3, "QC-20": 2}


@pytest.mark.parametrize("check_id", BROKEN)
def test_each_check_finds_its_violation(tables, check_id):
    row = q.check_report(BROKEN[check_id](tables), SETTINGS, [check_id]).first()
    assert (row["status"], row["value"]) == ("FAIL", VALUES.get(check_id, 1))
    if check_id != "QC-17":
        assert row["message"].startswith("FAIL: ")


def test_messages(tables):
    by_id = {r["check_id"]: r for r in q.check_report(tables, SETTINGS).collect()}
    assert by_id["QC-01"]["message"] == "fact_sales has 8 rows"
    assert by_id["QC-17"]["message"] == "Date range: 2016-01-01 → 2018-12-31"
    assert (by_id["QC-17"]["value"], by_id["QC-17"]["threshold"]) == (1096, 1096)
    summary = q.check_summary(tables, SETTINGS).collect()
    assert [r["check_id"] for r in summary] == ["QC-01", "QC-02", "QC-04", "QC-07", "QC-08", "QC-11", "QC-14", "QC-17"]
    assert summary[-1]["message"] == "dim_date rows: 1096"


def test_three_readings_of_the_calendar_check(spark, tables):
    def status(df, rule):
        settings = q.CheckSettings(range_rule=rule)
        return q.check_report(tables | {"dim_date": df}, settings, ["QC-17"]).first()["status"]

    days = tables["dim_date"]
    later = days.limit(1).withColumn("full_date", F.lit(dt.date(2019, 1, 1)))
    gap = days.filter("date_key <> 20170615")
    cases = {"whole": days, "gap": gap, "longer": days.unionByName(later), "empty": days.limit(0), "gap and longer": gap.unionByName(later)}
    got = {n: "".join(status(df, r)[0] for r in (q.COVERS, q.NONE_OUTSIDE, q.EXACT_DAYS, q.STRICT)) for n, df in cases.items()}
    assert got == {"whole": "PPPP", "gap": "PPFF", "longer": "PFFF", "empty": "FPFF", "gap and longer": "PFPP"}


def test_gate_lists_failures_and_blocks_the_load(spark, tables, tmp_path):
    with pytest.raises(q.QualityError, match="QC-10 credit_card_installments_valid → 1"):
        q.run_gate(tables)
    assert sum(r["status"] == "FAIL" for r in q.run_gate(tables, strict=False)) == 1
    root = str(tmp_path / "dw")
    with pytest.raises(q.QualityError):
        run_pipeline(spark, make_raw(spark), root, check=q.run_gate)
    assert Store(spark, root).versions() == []
    run_pipeline(spark, make_raw(spark), root, check=lambda t: q.run_gate(t, SETTINGS))
    assert Store(spark, root).versions() == [1]


def test_constraints(tables):
    constraints.enforce(tables)
    broken = tables | {
        "fact_sales": first_row(tables["fact_sales"], "sales_key", seller_key=F.lit(None)),
        "fact_payments": tables["fact_payments"].withColumn("payment_key", F.lit(77).cast("bigint")),
        "dim_seller": tables["dim_seller"].withColumn("seller_state", F.lit("long")).withColumn("seller_id", F.lit("same")),
        "fact_order_experience": first_row(tables["fact_order_experience"], "experience_fact_key", review_score=F.lit(0)),
    }
    with pytest.raises(constraints.ConstraintError) as error:
        constraints.enforce(broken)
    lines = sorted(str(error.value).splitlines())
    assert lines == [
        "dim_seller check (seller_state length): 2",
        "dim_seller unique (seller_id): 1",
        "fact_order_experience check (review_score range): 1",
        "fact_payments foreign_key (payment_key): 6",
        "fact_sales foreign_key (seller_key): 1",
        "fact_sales not_null (seller_key): 1",
    ]


def test_gate_sees_days_outside_the_range(tables):
    outside = tables["dim_date"].limit(2).withColumn("full_date", F.lit(dt.date(2020, 1, 1)))
    row = q.gate_report(tables | {"dim_date": tables["dim_date"].unionByName(outside)}, SETTINGS).filter("check_id = 'QC-17'").first()
    assert (row["value"], row["status"]) == (2, "FAIL")
    assert rows(q.gate_report(tables | {"dim_date": tables["dim_date"].limit(0)}, SETTINGS).filter("check_id = 'QC-17'"), "status") == [("PASS",)]
