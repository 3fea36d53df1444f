"""Reports on hand-made warehouses, for cases the test tables do not contain."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import make_raw, rows
from starloom.operators.snapshot import empty
from starloom.plans import customers, exploration, logistics, payments, profiling, revenue, sellers
from starloom.schemas import WAREHOUSE


def table(spark, name: str, data: list[dict]):
    """A warehouse table from partial rows; columns left out are null."""
    schema = WAREHOUSE[name].schema
    loose = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame([tuple(r.get(f.name) for f in loose.fields) for r in data], loose)


def warehouse(spark, **data):
    return {n: table(spark, n, data[n]) if n in data else empty(spark, WAREHOUSE[n].schema) for n in WAREHOUSE}


def days(*texts):
    result = []
    for text in texts:
        d = dt.date.fromisoformat(text)
        result.append(dict(date_key=int(d.strftime("%Y%m%d")), full_date=d, year=d.year, month=d.month, quarter=(d.month + 2) // 3, month_name=d.strftime("%B")))
    return result


def pay(order, customer, date_key, value, seq=1, kind=1, n=1):
    return dict(order_id=order, payment_sequential=seq, customer_key=customer, date_key=date_key, payment_key=kind, payment_value=Decimal(value), payment_installments=n)


def test_growth_skips_missing_months_and_guards_zero(spark):
    dw = warehouse(
        spark,
        dim_date=days("2017-01-05", "2017-03-05", "2017-04-05", "2017-05-05"),
        fact_payments=[pay("a", 1, 20170105, "10.00"), pay("b", 1, 20170305, "0.00"), pay("c", 1, 20170405, "5.00"), pay("d", 1, 20170505, "6.00")],
    )
    got = [(r["month"], r["mom_growth_pct"]) for r in revenue.monthly_revenue(dw).collect()]
    assert got == [(1, None), (3, Decimal("-100.00")), (4, None), (5, Decimal("20.00"))]


def test_category_growth_needs_a_base_year(spark):
    sales = [dict(order_id=o, product_key=p, date_key=d, price=Decimal(v)) for o, p, d, v in (
        ("a", 1, 20170105, "10.00"), ("b", 1, 20180105, "15.00"), ("c", 2, 20180105, "9.00"), ("d", 3, 20160105, "1.00"))]
    dw = warehouse(
        spark,
        fact_sales=sales,
        dim_date=days("2016-01-05", "2017-01-05", "2018-01-05"),
        dim_product=[dict(product_key=k, product_id=f"p{k}", category_name_english=c) for k, c in ((1, "x"), (2, "y"), (3, "z"))],
    )
    assert rows(revenue.category_growth(dw)) == [("x", Decimal("10.00"), Decimal("15.00"), Decimal("50.00"))]


def test_split_payment_is_a_second_order_only_in_the_first_reading(spark):
    dw = warehouse(
        spark,
        dim_date=days("2017-01-05", "2017-01-20", "2017-03-06"),
        fact_payments=[
            pay("a", 1, 20170105, "1.00"), pay("a", 1, 20170105, "1.00", seq=2), pay("b", 1, 20170120, "1.00"),
            pay("c", 2, 20170105, "1.00"), pay("d", 2, 20170306, "1.00"),
            pay("e", 3, 20170105, "1.00"),
        ],
    )
    assert rows(customers.days_to_second_payment(dw)) == [(Decimal("30"), 0, 60)]
    assert rows(customers.days_to_second_order(dw)) == [(Decimal("38"), 15, 60)]
    assert rows(customers.repeat_rate(dw)) == [(3, 2, Decimal("66.67"), Decimal("1.67"))]


def test_order_share_counts_an_order_per_payment_type(spark):
    dw = warehouse(
        spark,
        dim_payment=[dict(payment_key=1, payment_type="credit_card"), dict(payment_key=2, payment_type="voucher")],
        fact_payments=[pay("a", 1, 20170105, "1.00"), pay("a", 1, 20170105, "2.00", seq=2, kind=2), pay("b", 1, 20170105, "3.00")],
    )
    got = {r["payment_type"]: (r["total_orders"], r["order_share_pct"]) for r in payments.payment_mix(dw).collect()}
    assert got == {"credit_card": (2, Decimal("66.67")), "voucher": (1, Decimal("33.33"))}
    assert rows(payments.installments(dw), "total_orders", "total_revenue") == [(2, Decimal("4.00"))]


def test_late_rate_of_a_seller_may_exceed_hundred(spark):
    sales = [dict(order_id=o, order_item_id=i, seller_key=1, product_key=1, price=Decimal("2.00")) for o, n in (("a", 5), ("b", 1)) for i in range(n)]
    done = [dict(order_id="a", is_late_delivery=True, delay_days=3, review_score=1), dict(order_id="b", is_late_delivery=False, delay_days=-3, review_score=5)]
    dw = warehouse(
        spark,
        fact_sales=sales,
        fact_order_experience=done,
        dim_seller=[dict(seller_key=1, seller_id="s", seller_state="SP", seller_city="X")],
        dim_product=[dict(product_key=1, product_id="p", category_name_english="c")],
    )
    assert rows(sellers.delayed_sellers(dw, min_orders=2)) == [("s", "SP", 2, 5, Decimal("250.00"), Decimal("2.0"))]
    assert rows(sellers.best_sellers(dw, min_orders=2)) == [("s", "SP", "X", 2, Decimal("12.00"), Decimal("1.67"))]
    assert sellers.best_sellers(dw).count() == 0
    assert rows(sellers.category_ratings(dw, min_reviews=6)) == [("c", 6, Decimal("1.67"), 1, 5, Decimal("16.67"))]
    assert sellers.category_ratings(dw, min_reviews=7).count() == 0


def test_one_order_with_a_third_of_all_lines(spark):
    n = 600
    sales = [dict(order_id="hot" if i % 3 == 0 else f"o{i}", order_item_id=i, seller_key=i % 4, price=Decimal("1.00")) for i in range(n)]
    done = [dict(order_id=o, is_late_delivery=o == "hot", delay_days=1, review_score=2) for o in {s["order_id"] for s in sales}]
    dw = warehouse(spark, fact_sales=sales, fact_order_experience=done, dim_seller=[dict(seller_key=k, seller_id=f"s{k}") for k in range(4)])
    expected = []
    for k in range(4):
        mine = [s for s in sales if s["seller_key"] == k]
        late, orders = sum(s["order_id"] == "hot" for s in mine), len({s["order_id"] for s in mine})
        expected.append((f"s{k}", orders, late))
    assert rows(sellers.delayed_sellers(dw), "seller_id", "total_orders", "late_orders") == expected


def test_delay_average_is_null_without_late_orders(spark):
    dw = warehouse(
        spark,
        dim_customer=[dict(customer_key=1, customer_state="SP"), dict(customer_key=2, customer_state="RJ")],
        fact_order_experience=[
            dict(order_id="a", customer_key=1, delivery_days=7, delay_days=-1, is_late_delivery=False, review_score=3),
            dict(order_id="b", customer_key=1, delivery_days=8, delay_days=None, is_late_delivery=False),
            dict(order_id="c", customer_key=2, delivery_days=None, delay_days=4, is_late_delivery=True, review_score=2),
        ],
    )
    assert rows(logistics.delay_by_state(dw)) == [("RJ", 1, 1, Decimal("100.00"), Decimal("4.0")), ("SP", 2, 0, Decimal("0.00"), None)]
    assert rows(logistics.delivery_time_by_state(dw)) == [("SP", 2, Decimal("7.5"), 7, 8)]
    assert rows(logistics.late_rate(dw)) == [(3, 1, 2, Decimal("33.33"), Decimal("66.67"))]
    assert rows(logistics.rating_by_delivery_time(dw)) == [("1. <= 7 days", 1, Decimal("3.00"))]
    assert [r["delivery_status"] for r in logistics.rating_by_lateness(dw).collect()] == ["On Time", "Late"]


def test_nulls_come_first_in_descending_reports(spark):
    dw = warehouse(
        spark,
        dim_customer=[dict(customer_key=k, customer_state=s) for k, s in ((1, "SP"), (2, "RJ"))],
        fact_order_experience=[dict(order_id="a", customer_key=1, delivery_days=5, is_late_delivery=False)],
        fact_payments=[pay("a", 1, 20170105, "1.00"), pay("b", 2, 20170105, "3.00")],
    )
    assert [r["customer_state"] for r in revenue.order_value_by_state(dw).collect()] == ["RJ", "SP"]


def test_rfm_against_brute_force(spark):
    import random

    random.seed(11)
    start = dt.date(2017, 1, 1)
    calendar = [(start + dt.timedelta(days=i)).isoformat() for i in range(120)]
    paid = []
    for i in range(400):
        d = int(random.choice(calendar).replace("-", ""))
        customer = 1 if i % 3 == 0 else random.randint(2, 83)  # one customer with a third of the payments
        paid.append(pay(f"o{i}", customer, d, f"{random.randint(1, 9)}.00"))
    dw = warehouse(spark, dim_date=days(*calendar), fact_payments=paid)
    base = {}
    for p in paid:
        c = base.setdefault(p["customer_key"], [0, set(), Decimal(0)])
        c[0] = max(c[0], p["date_key"])
        c[1].add(p["order_id"])
        c[2] += p["payment_value"]
    n = len(base)

    def tiles(key):
        ordered = sorted(base, key=lambda c: (key(base[c]), c))
        sizes = [n // 5 + (i < n % 5) for i in range(5)]
        return dict(zip(ordered, [t + 1 for t, size in enumerate(sizes) for _ in range(size)]))

    r, f, m = tiles(lambda v: v[0]), tiles(lambda v: len(v[1])), tiles(lambda v: v[2])
    got = rows(customers.rfm_scores(dw), "customer_key", "r_score", "f_score", "m_score")
    assert got == sorted(((c, r[c], f[c], m[c]) for c in base), key=repr)
    assert sum(x["customer_count"] for x in customers.rfm_segments(dw).collect()) == n


def test_exploration_differs_from_reports_as_documented(spark, raw):
    # All statuses count and untranslated categories drop out.
    assert rows(exploration.category_revenue(raw)) == [(" Health_Beauty ", Decimal("105.55")), ("auto", Decimal("140.00"))]
    assert rows(exploration.repeat_rate(raw)) == [(3, 2, Decimal("66.666667"))]
    # Both reviews of an order count, each per line.
    assert dict(rows(exploration.seller_performance(raw), "seller_id", "avg_review")) == {"s1": Decimal("3.000000"), "s2": Decimal("3.500000")}
    assert rows(exploration.late_rate(raw)) == [(Decimal("20.000000"), Decimal("80.000000"), 5)]
    assert [r["end"] for r in exploration.best_and_worst_categories(raw).collect()].count("top") == 2


def test_null_groups_drop_out_of_exploration(spark):
    raw = make_raw(
        spark,
        order_items=[("o1", 1, "p1", None, "1.00", "0.00"), ("o2", 1, "p1", "s1", "2.00", "0.00"), ("o2", 2, None, "s1", "3.00", "0.00")],
        payments=[("o1", 1, None, 1, "1.00"), (None, 1, "credit_card", 2, "2.00"), ("o2", 1, "credit_card", None, "3.00")],
        reviews=[("o2", None, None, None), ("o2", 4, None, None)],
    )
    assert rows(exploration.seller_delay(raw)) == [("s1", Decimal("-1.000000"))]
    assert rows(exploration.seller_performance(raw)) == [("s1", Decimal("5.00"), Decimal("4.000000"))]
    assert rows(exploration.order_value_by_payment_type(raw)) == [("credit_card", Decimal("3.000000"))]
    assert rows(exploration.order_value_by_installments(raw)) == []
    assert rows(exploration.category_revenue(raw)) == [(" Health_Beauty ", Decimal("3.00"))]


def test_profiles(spark, raw):
    assert dict(rows(profiling.null_counts(profiling.source_columns("products", raw["products"])))) == {
        "product_category_name": 1, "product_name_lenght": 1, "product_description_lenght": 1, "product_photos_qty": 1, "product_weight_g": 1
    }
    report = {r["table"]: (r["rows"], r["missing_values"], r["missing_pct"], r["duplicates"]) for r in profiling.quality_report(raw).collect()}
    assert report["products"] == (4, 5, Decimal("20.83"), 0)
    assert report["geolocation"] == (3, 0, Decimal("0.00"), 0)
    twice = raw | {"sellers": raw["sellers"].unionByName(raw["sellers"])}
    assert {r["table"]: r["duplicates"] for r in profiling.quality_report(twice).collect()}["sellers"] == 2
    assert rows(profiling.first_location_per_zip(raw), "geolocation_zip_code_prefix", "geolocation_lat") == [("01001", -23.5), ("99999", -1.0)]
    assert rows(profiling.lookup_orphans(make_raw(spark, sellers=[])), "orphan_sellers") == [(9,)]
    assert rows(profiling.split_payments(raw)) == [(1, 5, 0), (2, 1, 0)]


@pytest.mark.parametrize("report", [revenue.monthly_revenue, customers.repeat_rate, customers.rfm_segments, logistics.late_rate, payments.payment_mix])
def test_empty_warehouse(spark, report):
    result = report(warehouse(spark)).collect()
    assert all(not v for r in result for v in r)


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_distinct_counts_by_state_do_not_multiply_rows(spark):
    assert "Expand" not in plan_of(revenue.revenue_by_state(warehouse(spark)))


def test_duplicates_are_compared_in_full_only_where_hashes_repeat(spark):
    raw = make_raw(spark)["reviews"]
    twice = raw.unionByName(raw.limit(1))
    content = profiling.source_columns("reviews", twice)
    assert rows(profiling.surplus_by_hash(content), "duplicates") == [(1,)]
    assert "xxhash64" in plan_of(profiling.surplus_by_hash(content))


def test_distinct_customers_roll_up(spark):
    """Bitmaps beyond one bucket, a hot customer, and every level against count(distinct)."""
    from starloom.plans import distincts

    sales = [(i % 70_000 if i % 3 else 7, 20170101 + 100 * (i % 12)) for i in range(90_000)]
    dw = {
        "fact_sales": spark.createDataFrame(sales, "customer_key bigint, date_key int"),
        "dim_date": spark.createDataFrame([(20170101 + 100 * m, 2017, m // 3 + 1, m + 1) for m in range(12)], "date_key int, year int, quarter int, month int"),
        "dim_customer": spark.range(70_000).selectExpr("id as customer_key", "case when id % 5 = 0 then 'SP' else 'RJ' end as customer_state"),
    }
    bitmaps = distincts.customer_bitmaps(dw)
    joined = dw["fact_sales"].join(dw["dim_date"], "date_key").join(dw["dim_customer"], "customer_key")
    for level, keys in distincts.LEVELS.items():
        for state in (False, True):
            by = keys + (["customer_state"] if state else [])
            expected = joined.groupBy(*by).agg(F.count_distinct("customer_key").alias("customers"))
            assert rows(distincts.distinct_customers(bitmaps, level, state)) == rows(expected)
    nothing = distincts.customer_bitmaps(dw | {"fact_sales": dw["fact_sales"].limit(0)})
    assert rows(distincts.distinct_customers(nothing, "all")) == [(0,)] and rows(distincts.distinct_customers(nothing, "month")) == []
