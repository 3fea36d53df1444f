from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import RAW_ROWS, make_raw, rows
from starloom.operators import keyfilter
from starloom.operators.merge import MergeCount, merge_fact
from starloom.operators.snapshot import Store
from starloom.operators.constraints import ConstraintError
from starloom.plans.quality import QualityError
from starloom.plans.warehouse import key_maps, load, publishable, publishable_draft, run_pipeline, settings_for, transform
from starloom.schemas import FACTS, WAREHOUSE
from starloom.sources import dates

DIM_ROWS = {"dim_customer": 3, "dim_product": 4, "dim_seller": 2, "dim_date": 1096, "dim_payment": 6}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "dw")


def everything(store):
    return {n: rows(df) for n, df in store.tables().items()}


def test_first_load(spark, raw, root):
    metrics = run_pipeline(spark, raw, root, check=None)
    assert [m["stage"] for m in metrics] == ["seed", "load", "commit"]
    store = Store(spark, root)
    tables = store.tables()
    assert {n: tables[n].count() for n in DIM_ROWS} == DIM_ROWS
    # Seeded types keep their keys, the unseeded one follows.
    assert rows(tables["dim_payment"], "payment_key", "payment_type") == [
        (1, "credit_card"), (2, "boleto"), (3, "voucher"), (4, "debit_card"), (5, "not_defined"), (6, "pix")
    ]
    assert rows(tables["fact_payments"], "order_id", "payment_sequential", "payment_key") == [
        ("o1", 1, 1), ("o1", 2, 3), ("o2", 1, 2), ("o3", 1, 1), ("o5", 1, 6), ("o6", 1, 1)
    ]
    for name, df in tables.items():
        assert df.select(WAREHOUSE[name].key).distinct().count() == df.count()
        assert df.schema.simpleString() == WAREHOUSE[name].schema.simpleString()


def test_same_batch_again_changes_nothing(spark, raw, root):
    run_pipeline(spark, raw, root, check=None)
    before = everything(Store(spark, root))
    metrics = run_pipeline(spark, raw, root, check=None)
    assert everything(Store(spark, root)) == before
    counts = metrics[1]["tables"]
    assert counts["fact_sales"] == {"offered": 8, "inserted": 0, "updated": 8}
    assert counts["dim_customer"] == {"offered": 3, "inserted": 0, "updated": 0}


def test_changed_batch(spark, raw, root):
    run_pipeline(spark, raw, root, check=None)
    store = Store(spark, root)
    before = {n: {r[0]: r for r in rows(df)} for n, df in store.tables().items()}
    changed = make_raw(
        spark,
        customers=[("c1", "dora", "sp", "osasco")] + [(c, u, "xx", "moved") for c, u, *_ in RAW_ROWS["customers"][1:]],
        order_items=[(o, i, p, "s2", "99.99", f) for o, i, p, s, price, f in RAW_ROWS["order_items"]],
        sellers=RAW_ROWS["sellers"] + [("s3", "sc", "joinville")],
    )
    run_pipeline(spark, changed, root, check=None)
    tables = store.tables()
    # Stored attributes never change; new people and sellers get the next keys.
    for name in ("dim_customer", "dim_seller"):
        now = {r[0]: r for r in rows(tables[name])}
        assert all(now[k] == v for k, v in before[name].items())
    assert rows(tables["dim_customer"].filter("customer_key > 3"), "customer_key", "customer_unique_id", "customer_city") == [(4, "dora", "Osasco")]
    assert rows(tables["dim_seller"].filter("seller_key > 2"), "seller_key", "seller_id") == [(3, "s3")]
    # Prices change; the customer and seller of a stored line do not.
    sales = {r["sales_key"]: r for r in tables["fact_sales"].collect()}
    assert len(sales) == 8
    for key, old in before["fact_sales"].items():
        new = sales[key]
        assert new["price"] == Decimal("99.99")
        assert (new["customer_key"], new["seller_key"], new["created_at"]) == (old[3], old[5], old[9])


def test_last_duplicate_in_a_batch_wins(spark, root):
    raw = make_raw(spark, payments=[("o1", 1, "boleto", 1, "1.00"), ("o1", 1, "boleto", 4, "3.00"), ("o1", 1, "boleto", 2, "2.00")])
    metrics = run_pipeline(spark, raw, root, check=None)
    assert metrics[1]["tables"]["fact_payments"] == {"offered": 3, "inserted": 1, "updated": 0}
    assert rows(Store(spark, root).read("fact_payments"), "payment_value", "payment_installments") == [(Decimal("2.00"), 2)]


def test_first_duplicate_of_a_dimension_wins(spark, root):
    raw = make_raw(spark, sellers=[("s1", "aa", "first"), ("s1", "bb", "second"), ("s2", "cc", "other")])
    run_pipeline(spark, raw, root, check=None)
    assert rows(Store(spark, root).read("dim_seller"), "seller_key", "seller_id", "seller_state") == [(1, "s1", "AA"), (2, "s2", "CC")]


def test_empty_batch(spark, raw, root):
    run_pipeline(spark, raw, root, check=None)
    store = Store(spark, root)
    draft = store.draft()
    empty = transform(raw)["fact_sales"].filter("1 = 0")
    assert merge_fact(draft, "fact_sales", empty) == MergeCount(0, 0, 0)
    assert draft.manifest["tables"]["fact_sales"] == store.manifest()["tables"]["fact_sales"]


def test_only_touched_periods_are_rewritten(spark, raw, root):
    run_pipeline(spark, raw, root, check=None)
    store = Store(spark, root)
    first = store.manifest()["tables"]["fact_sales"]
    late = make_raw(spark, order_items=[("o6", 1, "p4", "s2", "1.23", "7.00"), ("o2", 9, "p1", "s1", "5.00", "0.00")])
    run_pipeline(spark, late, root, check=None)
    second = store.manifest()["tables"]["fact_sales"]
    # 2018 holds the changed line and moves; 2017 stays in the old folder and gains a line in the new one.
    assert first[0]["parts"] == [2017, 2018]
    assert [(e["path"] == first[0]["path"], e["parts"]) for e in second] == [(True, [2017]), (False, [2017, 2018])]
    sales = rows(store.read("fact_sales"), "order_id", "order_item_id", "price")
    assert len(sales) == 9 and ("o6", 1, Decimal("1.23")) in sales and ("o2", 9, Decimal("5.00")) in sales


def test_month_layout_gives_the_same_rows(spark, raw, tmp_path):
    for grain in ("year", "month"):
        run_pipeline(spark, raw, str(tmp_path / grain), grain=grain, check=None)
        run_pipeline(spark, raw, str(tmp_path / grain), grain=grain, check=None)
    year, month = (Store(spark, str(tmp_path / g), g) for g in ("year", "month"))
    for fact in FACTS:
        columns = [c for c in WAREHOUSE[fact].schema.fieldNames() if c not in (WAREHOUSE[fact].key, "created_at")]
        assert rows(year.read(fact), *columns) == rows(month.read(fact), *columns)


def test_refused_load_leaves_the_stored_version(spark, raw, root):
    run_pipeline(spark, raw, root, check=None)
    before = everything(Store(spark, root))

    def refuse(tables):
        raise ValueError("no")

    with pytest.raises(ValueError):
        run_pipeline(spark, make_raw(spark, sellers=[("s9", "zz", "new")]), root, check=refuse)
    assert Store(spark, root).versions() == [1]
    assert everything(Store(spark, root)) == before


def test_two_writers_cannot_commit_the_same_version(spark, raw, root):
    run_pipeline(spark, raw, root, check=None)
    store = Store(spark, root)
    one, two = store.draft(), store.draft()
    assert one.commit() == 2
    with pytest.raises(RuntimeError, match="another writer"):
        two.commit()


def test_old_version_stays_readable(spark, raw, root):
    run_pipeline(spark, raw, root, check=None)
    run_pipeline(spark, make_raw(spark, order_items=[("o1", 1, "p1", "s1", "77.00", "1.00")]), root, check=None)
    store = Store(spark, root)
    price = lambda v: store.read("fact_sales", store.manifest(v)).filter("order_id = 'o1' and order_item_id = 1").first()["price"]
    assert (price(1), price(2)) == (Decimal("10.00"), Decimal("77.00"))


def test_hot_person_and_hot_order(spark, root):
    """A third of the rows hang on one person, one order and one product."""
    n = 900
    orders = [(f"o{i}", f"c{i}", "delivered", "2017-01-10 10:00:00", None, "2017-01-15 10:00:00", "2017-01-20 00:00:00") for i in range(n)]
    customers = [(f"c{i}", "hot" if i % 3 == 0 else f"u{i}", "sp", f"city {i}") for i in range(n)]
    items = [("o0" if i % 3 == 0 else f"o{i}", i, "p1" if i % 3 == 0 else "p4", "s1", "1.00", "0.10") for i in range(n)]
    run_pipeline(spark, make_raw(spark, orders=orders, customers=customers, order_items=items), root, check=None)
    tables = Store(spark, root).tables()
    assert tables["fact_sales"].count() == n
    assert tables["dim_customer"].count() == n - n // 3 + 1
    assert tables["dim_customer"].filter("customer_unique_id = 'hot'").first()["customer_city"] == "City 897"
    per_person = tables["fact_sales"].groupBy("customer_key").count().orderBy(F.desc("count")).first()["count"]
    assert per_person == n // 3
    assert key_maps(tables)["customer"].count() == n - n // 3 + 1


def test_same_load_again_moves_nothing(spark, raw, root):
    run_pipeline(spark, raw, root, check=None)
    before = Store(spark, root).manifest()["tables"]
    metrics = run_pipeline(spark, raw, root, check=None)
    assert Store(spark, root).manifest()["tables"] == before
    assert next(m for m in metrics if m["stage"] == "load")["tables"]["fact_sales"]["updated"] > 0


def test_another_grain_is_refused(spark, raw, root):
    run_pipeline(spark, raw, root, check=None, grain="month")
    with pytest.raises(ValueError, match="laid out by month"):
        run_pipeline(spark, raw, root, check=None, grain="year")
    assert Store(spark, root).versions() == [1]
    run_pipeline(spark, raw, root, check=None)
    assert Store(spark, root).manifest()["grain"] == "month"
    with pytest.raises(ValueError, match="none of"):
        Store(spark, root, "week")


def test_unfinished_version_file_is_not_read(spark, raw, root):
    run_pipeline(spark, raw, root, check=None)
    (Path(root) / "_versions" / ".00000002-unfinished").write_text("")
    store = Store(spark, root)
    assert store.versions() == [1] and store.manifest()["version"] == 1
    assert not [p for p in (Path(root) / "_versions").iterdir() if p.name.startswith(".0") and p.stat().st_size and not p.name.endswith(".crc")]


def test_default_load_refuses_unknown_products(spark, root):
    unknown = make_raw(spark, order_items=[("o1", 1, "nowhere", "s1", "10.00", "1.00")])
    with pytest.raises(ConstraintError, match="product_key"):
        run_pipeline(spark, unknown, root)
    assert Store(spark, root).versions() == []


def new_orders(spark, first, n=3, **changes):
    """A batch of orders nobody has seen, of one known person."""
    ids = range(first, first + n)
    tables = {
        "orders": [(f"o{i}", f"c{i}", "delivered", "2017-03-10 10:00:00", None, "2017-03-15 10:00:00", "2017-03-20 00:00:00") for i in ids],
        "customers": [(f"c{i}", "ana", "sp", "santos") for i in ids],
        "order_items": [(f"o{i}", 1, "p1", "s1", "5.00", "1.00") for i in ids],
        "payments": [(f"o{i}", 1, "boleto", 1, "6.00") for i in ids],
        "reviews": [(f"o{i}", 5, None, None) for i in ids],
    }
    return make_raw(spark, **(tables | changes))


def spoil(root, manifest):
    """Overwrite every stored fact file, so that whoever reads one fails."""
    for fact in FACTS:
        for entry in manifest["tables"][fact]:
            for file in (Path(root) / entry["path"]).rglob("*.parquet"):
                file.write_bytes(b"unreadable")
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def test_new_orders_open_no_old_fact_file(spark, root):
    run_pipeline(spark, new_orders(spark, 100, 50), root)
    store = Store(spark, root)
    old = store.manifest()
    assert old["checked"]
    spoil(root, old)
    metrics = run_pipeline(spark, new_orders(spark, 500, 40), root)
    load = next(m for m in metrics if m["stage"] == "load")["tables"]
    assert all(load[fact] == {"offered": 40, "inserted": 40, "updated": 0} for fact in FACTS)
    new = store.manifest()
    fresh = store.read("fact_sales", {"tables": {"fact_sales": [e for e in new["tables"]["fact_sales"] if e not in old["tables"]["fact_sales"]]}})
    assert fresh.count() == 40 and len(new["tables"]["fact_sales"]) == 2
    with pytest.raises(Exception, match="Parquet|parquet"):
        store.read("fact_sales").collect()


def test_key_filters_admit_all_own_keys_and_few_others(spark, root):
    run_pipeline(spark, new_orders(spark, 100, 400), root, grain="month")
    draft = Store(spark, root).draft()
    keys = lambda ids: spark.createDataFrame([(f"o{i}", 1) for i in ids], "order_id string, order_item_id bigint")
    every = {f"{e['path']}/_period={p}" for e in draft.entries("fact_sales") for p in e["parts"]}
    assert len(every) == 1
    for i in (100, 250, 499):
        assert draft.may_hold("fact_sales", keys([i])) == every
    assert draft.may_hold("fact_sales", keys(["0", "99999"])) == set(), "beyond the range of keys"
    assert draft.may_hold("fact_sales", keys([f"2{i}x" for i in range(2000)])) in (set(), every)
    assert draft.may_hold("fact_sales", keys([f"2{i}x" for i in range(50)])) == set(), "inside the range, but in no filter"
    assert draft.may_hold("fact_sales", keys([])) == set()
    draft.manifest["tables"]["fact_sales"][0].pop("keys")
    assert draft.may_hold("fact_sales", keys(["0"])) == every, "a folder without a filter is always read"


def test_key_filters_are_filled_and_asked_by_whole_keys(spark, tmp_path):
    """20,000 keys are stored, and asked of seven parts, as one small row each; nothing is broadcast."""
    stored = spark.range(20_000).select((F.col("id") % 7).cast("int").alias("period"), F.concat(F.lit("o"), "id").alias("order_id"))
    blocks = {p: 1 for p in range(6)} | {6: 3}
    built = keyfilter.build(stored, "period", "part=", [F.col("order_id")], blocks)
    assert "Generate" not in built._jdf.queryExecution().executedPlan().toString(), "no row per bit is sorted"
    built.write.parquet(f"{tmp_path}/filters")
    filters = spark.read.schema(keyfilter.FILTER_SCHEMA).parquet(f"{tmp_path}/filters")
    assert filters.count() == 9
    parts = [{"part": f"part={p}", "blocks": b, "low": "o0", "high": "o99999"} for p, b in blocks.items()]

    def hits(rows, one_in=1):
        probe = keyfilter.probe(rows, [F.col("order_id")], parts, filters, one_in)
        found = {r.part: r.hits for r in probe.collect()}
        assert "Broadcast" not in probe._jdf.queryExecution().executedPlan().toString()
        return found

    own = stored.groupBy("period").count().collect()
    found = hits(stored)
    assert all(r["count"] <= found[f"part={r['period']}"] <= r["count"] + 20 for r in own)
    few = hits(stored, 64)
    assert set(few) == set(found) and 100 < sum(few.values()) < 700, "a few keys admit every part"
    assert sum(hits(spark.range(20_000).select(F.concat(F.lit("o"), "id", F.lit("x")).alias("order_id"))).values()) < 40


def test_filters_of_an_earlier_layout_admit_every_key(spark, root):
    run_pipeline(spark, new_orders(spark, 100, 5), root)
    draft = Store(spark, root).draft()
    strange = spark.createDataFrame([("o103x", 1)], "order_id string, order_item_id bigint")
    assert draft.may_hold("fact_sales", strange) == set()
    entry = draft.entries("fact_sales")[0]
    entry.pop("bitmaps")
    assert draft.may_hold("fact_sales", strange) == {f"{entry['path']}/_period={p}" for p in entry["parts"]}


def test_compaction_keeps_rows_and_readers(spark, root):
    store = Store(spark, root)
    for k in range(4):
        run_pipeline(spark, new_orders(spark, 100 + 10 * k, 4, customers=[(f"c{i}", f"person {i}", "sp", "x") for i in range(100 + 10 * k, 104 + 10 * k)]), root, check=None)
    before, last = everything(store), store.manifest()
    assert [len(last["tables"][t]) for t in ("fact_sales", "dim_customer")] == [4, 4]
    assert store.compact() == 5
    assert everything(store) == before
    assert all(len(entries) == 1 for entries in store.manifest()["tables"].values())
    assert store.compact() == 5, "nothing left to move"
    assert {n: rows(df) for n, df in store.tables(last).items()} == before
    run_pipeline(spark, new_orders(spark, 100, 4), root, check=None)
    assert {n: len(r) for n, r in everything(store).items()} == {n: len(r) for n, r in before.items()} | {"dim_customer": len(before["dim_customer"]) + 1}


def test_vacuum_removes_what_no_kept_version_lists(spark, raw, root):
    run_pipeline(spark, raw, root, check=None)
    with pytest.raises(ValueError):
        run_pipeline(spark, new_orders(spark, 100), root, check=lambda tables: (_ for _ in ()).throw(ValueError("no")))
    run_pipeline(spark, new_orders(spark, 200), root, check=None)
    run_pipeline(spark, new_orders(spark, 300), root, check=None)
    store = Store(spark, root)
    store.compact()
    kept = {v: {n: rows(df) for n, df in store.tables(store.manifest(v)).items()} for v in (3, 4)}
    listed = lambda v: {p for es in store.manifest(v)["tables"].values() for e in es for p in (e["path"], e.get("keys")) if p}
    used = listed(3) | listed(4)
    gone = store.vacuum(keep=2)
    assert gone and not used & set(gone)
    assert store.versions() == [3, 4]
    assert {str(p.relative_to(root)) for p in (Path(root) / "data").glob("*/*")} == used
    assert {v: {n: rows(df) for n, df in store.tables(store.manifest(v)).items()} for v in (3, 4)} == kept
    assert store.vacuum(keep=2) == []
    with pytest.raises(ValueError):
        store.vacuum(keep=0)


FAULTS = {
    "unknown product": {"order_items": [("o900", 1, "nowhere", "s1", "5.00", "1.00"), ("o901", 1, "p1", "s1", "5.00", "1.00"), ("o902", 1, "p1", "s1", "5.00", "1.00")]},
    "no price": {"order_items": [("o900", 1, "p1", "s1", "0.00", "1.00")]},
    "negative freight": {"order_items": [("o900", 1, "p1", "s1", "5.00", "-1.00")]},
    "negative payment": {"payments": [("o900", 1, "boleto", 1, "-6.00")]},
    "card without installments": {"payments": [("o900", 1, "credit_card", 0, "6.00")]},
    "score of nine": {"reviews": [("o900", 9, None, None)]},
    "long state": {"sellers": [("s77", "long", "x")]},
    "day outside the calendar": {"orders": [("o900", "c900", "delivered", "2031-03-10 10:00:00", None, "2031-03-15 10:00:00", "2031-03-20 00:00:00")]},
}


def test_checks_of_new_rows_refuse_what_checks_of_all_rows_refuse(spark, root):
    run_pipeline(spark, new_orders(spark, 100), root)
    store = Store(spark, root)
    settings = settings_for(dates.date_series(spark))
    drafts, refusals = [], []
    for fault in FAULTS.values():
        draft = store.draft()
        load(draft, new_orders(spark, 900, 3, **fault))
        with pytest.raises((ConstraintError, QualityError)) as whole:
            publishable({t: draft.read(t) for t in WAREHOUSE}, settings)
        drafts.append(draft)
        refusals.append(str(whole.value))
    spoil(root, store.manifest())
    for draft, refusal in zip(drafts, refusals, strict=True):
        with pytest.raises((ConstraintError, QualityError)) as part:
            publishable_draft(draft, settings)
        assert str(part.value) == refusal


def test_checks_of_new_rows_see_keys_stored_before(spark, root):
    """A row that a faulty merge would store twice."""
    run_pipeline(spark, new_orders(spark, 100), root)
    store = Store(spark, root)
    settings = settings_for(dates.date_series(spark))
    for table, key in (("fact_sales", "order_id, order_item_id"), ("dim_customer", "customer_unique_id")):
        draft = store.draft()
        twice = draft.read(table).limit(1)
        draft.append(table, twice) if table == "dim_customer" else draft.replace_periods(table, twice, [])
        with pytest.raises(ConstraintError) as whole:
            publishable({t: draft.read(t) for t in WAREHOUSE}, settings)
        with pytest.raises(ConstraintError) as part:
            assert publishable_draft(draft, settings) == "new rows"
        assert str(part.value) == str(whole.value) == f"{table} unique ({key}): 1"


def test_gate_follows_the_calendar_of_the_load(spark, root):
    days = dates.date_series(spark, "2017-01-01", "2017-12-31")
    run_pipeline(spark, new_orders(spark, 100), root, days)
    assert (Store(spark, root).manifest()["checked"]["start"], Store(spark, root).read("dim_date").count()) == ("2017-01-01", 365)
    with pytest.raises((ConstraintError, QualityError)):
        late = [(f"o{i}", f"c{i}", "delivered", "2018-03-10 10:00:00", None, "2018-03-15 10:00:00", "2018-03-20 00:00:00") for i in (7, 8, 9)]
        run_pipeline(spark, new_orders(spark, 7, 3, orders=late), root, days)
    assert Store(spark, root).versions() == [1]


def test_first_load_of_a_fact_writes_its_rows_once(spark, raw, root):
    """a fact without stored rows has nothing to compare with, so its rows pass by no copy; counts are those of a staged load."""
    draft = Store(spark, root).draft()
    first = load(draft, raw)
    assert not [path for path in draft.scratch.paths if "/fact_" in path]
    again = load(draft, raw)
    assert [path for path in draft.scratch.paths if "/fact_" in path]
    for table in FACTS:
        assert first[table].offered == again[table].offered and first[table].inserted == again[table].updated == draft.read(table).count()

    twice = transform(raw)["fact_sales"]
    other = Store(spark, f"{root}-2").draft()
    count = merge_fact(other, "fact_sales", twice.unionByName(twice))
    assert (count.offered, count.inserted) == (2 * twice.count(), twice.count())
    assert other.read("fact_sales").select(WAREHOUSE["fact_sales"].key).distinct().count() == twice.count()
