import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from starloom.catalog import load_queries, loading
from starloom.catalog.registry import workspace
from starloom.operators import keyfilter
from starloom.operators.constraints import orphan_rows
from starloom.operators.dedup import keep_first, keep_last, repeated_groups, surplus_rows
from starloom.operators.positions import with_ntile, with_ntiles, with_position, with_surrogate_key
from starloom.operators.quantiles import describe, quantiles
from starloom.plans import facts
from starloom.plans.warehouse import transform
from starloom.session import materialize, owned_copies, shared_dir
from starloom.sources.mapping import mapped_raw


def skewed(spark, n: int = 3000):
    """A third of the rows share one key and one value; the rest is spread."""
    random.seed(7)
    data = [(i, "hot" if i % 3 == 0 else f"k{random.randint(0, 400)}", 5 if i % 3 == 0 else random.randint(0, 50)) for i in range(n)]
    random.shuffle(data)
    return data, spark.createDataFrame(data, "id bigint, k string, v int").repartition(7)


def test_keep_last_and_first_on_hot_key(spark):
    data, df = skewed(spark)
    last, first, copies = {}, {}, {}
    for i, k, v in sorted(data):
        last[k] = (i, k, v)
        first.setdefault(k, (i, k, v))
        copies[k] = copies.get(k, 0) + 1
    assert rows(keep_last(df, ["k"], "id")) == sorted(last.values(), key=repr)
    assert rows(keep_first(df, ["k"], "id")) == sorted(first.values(), key=repr)
    assert dict(keep_last(df, ["k"], "id", copies="n").select("k", "n").collect()) == copies


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, pos int")
    assert rows(keep_last(df, ["k"], "pos")) == [("a", 3), (None, 2)]
    pairs = spark.createDataFrame([(None, 1), (None, 1), (None, None), ("a", 1)], "a string, b int")
    assert surplus_rows(pairs).first()[0] == int(pairs.toPandas().duplicated().sum()) == 1
    assert surplus_rows(pairs, ["a"]).first()[0] == 2
    assert rows(repeated_groups(pairs, ["a", "b"])) == [(None, 1, 2)]


def test_surplus_rows_of_nothing(spark):
    assert surplus_rows(spark.createDataFrame([], "a int")).first()[0] == 0


def test_position_with_a_third_of_equal_values(spark):
    data, df = skewed(spark)
    got = dict(with_position(df, [F.desc("v"), "id"], "p").select("id", "p").collect())
    expected = {i: n + 1 for n, (i, _, v) in enumerate(sorted(data, key=lambda r: (-r[2], r[0])))}
    assert got == expected


@pytest.mark.parametrize("n", [1, 3, 5, 7, 11, 23, 100])
def test_ntile_equals_builtin(spark, n):
    df = spark.range(n).select((F.col("id") * 37 % 101).alias("v"), "id")
    mine = rows(with_ntile(df, 5, ["v", "id"], "t"), "id", "t")
    builtin = rows(df.withColumn("t", F.ntile(5).over(Window.orderBy("v", "id"))), "id", "t")
    assert mine == builtin


def test_sorted_values_are_spread_over_partitions(spark):
    """The hot value must not end in one partition: the unique last sort key splits it."""
    _, df = skewed(spark, 8000)
    parts = df.repartitionByRange(8, "v", "id").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 8000 / 3


def test_surrogate_keys_continue(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "n string, pos int")
    assert rows(with_surrogate_key(df, "key", ["pos"], 10), "key", "n") == [(11, "a"), (12, "b"), (13, "c")]


def test_position_of_nothing(spark):
    assert with_position(spark.createDataFrame([], "a int"), ["a"], "p").count() == 0


def test_quantiles_match_numpy(spark):
    random.seed(3)
    for size in (1, 2, 5, 500):
        values = [random.choice([5.0, 5.0, random.uniform(0, 100)]) for _ in range(size)]
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        assert quantiles(df, ["v"], (0.0, 0.1, 0.25, 0.5, 0.75, 1.0))["v"] == pytest.approx(np.quantile(values, (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)))
    assert quantiles(spark.createDataFrame([], "v double"), ["v"]) == {"v": [None] * 3}
    two = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    assert quantiles(two, ["a", "b"]) == {"a": [1.5, 2.0, 2.5], "b": [None] * 3}


def test_describe_matches_pandas(spark):
    data, df = skewed(spark, 900)
    expected = pd.DataFrame(data, columns=["id", "k", "v"])[["id", "v"]].describe()
    got = {r["measure"]: r for r in describe(df, ["id", "v"]).collect()}
    for name in ("id", "v"):
        row = got[name]
        assert [row[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(list(expected[name]))


def test_orphans_count_rows_and_null_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "key int")
    dim = spark.createDataFrame([(2,)], "key int")
    assert rows(orphan_rows(fact, dim, "key")) == [(1, 2), (None, 1)]


def test_several_tiles_in_one_sort(spark):
    """Measures of different types, ties, nulls and fewer rows than tiles; one shuffle of ranks by range."""
    import datetime as dt

    data = [(k, dt.date(2020, 1, 1 + k % 9), k * 7 % 5, None if k % 6 == 0 else float(k % 4)) for k in range(53)]
    for n in (53, 3, 1, 0):
        df = spark.createDataFrame(data[:n], "id long, day date, count long, amount double").repartition(4)
        orders = {"a": "day", "b": "count", "c": "amount"}
        together = with_ntiles(df, 5, "id", orders)
        assert together.columns == ["id", "day", "count", "amount", "a", "b", "c"]
        alone = df
        for name, column in orders.items():
            alone = with_ntile(alone, 5, [column, "id"], name)
        assert rows(together) == rows(alone)


def test_owned_copies_go_with_their_block(spark):
    folder = Path(shared_dir(spark).removeprefix("file:")) / "scratch"
    left = lambda: set(folder.iterdir()) if folder.exists() else set()
    df = spark.range(40).withColumn("m", F.col("id") % 7)
    before = left()
    with owned_copies(spark):
        with owned_copies(spark):
            inner = materialize(df, "inner")
            outer = materialize(df, "outer", outlives=1)
            assert inner.count() == 40 and len(left() - before) == 2
        assert outer.count() == 40 and len(left() - before) == 1
        assert with_ntiles(df, 5, "id", {"t": "m"}).count() == 40
    assert left() == before
    kept = materialize(df, "kept")
    assert kept.count() == 40 and len(left() - before) == 1
    with pytest.raises(ZeroDivisionError), owned_copies(spark):
        materialize(df, "failed")
        raise ZeroDivisionError
    assert len(left() - before) == 1


@pytest.mark.parametrize("name", ["QRY-09", "WIN-05", "WIN-06", "XPL-06-describe", "PRF-05"])
def test_registered_queries_leave_no_copy(spark, name):
    folder = Path(shared_dir(spark).removeprefix("file:")) / "scratch"
    query = load_queries()[name]
    workspace(spark, "/root/testdata/sf0.001").dw  # the warehouse is loaded once and stays
    before = set(folder.iterdir())
    with owned_copies(spark):
        assert query.run(spark, "/root/testdata/sf0.001").collect()
        assert set(folder.iterdir()) > before
    assert set(folder.iterdir()) == before


@pytest.mark.parametrize("name", ["SNK-06", "SNK-08"])
def test_repeated_loads_number_the_item_lines_once(spark, name, monkeypatch):
    """the loads read kept item lines; with lazy ones every load shuffles and sorts all lines again. The copy goes at the end."""
    seen = []
    for work in ("run_pipeline", "load"):
        def noted(*given, _work=getattr(loading, work), **more):
            raw = next(g for g in given if isinstance(g, dict))
            seen.append(raw["order_items"]._jdf.queryExecution().optimizedPlan().toString())
            return _work(*given, **more)

        monkeypatch.setattr(loading, work, noted)
    folder = Path(shared_dir(spark).removeprefix("file:")) / "scratch"
    assert load_queries()[name].run(spark, "/root/testdata/sf0.001").collect()
    assert len(seen) >= 2 and not any("Window" in plan for plan in seen)
    assert not [p for p in folder.iterdir() if p.name.startswith("batch-")]


def subqueries_below(plan, node: str, inside: bool = False) -> int:
    """How often a plan computes something beside it below a node of that name."""
    inside = inside or plan.nodeName() == node
    children = plan.children()
    return (inside and "scalar-subquery" in plan.simpleString(1000)) + sum(subqueries_below(children.apply(i), node, inside) for i in range(children.size()))


def test_likely_rows_hold_every_match(spark):
    """rows whose key is surely not among the others are dropped where they are read; nothing else is."""
    raw = mapped_raw(spark, "/root/testdata/sf0.001")
    items, done = raw["order_items"], raw["orders"].filter("order_status = 'delivered'")
    kept = keyfilter.likely(items, done, "order_id", least=0)
    assert subqueries_below(kept._jdf.queryExecution().optimizedPlan(), "Window") == 1
    exact = items.join(done, "order_id", "left_semi")
    assert exact.exceptAll(kept).isEmpty() and kept.exceptAll(items).isEmpty()
    assert exact.count() <= kept.count() < 1.01 * exact.count() < items.count()


def test_likely_of_nothing_and_of_null(spark):
    rows = spark.range(5).selectExpr("if(id = 4, null, concat('k', id)) as k")
    some = spark.createDataFrame([("k1",), ("k3",), (None,)], "k string")
    assert sorted(r.k for r in keyfilter.likely(rows, some, "k", least=0).where("k is not null").collect()) == ["k1", "k3"]
    assert keyfilter.likely(rows, some.limit(0), "k", least=0).count() == 0


def test_likely_leaves_small_and_unknown_tables_alone(spark):
    small, unknown = spark.range(5), spark.createDataFrame([(1,)], "id bigint")
    assert keyfilter.likely(small, small, "id") is small
    assert keyfilter.likely(unknown, small, "id", least=0) is unknown


def test_fact_sales_drops_lines_of_open_orders_where_they_are_read(spark, monkeypatch):
    """all lines were shuffled and numbered, and two thirds of them thrown away afterwards."""
    raw = mapped_raw(spark, "/root/testdata/sf0.001")
    plain = transform(raw)["fact_sales"]
    monkeypatch.setattr(facts, "likely", lambda rows, others, key: keyfilter.likely(rows, others, key, least=0))
    fact = transform(raw)["fact_sales"]
    assert subqueries_below(fact._jdf.queryExecution().optimizedPlan(), "Window") == 1
    assert fact.count() == plain.count() > 0 and fact.exceptAll(plain).isEmpty()
