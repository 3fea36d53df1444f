import pytest

from conftest import make_raw, rows
from starloom.operators.snapshot import Store
from starloom.plans.warehouse import run_pipeline
from starloom.schemas import FACTS, RAW_SCHEMAS, WAREHOUSE
from starloom.streaming.loads import LOG, from_log, load_stream, to_log
from test_load import new_orders


def test_log_round_trip(spark, raw):
    back = from_log(to_log(raw))
    for name in RAW_SCHEMAS:
        assert rows(back[name]) == rows(raw[name]) and back[name].columns == raw[name].columns


def test_a_replayed_batch_gives_no_version(spark, tmp_path):
    batches = [new_orders(spark, 100, 4), new_orders(spark, 104, 4), new_orders(spark, 104, 4, payments=[("o104", 1, "boleto", 1, "9.00")])]
    for i, raw in enumerate(batches):
        to_log(raw).coalesce(1).write.parquet(f"{tmp_path}/log/part={i}")
    log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{tmp_path}/log/part=*")
    root = f"{tmp_path}/dw"
    load_stream(log, root, f"{tmp_path}/checkpoint").awaitTermination()
    store = Store(spark, root)
    assert store.versions() == [1, 2, 3] and store.manifest()["batches"] == {"log": 2}
    loaded = {n: rows(df) for n, df in store.tables().items()}
    load_stream(log, root, f"{tmp_path}/checkpoint-lost").awaitTermination()
    assert store.versions() == [1, 2, 3]
    assert {n: rows(df) for n, df in store.tables().items()} == loaded

    for raw in batches:
        run_pipeline(spark, raw, f"{tmp_path}/by-hand")
    by_hand = Store(spark, f"{tmp_path}/by-hand")
    for fact in FACTS:
        columns = [c for c in WAREHOUSE[fact].schema.fieldNames() if c not in (WAREHOUSE[fact].key, "created_at")]
        assert rows(store.read(fact), *columns) == rows(by_hand.read(fact), *columns)


def test_a_refused_batch_publishes_nothing(spark, tmp_path):
    bad = new_orders(spark, 100, 1, order_items=[("o100", 1, "nowhere", "s1", "5.00", "1.00")])
    to_log(bad).coalesce(1).write.parquet(f"{tmp_path}/log")
    log = spark.readStream.schema(LOG).parquet(f"{tmp_path}/log")
    with pytest.raises(Exception, match="product_key"):
        load_stream(log, f"{tmp_path}/dw", f"{tmp_path}/checkpoint").awaitTermination()
    assert Store(spark, f"{tmp_path}/dw").versions() == []
    good = make_raw(spark)
    assert run_pipeline(spark, good, f"{tmp_path}/dw", check=None, batch=("log", 0)) and run_pipeline(spark, good, f"{tmp_path}/dw", check=None, batch=("log", 0)) == []
