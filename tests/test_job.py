import pytest

from starloom import job
from starloom.operators.constraints import ConstraintError
from starloom.operators.snapshot import Store
from starloom.plans.quality import QualityError
from test_files import TEXTS


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, text in TEXTS.items():
        (raw / name).write_text(text.replace("02,NA,rj", "02,rio,rj"), encoding="utf-8")
    return tmp_path


def test_job_loads_and_registers_views(spark, folder):
    paths = [str(folder / name) for name in ("raw", "ingested", "dw")]
    assert job.main([*paths, "--grain", "month"]) == 0
    store = Store(spark, paths[2])
    assert store.versions() == [1] and store.manifest()["grain"] == "month"
    assert "dw_fact_sales" in store.register_views()
    assert spark.sql("select count(*) from dw_fact_sales").first()[0] == 1


def test_job_refuses_what_does_not_pass(spark, folder):
    (folder / "raw" / "shop_order_items_dataset.csv").write_text("order_id,order_item_id,product_id,seller_id,price,freight_value\no1,1,p1,s1,0.00,1\n")
    paths = [str(folder / name) for name in ("raw", "ingested", "dw")]
    with pytest.raises((QualityError, ConstraintError)):
        job.main(paths)
    assert Store(spark, paths[2]).versions() == []
