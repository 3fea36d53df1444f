import pytest

from conftest import rows
from starloom.operators.dedup import keep_last
from starloom.schemas import POS
from starloom.sources import files

TEXTS = {
    "shop_customers_dataset.csv": "customer_id,customer_unique_id,zip,customer_city,customer_state\nc1,u1,01,\"santos\",sp\nc2,u1,02,NA,rj\n",
    "shop_orders_dataset.csv": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
        "order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,,2017-10-10 21:25:13,2017-10-18 00:00:00\n"
        "o2,c2,shipped,2017-10-03 10:56:33,,,,2017-10-18 00:00:00\n"
    ),
    "shop_order_items_dataset.csv": "order_id,order_item_id,product_id,seller_id,price,freight_value\no1,1,p1,s1,58.90,13.29\n",
    "shop_order_payments_dataset.csv": "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,credit_card,8,99.33\no2,1,boleto,,1.5\n",
    "shop_order_reviews_dataset.csv": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message\n"
        'r1,o1,4,null,"first line\nsecond ""quoted"" line"\nr2,o1,5,ok,\n'
    ),
    "shop_products_dataset.csv": (
        "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,product_weight_g\n"
        "p1,beleza,40.0,287.0,1.0,225.0\np2,,,,,\n"
    ),
    "shop_sellers_dataset.csv": "seller_id,seller_zip,seller_city,seller_state\ns1,1,campinas,SP\n",
    "shop_geolocation_dataset.csv": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng\n01037,-23.5,-46.6\n",
    "product_category_name_translation.csv": "﻿product_category_name,product_category_name_english\nbeleza,health_beauty",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in TEXTS.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return tmp_path


def test_extract_types_nulls_and_quotes(spark, folder):
    raw = files.extract(spark, str(folder))
    assert rows(raw["customers"], "customer_id", "customer_city", POS) == [("c1", "santos", 0), ("c2", None, 1)]
    reviews = rows(raw["reviews"], "review_score", "review_comment_title", "review_comment_message")
    assert reviews == [(4, None, 'first line\nsecond "quoted" line'), (5, "ok", None)]
    assert rows(raw["products"], "product_id", "product_name_lenght") == [("p1", 40.0), ("p2", None)]
    assert rows(raw["geolocation"], "geolocation_zip_code_prefix") == [("01037",)]
    assert rows(raw["category_translation"], "product_category_name", "product_category_name_english") == [("beleza", "health_beauty")]
    assert str(raw["orders"].filter("order_id = 'o1'").first()["order_delivered_customer_date"]) == "2017-10-10 21:25:13"
    assert [r[0] for r in raw["payments"].orderBy(POS).select("payment_installments").collect()] == [8, None]


def test_missing_file_is_named_before_reading(spark, folder):
    (folder / "shop_sellers_dataset.csv").rename(folder / "elsewhere.csv")
    with pytest.raises(FileNotFoundError, match="sellers"):
        files.extract(spark, str(folder))


def test_malformed_number_raises(spark, folder):
    (folder / "shop_order_items_dataset.csv").write_text("order_id,order_item_id,product_id,seller_id,price,freight_value\no1,1,p1,s1,abc,1\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.extract(spark, str(folder))["order_items"].collect()


def test_file_order_across_many_files(spark, folder):
    """Rows of later files come later, whatever the file sizes, so the last row of a key is found."""
    header = "customer_id,customer_unique_id,customer_city,customer_state\n"
    (folder / "shop_customers_dataset.csv").unlink()
    parts = folder / "shop_customers_dataset.csv"
    parts.mkdir()
    for n in range(12):
        lines = "".join(f"c{n}_{i},u{i % 5},city{n}_{i},sp\n" for i in range(3 + (n * 7) % 11))
        (parts / f"part-{n:03d} a+b.csv").write_text(header + lines)
    customers = files.extract(spark, str(folder))["customers"]
    expected = [f"c{n}_{i}" for n in range(12) for i in range(3 + (n * 7) % 11)]
    assert [r[0] for r in customers.orderBy(POS).select("customer_id").collect()] == expected
    last = {}
    for n in range(12):
        for i in range(3 + (n * 7) % 11):
            last[f"u{i % 5}"] = f"city{n}_{i}"
    assert dict(keep_last(customers, ["customer_unique_id"], POS).select("customer_unique_id", "customer_city").collect()) == last


def test_ingest_reports_rows_and_columns(spark, folder, tmp_path):
    raw = files.extract(spark, str(folder))
    stored, report = files.ingest(raw, str(tmp_path / "parquet"))
    assert report["reviews"] == {"rows": 2, "columns": 4}
    assert report["products"] == {"rows": 2, "columns": 6}
    assert rows(stored["orders"]) == rows(raw["orders"])


def test_surplus_field_raises_with_file(spark, folder):
    (folder / "shop_sellers_dataset.csv").write_text("seller_id,seller_city,seller_state\ns1,sao paulo, centro,SP\n")
    with pytest.raises(Exception, match="sellers: a row has more than 3 fields in .*shop_sellers_dataset.csv"):
        files.extract(spark, str(folder))["sellers"].select("seller_id").collect()


def test_short_rows_are_null_at_their_end(spark, folder):
    (folder / "shop_sellers_dataset.csv").write_text("seller_id,seller_city,seller_state\ns1,santos\n")
    assert rows(files.extract(spark, str(folder))["sellers"], "seller_id", "seller_city", "seller_state") == [("s1", "santos", None)]


@pytest.mark.parametrize("header, says", [("order_id,score", "no column review_score"), ("order_id,order_id,review_score,review_comment_title,review_comment_message", "more than one column order_id")])
def test_header_without_a_registered_column_raises(spark, folder, header, says):
    (folder / "shop_order_reviews_dataset.csv").write_text(header + "\nr1,o1\n")
    with pytest.raises(ValueError, match=f"reviews: .*shop_order_reviews_dataset.csv has {says}"):
        files.extract(spark, str(folder))


def test_files_of_different_column_order_are_read_by_name(spark, folder):
    (folder / "shop_sellers_dataset.csv").unlink()
    parts = folder / "shop_sellers_dataset.csv"
    parts.mkdir()
    (parts / "a.csv").write_text("seller_id,seller_city,seller_state\ns1,campinas,SP\n")
    (parts / "b.csv").write_text("seller_state,extra,seller_id,seller_city\nRJ,x,s2,rio\n")
    sellers = files.extract(spark, str(folder))["sellers"].orderBy(POS)
    assert [tuple(r) for r in sellers.select("seller_id", "seller_state", "seller_city").collect()] == [("s1", "SP", "campinas"), ("s2", "RJ", "rio")]


def test_split_files_have_the_rows_and_positions_of_whole_ones(spark, tmp_path):
    """Line breaks inside quotes, doubled quotes, empty texts and blank lines, with borders of splits at every place."""
    header = "review_id,order_id,review_score,review_comment_title,review_comment_message\n"
    body = []
    for i in range(60):
        text = ['"one\ntwo ""x"",\n\nthree"', '""', "plain", '"\n"', '"""q""\n"""', '"' + "long line\n" * (i % 7) + '"', ""][i % 7]
        body.append(f'r{i},o{i},{i % 5 + 1},"t, {i}",{text}\n' + ("\n" if i % 11 == 0 else ""))
    for part in ("a", "b"):
        (tmp_path / f"{part}_order_reviews_dataset.csv").write_text(header + "".join(body) + ('r,o,1,"open,\nnever closed' if part == "b" else ""))
    paths = files.locate(spark, str(tmp_path), {"reviews": "*_order_reviews_dataset.csv"})["reviews"]

    def read():
        df = files.read_table(spark, "reviews", paths)
        return rows(df, *df.columns), df.rdd.getNumPartitions()

    whole, _ = read()
    assert len(whole) == 121 and len({r[-1] for r in whole}) == 121
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (37, 64, 301, 1000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            split, partitions = read()
            assert sorted(split, key=repr) == sorted(whole, key=repr)
            assert partitions > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(paths[0])
    in_one_task = [(r["order_id"], r["review_comment_message"]) for r in reader.collect()]
    assert [(r[0], r[3]) for r in sorted(whole, key=lambda r: r[-1])][:60] == in_one_task


def test_split_files_without_free_text_are_read_by_lines(spark, tmp_path):
    header = "seller_id,seller_zip,seller_city,seller_state\n"
    path = tmp_path / "x_sellers_dataset.csv"
    path.write_text(header + "".join(f's{i},1,"city, ""{i}""",SP\n' for i in range(200)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
        df = files.read_table(spark, "sellers", files.expand(spark, str(path)))
        assert df.rdd.getNumPartitions() > 20
        assert sorted(rows(df, "seller_id", "seller_city", POS), key=lambda r: r[2]) == [(f"s{i}", f'city, "{i}"', i) for i in range(200)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    path.write_text(header + 's1,1,"two\nlines",SP\n')
    with pytest.raises(Exception, match="runs over the end of a line"):
        files.read_table(spark, "sellers", files.expand(spark, str(path))).collect()


def test_fields_are_taken_once_and_paths_are_decoded_once_a_block(spark, tmp_path):
    """commas are counted before a row is parsed for a surplus; quoted commas are none."""
    path = tmp_path / "a_sellers_dataset.csv"
    path.write_text('seller_id,seller_state,seller_city\ns1,sp,"x, y, z, w"\ns2,rj,"q"\n')
    df = files.read_table(spark, "sellers", files.expand(spark, str(path)))
    assert [tuple(r)[:3] for r in df.orderBy("seller_id").select("seller_id", "seller_state", "seller_city").collect()] == [("s1", "sp", "x, y, z, w"), ("s2", "rj", "q")]
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    judged = [line for line in plan if "Filter" in line and "from_csv" in line]
    assert all(line.index("replace(value") < line.index("from_csv") for line in judged)
    assert not any("UrlCodec" in line and "from_csv" in line for line in plan)
    path.write_text('seller_id,seller_state,seller_city\ns1,sp,"x, y",more\n')
    with pytest.raises(Exception, match="a row has more than 3 fields"):
        files.read_table(spark, "sellers", files.expand(spark, str(path))).collect()
