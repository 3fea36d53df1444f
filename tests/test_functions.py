import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from starloom.functions import calendar, labels, numeric, text

SAMPLES = [
    "santa barbara d'oeste", "2nd street", "são paulo", "RIO-DE-janeiro", "  padded ", "\t tabs\n", " nbsp ", "a1b2c3",
    "o'neil's 3rd", "", " ", "ÉVORA", "x" * 50, "\x1cfs\x1f", "ª test", "mcdonald ñandú",
]


def test_strip_and_title_match_python(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES] + [(None,)], "s string")
    got = df.select("s", text.strip(F.col("s")), text.title(F.col("s")), text.clean_title(F.col("s")), text.clean_upper(F.col("s"))).collect()
    for s, stripped, titled, clean, upper in got:
        if s is None:
            assert (stripped, titled, clean, upper) == (None,) * 4
            continue
        assert stripped == s.strip()
        assert titled == s.title()
        assert clean == s.strip().title()
        assert upper == s.strip().upper()


def test_missing_value_texts(spark):
    df = spark.createDataFrame([("NA",), ("nan",), ("",), ("none",), ("0",)], "s string")
    assert [r[0] for r in df.select(text.na_to_null(F.col("s"))).collect()] == [None, None, None, "none", "0"]


def test_elapsed_days_floor_like_timedelta(spark):
    random.seed(1)
    base = dt.datetime(2017, 3, 1)
    pairs = [(base + dt.timedelta(seconds=random.randint(-10**6, 10**6), microseconds=random.randint(0, 999999)), base) for _ in range(300)]
    pairs += [(base, base), (base - dt.timedelta(hours=12), base), (base + dt.timedelta(hours=23), base), (None, base)]
    df = spark.createDataFrame(pairs, "a timestamp, b timestamp")
    for a, b, days in df.select("a", "b", calendar.elapsed_days(F.col("a"), F.col("b"))).collect():
        assert days == (None if a is None else (a - b).days)


def test_unknown_delay_is_not_late(spark):
    df = spark.createDataFrame([(None,), (0,), (-1,), (1,)], "d int")
    assert [r[0] for r in df.select(calendar.is_late(F.col("d"))).collect()] == [False, False, False, True]


def test_calendar_parts_match_python(spark):
    days = [dt.date(2015, 12, 25) + dt.timedelta(days=i) for i in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    c = F.col("d")
    got = df.select("d", calendar.date_key(c), calendar.iso_weekday(c), F.weekofyear(c), calendar.month_period(c)).collect()
    for d, key, weekday, week, month in got:
        assert (key, weekday, week, month) == (int(d.strftime("%Y%m%d")), d.isoweekday(), d.isocalendar().week, d.strftime("%Y-%m"))


def test_labels(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 4, 6, 7, 24)], "n int")
    got = [r[0] for r in df.select(labels.installment_group(F.col("n"))).collect()]
    assert got == ["1 installment", "1 installment", "2-3", "2-3", "4-6", "4-6", "7+", "7+"]
    df = spark.createDataFrame([(n,) for n in (0, 7, 8, 14, 15, 21, 22, 30, 31)], "n int")
    got = [r[0][0] for r in df.select(labels.delivery_bucket(F.col("n"))).collect()]
    assert got == list("112233445")


def test_segments_cover_all_scores(spark):
    def expected(r, f):
        if r >= 4 and f >= 4:
            return "Champions"
        if r >= 3 and f >= 3:
            return "Loyal Customers"
        if r >= 4 and f <= 2:
            return "Recent Customers"
        if r <= 2 and f >= 3:
            return "At Risk"
        return "Lost" if (r, f) == (1, 1) else "Potential Loyalists"

    df = spark.createDataFrame([(r, f) for r in range(1, 6) for f in range(1, 6)], "r int, f int")
    for r, f, segment in df.select("r", "f", labels.rfm_segment(F.col("r"), F.col("f"))).collect():
        assert segment == expected(r, f)


def test_ratios_round_once_and_half_up(spark):
    random.seed(2)
    values = [(random.randint(-500, 10**6), random.randint(1, 999)) for _ in range(500)] + [(1, 8), (-1, 8), (5, 0)]
    df = spark.createDataFrame(values, "a bigint, b bigint")
    for a, b, ratio, percent in df.select("a", "b", numeric.ratio(F.col("a"), F.col("b"), 2), numeric.percent(F.col("a"), F.col("b"))).collect():
        if b == 0:
            assert ratio is None and percent is None
            continue
        exact = Decimal(a) / Decimal(b)
        assert ratio == exact.quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert percent == (exact * 100).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_average_money_does_not_round_twice(spark):
    # 2.3449999... must not become 2.345 and then 2.35.
    amounts = [Decimal("2.34")] * 500_001 + [Decimal("2.35")] * 499_999
    df = spark.createDataFrame([(amounts[0], amounts.count(amounts[0])), (amounts[-1], amounts.count(amounts[-1]))], "v decimal(10,2), n int")
    df = df.select("v", F.explode(F.sequence(F.lit(1), "n")))
    assert df.agg(numeric.average_money(F.col("v"))).first()[0] == Decimal("2.34")
