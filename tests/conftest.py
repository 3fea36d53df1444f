from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.schemas import POS, RAW_SCHEMAS  # noqa: E402
from starloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, app="starloom-tests")


def ts(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text) if text else None


RAW_ROWS = {
    "customers": [
        ("c1", "anna", " sp ", "campinas"),
        ("c2", "anna", "rj", "santa barbara d'oeste"),
        ("c3", "bruno", "\tmg\n", "  2nd city"),
        ("c4", "anna", " sp ", "são paulo-zona 1b "),
        ("c5", "carla", "ba", "salvador"),
        ("c6", "bruno", "mg", "juiz de fora"),
    ],
    "orders": [
        ("o1", "c1", "delivered", "2017-01-10 23:00:00", "2017-01-11 00:00:00", "2017-01-11 01:00:00", "2017-01-20 00:00:00"),
        ("o2", "c2", "delivered", "2017-02-01 08:00:00", None, "2017-02-10 12:00:00", "2017-02-11 00:00:00"),
        ("o3", "c3", "delivered", "2017-02-01 09:00:00", None, "2017-02-20 18:00:00", "2017-02-20 00:00:00"),
        ("o4", "c4", "shipped", "2018-03-01 10:00:00", None, "2018-03-05 10:00:00", "2018-03-10 00:00:00"),
        ("o5", "c5", "delivered", "2018-03-02 10:00:00", None, None, "2018-03-10 00:00:00"),
        ("o6", "c6", "delivered", "2018-04-02 10:00:00", None, "2018-05-30 09:00:00", "2018-04-20 00:00:00"),
    ],
    "order_items": [
        ("o1", 1, "p1", "s1", "10.00", "1.00"),
        ("o1", 2, "p2", "s1", "20.00", "2.00"),
        ("o2", 1, "p1", "s2", "30.00", "0.00"),
        ("o3", 1, "p3", "s1", "40.00", "4.00"),
        ("o4", 1, "p1", "s1", "50.00", "5.00"),
        ("o5", 1, "p2", "s2", "60.00", "6.00"),
        ("o6", 1, "p4", "s2", "70.00", "7.00"),
        ("o6", 2, "p4", "s2", "70.00", "7.00"),
        ("o6", 3, "p1", "s2", "15.55", "1.05"),
    ],
    "payments": [
        ("o1", 1, "credit_card", 8, "25.00"),
        ("o1", 2, "voucher", None, "8.00"),
        ("o2", 1, "boleto", 1, "30.00"),
        ("o3", 1, "credit_card", 0, "44.00"),
        ("o4", 1, "debit_card", 1, "55.00"),
        ("o5", 1, "pix", 1, "66.00"),
        ("o6", 1, "credit_card", 3, "170.60"),
    ],
    "reviews": [
        ("o1", 5, None, "great"),
        ("o2", 2, "so so", None),
        ("o1", 1, "changed", "no \"good\",\nreally"),
        ("o6", 4, None, None),
    ],
    "products": [
        ("p1", "beleza", 40.0, 100.0, 2.0, 300.5),
        ("p2", None, None, None, None, None),
        ("p3", "sem_traducao", 10.0, 20.0, 1.0, 1.0),
        ("p4", "auto", 7.0, 8.0, 9.0, 10.0),
    ],
    "sellers": [("s1", " sp", "  rio do sul"), ("s2", "Pr ", "MARINGÁ")],
    "geolocation": [("01001", -23.5, -46.6), ("01001", -23.6, -46.7), ("99999", -1.0, -2.0)],
    "category_translation": [("beleza", " Health_Beauty "), ("auto", "auto")],
}


def make_raw(spark, **changes) -> dict:
    """Hand-made raw tables; ``changes`` replaces the rows of single tables."""
    raw = {}
    for name, rows in (RAW_ROWS | changes).items():
        schema = RAW_SCHEMAS[name]
        typed = []
        for position, row in enumerate(rows):
            values = []
            for field, value in zip(schema.fields, row):
                kind = field.dataType.typeName()
                if value is not None and kind == "timestamp":
                    value = ts(value)
                if value is not None and kind == "decimal":
                    value = Decimal(value)
                values.append(value)
            typed.append((*values, position))
        raw[name] = spark.createDataFrame(typed, type(schema)(list(schema.fields)).add(POS, "long"))
    return raw


@pytest.fixture(scope="session")
def raw(spark):
    return make_raw(spark)


def rows(df, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
