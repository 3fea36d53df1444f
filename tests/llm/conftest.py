from __future__ import annotations

import os

import duckdb
import pytest

from starloom.llm.queries import QUERIES, SQL

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size long, start string"


def words(seed: int, n: int) -> str:
    """Deterministic prose of distinct words."""
    return " ".join(f"w{seed}x{i}" for i in range(n))


BASE = words(1, 120)
#: Nulls in every column, empty and white-space texts, ties, repeated rows, copies, near copies, shared passages, a long text; extra columns with clashing names.
ROWS = [
    (1, BASE, "en", "a"),
    (2, BASE, "en", "a"),
    (3, BASE.replace("w1x60", "other"), "en", "b"),
    (4, words(4, 30) + "\n" + words(1, 120) + "\n" + words(5, 200), "fr", "b"),
    (5, words(6, 80), None, None),
    (6, None, "en", "a"),
    (7, "", "en", "c"),
    (8, " \t\n\x0b ", None, "c"),
    (9, "One two THREE", "de", "c"),
    (10, "one two three", "de", None),
    (11, words(7, 60) + "    " + words(7, 60), "en", "a"),
    (12, "\n".join(["same line here"] * 30), "en", "a"),
    (13, words(8, 6000), "en", "a"),
    (14, "Ünï cödé 漢字 🙂 # * $ % & | < >", "xx", "é"),
    (15, words(6, 80), "en", None),
    (16, words(6, 80), "en", None),
]


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("edge"), ROWS)


def written(spark, path, rows) -> str:
    rows = [(i, t, l, s, len(t) if t else None, 7, "x") for i, t, l, s in rows]
    spark.createDataFrame(rows, DOCUMENTS).coalesce(2).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return str(path)


def against_sql(spark, name: str, folder: str) -> list[tuple]:
    """Rows of a query, after comparing all of them with its SQL."""
    found = QUERIES[name](spark, folder)
    columns = sorted(found.columns)
    rows = sorted((tuple(r) for r in found.select(columns).collect()), key=repr)
    con = duckdb.connect()
    for file in os.listdir(folder):
        path = f"{folder}/{file}"
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    names = ", ".join(f'"{c}"' for c in columns)
    wanted = sorted((tuple(r) for r in con.sql(f"select {names} from ({SQL[name]}) q").fetchall()), key=repr)
    assert rows == wanted
    return rows
