"""Reading the input tables, keeping intermediate ones in the shared folder, and tables of hashed cells."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.words import lean
from starloom.session import configure, materialize, owned_copies

#: Cells of one row of counts, and of the bitmap of ids. Both are of fixed size, whatever the input.
CELLS = 1 << 20
ID_CELLS = 1 << 23
_CHUNK = 1 << 12


#: Rows of an Arrow batch. Texts are long; a task holds a few batches at a time.
BATCH_ROWS = 1000


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators rely on."""
    spark = configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches end at this size too, for rows that hold whole texts or sets: a thousand long ones would fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, outlives: int = 0) -> DataFrame:
    """Write once to the shared folder and read back: the lineage ends and survives lost executors."""
    prepared(df.sparkSession)
    return materialize(df, f"llm-{label}", outlives)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside go at the end, for work whose result is written by then, and with them shuffle files no longer needed."""
    with owned_copies(spark):
        yield
    release(spark)


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files of frames that nobody refers to any more; it finds them when garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


def chunk_rows(cells: np.ndarray) -> list[tuple[int, bytes]]:
    """A task's cells as ``(chunk, bytes)`` rows; chunks of zeros are left out."""
    return [(i, part.tobytes()) for i, part in enumerate(cells.reshape(-1, _CHUNK)) if part.any()]


def merged_cells(parts: DataFrame, cells: int, dtype: str, combine: Callable = np.add) -> np.ndarray:
    """Tables ``(chunk int, cells binary)`` of all tasks put together chunk by chunk on the executors; ``cells`` numbers reach the driver."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                more = np.frombuffer(part, dtype=dtype)
                found[i] = combine(found[i], more) if i in found else more
        for i, part in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["chunk", "cells"])

    total = np.zeros(cells, dtype=dtype)
    for row in parts.select("chunk", "cells").repartition("chunk").mapInArrow(lean(merge), "chunk int, cells binary").collect():
        total[row.chunk * _CHUNK : (row.chunk + 1) * _CHUNK] = np.frombuffer(row.cells, dtype=dtype)
    return total


def _bitmap(rows: DataFrame, ids: DataFrame, key: str) -> Column:
    """Condition that holds for every row whose key is among ``ids``, and for few others while the bitmap has room.

    The bitmap is of fixed size, made on the executors; where the ids fill it, it lets all rows through.
    """
    cell = F.pmod(F.xxhash64(key), F.lit(ID_CELLS)).cast("int")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(ID_CELLS, dtype=bool)
        for batch in batches:
            seen[batch.column(0).to_numpy()] = True
        found = chunk_rows(np.packbits(seen, bitorder="little"))
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], names=["chunk", "cells"])

    bitmap = merged_cells(ids.select(cell.alias("cell")).mapInArrow(lean(mark), "chunk int, cells binary"), ID_CELLS // 8, "u1", np.bitwise_or)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf(T.BooleanType())
    def maybe(cells: pd.Series) -> pd.Series:
        at = cells.to_numpy()
        return pd.Series((shared.value[at >> 3] >> (at & 7)) & 1 == 1)

    return maybe(cell)


def only_ids(rows: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose key is among ``ids``, exactly: the bitmap keeps most others out of the shuffle, the join decides."""
    ids = ids.select(key).where(F.col(key).isNotNull()).distinct()
    return rows.where(_bitmap(rows, ids, key)).join(ids, key, "left_semi")


def with_matches(rows: DataFrame, matches: DataFrame, key: str = "doc_id") -> DataFrame:
    """Left join with a table of unique keys; rows that the bitmap rules out pass by without a shuffle."""
    maybe = _bitmap(rows, matches, key)
    more = [f for f in matches.schema if f.name != key]
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in more]
    return rows.where(maybe).join(matches, key, "left").select(*rows.columns, *[f.name for f in more]).unionByName(rows.where(~maybe).select("*", *missing))
