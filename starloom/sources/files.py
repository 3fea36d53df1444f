"""Raw CSV tables: registry, presence check, reading, ingest to Parquet."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions.text import na_to_null
from starloom.schemas import POS, RAW_SCHEMAS

# Path pattern of each raw table below the data folder.
FILE_PATTERNS: dict[str, str] = {
    "customers": "*customers_dataset.csv",
    "orders": "*orders_dataset.csv",
    "order_items": "*order_items_dataset.csv",
    "payments": "*order_payments_dataset.csv",
    "reviews": "*order_reviews_dataset.csv",
    "products": "*products_dataset.csv",
    "sellers": "*sellers_dataset.csv",
    "geolocation": "*geolocation_dataset.csv",
    "category_translation": "*category_name_translation.csv",
}

#: Raw tables with free text, whose quoted fields may hold line breaks.
FREE_TEXT = {"reviews"}

_FILE_SHIFT = 1 << 40
_SURPLUS = "_surplus"


def expand(spark: SparkSession, pattern: str) -> list[str]:
    """Data files (not folders) that match ``pattern``, in name order."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found: list[str] = []
    for status in fs.globStatus(path) or []:
        if status.isFile():
            found.append(status.getPath().toString())
            continue
        for child in fs.listStatus(status.getPath()):
            name = child.getPath().getName()
            if child.isFile() and not name.startswith(("_", ".")):
                found.append(child.getPath().toString())
    return sorted(found)


def locate(spark: SparkSession, folder: str, patterns: dict[str, str] | None = None) -> dict[str, list[str]]:
    """Files of every registered table; raises before anything is read if one has none."""
    wanted = {name: f"{folder.rstrip('/')}/{pattern}" for name, pattern in (patterns or FILE_PATTERNS).items()}
    located = {name: expand(spark, pattern) for name, pattern in wanted.items()}
    missing = [f"{name}: {wanted[name]}" for name, files in located.items() if not files]
    if missing:
        raise FileNotFoundError("no file for " + "; ".join(missing))
    return located


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names in the first line of a file; nothing else of it is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        line = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([(line or "").removeprefix("\ufeff")]), ()))


def _checked_header(name: str, file: str, header: tuple[str, ...]) -> tuple[str, ...]:
    """The header, if every registered column is in it once."""
    for column in RAW_SCHEMAS[name].fieldNames():
        if header.count(column) != 1:
            raise ValueError(f"{name}: {file} has {'no' if column not in header else 'more than one'} column {column}")
    return header


def _marks(text: str, mark: str) -> Column:
    """How often a character occurs in a column."""
    return F.length(text) - F.length(F.replace(F.col(text), F.lit(mark), F.lit("")))


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Physical lines of the files with path, number in the file (from 0) and quote marks before them.

    Files are split into byte blocks. One aggregate over the lines gives, per block, their number and that of their quote marks; what
    comes before a block is a running sum over the blocks of its file. The order inside a block is that of the scan, which both passes share.
    """
    text = spark.read.text(files).select(
        F.col("value"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id")
    )
    text = text.withColumn("_quotes", _marks("value", '"'))
    blocks = text.groupBy("_path", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"), F.sum("_quotes").alias("_q"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # A path is made readable once a block, not once a line.
    decoded = F.url_decode(F.regexp_replace(F.col("_path"), r"\+", "%2B"))
    blocks = blocks.select(
        "_path",
        "_block",
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_lines"),
        F.coalesce(F.sum("_q").over(before), F.lit(0)).alias("_marks"),
        F.regexp_replace(decoded, "^file:/+", "file:/").alias("_file"),
    )
    # One row per block of a file: bounded by the number of splits. The lines keep their partition and order.
    placed = text.join(F.broadcast(blocks), ["_path", "_block"])
    return placed.select("value", F.col("_file").alias("_path"), "_block", (F.col("_lines") + F.col("_id") - F.col("_first")).alias("_line"), "_quotes", (F.col("_marks") % 2 == 1).alias("_inside"))


_PARTS = "_path string, _line long, value string, _block long, _part int"
_WHOLE, _OPENING, _REST = 0, 1, 2


def _joined_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines put together to records while a quoted field is open; what crosses the border of a block stays in parts.

    A record that is open where its block ends is an opening part; lines that continue a record of an earlier block are a rest.
    """
    at, odd, head, lines, first = None, False, False, [], 0
    rows: list[tuple] = []

    def close() -> None:
        """Give the lines gathered: they end here, or their block does."""
        if lines:
            rows.append((at[0], first, "\n".join(lines), at[1], _REST if head else _OPENING if odd else _WHOLE))

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("value", "_path", "_block", "_line", "_quotes", "_inside")]
        for value, path, block, line, quotes, inside in zip(*columns, strict=True):
            if (path, block) != at:
                close()
                at, odd, head, lines, first = (path, block), inside, inside, [], line
            elif not odd:
                close()
                head, lines, first = False, [], line
            lines.append(value)
            odd ^= quotes % 2 == 1
        done, rows = rows, []
        yield pa.RecordBatch.from_pylist([dict(zip(("_path", "_line", "value", "_block", "_part"), row, strict=True)) for row in done], schema=_PARTS_ARROW)
    close()
    yield pa.RecordBatch.from_pylist([dict(zip(("_path", "_line", "value", "_block", "_part"), row, strict=True)) for row in rows], schema=_PARTS_ARROW)


_PARTS_ARROW = pa.schema([("_path", pa.string()), ("_line", pa.int64()), ("value", pa.string()), ("_block", pa.int64()), ("_part", pa.int32())])


def _records(lines: DataFrame, free_text: bool, name: str) -> DataFrame:
    """``value, _path, _line``: logical records, each under the number of its first line.

    Without declared free text a record is a line, and a quoted field open at its end is an error. With free text, lines are put together inside
    their task; the few parts at the borders of blocks meet in a second, small step.
    """
    if not free_text:
        message = F.concat(F.lit(f"{name}: a quoted field runs over the end of a line in "), F.col("_path"), F.lit(": "), F.col("value"))
        whole = F.when(F.col("_inside") | (F.col("_quotes") % 2 == 1), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        return lines.filter(whole).select("value", "_path", "_line")
    parts = lines.mapInArrow(_joined_lines, _PARTS)
    borders = parts.filter(F.col("_part") != _WHOLE)  # two rows a block at most
    in_file = Window.partitionBy("_path").orderBy("_block", F.col("_part").desc())
    borders = borders.withColumn("_chain", F.count_if(F.col("_part") == _OPENING).over(in_file))
    pieces = F.sort_array(F.collect_list(F.struct("_block", F.col("_line").alias("_line"), "value")))
    bridged = borders.groupBy("_path", "_chain").agg(F.min("_line").alias("_line"), pieces.alias("pieces"))
    bridged = bridged.select(F.array_join(F.col("pieces.value"), "\n").alias("value"), "_path", "_line")
    return parts.filter(F.col("_part") == _WHOLE).select("value", "_path", "_line").unionByName(bridged)


def read_table(spark: SparkSession, name: str, files: list[str]) -> DataFrame:
    """One raw table with declared types, missing-value texts as null and its file order.

    Files may order their columns as they like: each is read by the names in its own header, and a file that lacks
    a registered column is an error before any row is read. A row with more fields than the header is an error when it is read; missing
    fields at its end are null. Files are read in splits, also where quoted free text holds line breaks: counts of lines and quote
    marks before a split tell where it begins. Blank lines are no rows. ``_ingest_pos`` ranks rows by file name, then by line in the file.
    """
    schema = RAW_SCHEMAS[name]
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        by_header.setdefault(_checked_header(name, file, header_of(spark, file)), []).append(file)
    ordinals = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "_file string, _ordinal bigint")
    parts = []
    for header, own in by_header.items():
        used = set(schema.fieldNames())
        names = [column if column in used else f"_unused{k}" for k, column in enumerate(header)] + [_SURPLUS]
        records = _records(_lines(spark, own), name in FREE_TEXT, name).filter((F.col("_line") > 0) & (F.length(F.trim("value")) > 0))
        # All fields are text until cleaned. The last column takes what a row has beyond the header.
        fields = F.from_csv(F.col("value"), ", ".join(f"`{column}` string" for column in names), {"escape": '"'})
        # A row without enough commas has no surplus: a filter is judged before the fields are taken and would parse every row once more.
        text = records.select(F.col("_path").alias("_file"), (F.col("_line") - 1).alias("_row"), (_marks("value", ",") >= len(header)).alias("_wide"), fields.alias("_fields"))
        text = text.select("_file", "_row", "_wide", "_fields.*")
        message = F.concat(F.lit(f"{name}: a row has more than {len(header)} fields in "), F.col("_file"), F.lit(": "), F.col(_SURPLUS))
        text = text.filter(F.when(F.col("_wide") & F.col(_SURPLUS).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        position = F.coalesce(F.col("_ordinal"), F.raise_error(F.concat(F.lit(f"{name}: no place for "), F.col("_file"))).cast("bigint")) * _FILE_SHIFT + F.col("_row")
        text = text.join(ordinals, "_file", "left").withColumn(POS, position)
        parts.append(text.select(*[na_to_null(F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields], POS))
    return reduce(DataFrame.unionByName, parts)


def extract(spark: SparkSession, folder: str, patterns: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All raw tables below ``folder`` as lazy DataFrames."""
    return {name: read_table(spark, name, files) for name, files in locate(spark, folder, patterns).items()}


def ingest(raw: dict[str, DataFrame], folder: str) -> tuple[dict[str, DataFrame], dict[str, dict[str, int]]]:
    """Copy the raw tables to splittable Parquet once; report rows and columns of each.

    The counts are observed while the rows are written, so there is no second pass.
    """
    stored: dict[str, DataFrame] = {}
    report: dict[str, dict[str, int]] = {}
    for name, df in raw.items():
        seen = Observation(f"ingest_{name}")
        path = f"{folder.rstrip('/')}/{name}"
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
        stored[name] = df.sparkSession.read.schema(df.schema).parquet(path)
        report[name] = {"rows": seen.get["rows"], "columns": len([c for c in df.columns if c != POS])}
    return stored, report
