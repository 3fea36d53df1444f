"""Registration of queries and the workspace they run in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog.ctes import with_ctes
from starloom.operators.snapshot import Store
from starloom.plans.quality import CheckSettings
from starloom.plans.warehouse import run_pipeline, transform
from starloom.schemas import POS
from starloom.session import configure, scratch_path
from starloom.sources.dates import covering_years, days_between
from starloom.sources.files import FILE_PATTERNS, extract
from starloom.sources.mapping import mapped_raw


class Workspace:
    """Raw tables, warehouse and exported files for one folder of test tables.

    The warehouse is loaded by the real pipeline on first use and kept for the session, as a
    warehouse is loaded once and queried often.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return mapped_raw(self.spark, self.folder)

    @property
    def calendar_days(self) -> DataFrame:
        """The days of all calendar years with a purchase."""
        return days_between(covering_years(self.raw["orders"], "order_purchase_timestamp"))

    @cached_property
    def root(self) -> str:
        root = scratch_path(self.spark, "warehouse")
        run_pipeline(self.spark, self.raw, root, self.calendar_days, check=None)
        return root

    @cached_property
    def dw(self) -> dict[str, DataFrame]:
        return Store(self.spark, self.root).tables()

    @cached_property
    def transformed(self) -> dict[str, DataFrame]:
        """One batch with keys counted from 1, as it is before any load."""
        return transform(self.raw)

    @cached_property
    def extracted(self) -> dict[str, DataFrame]:
        """The raw tables read back from their CSV files."""
        return extract(self.spark, self.csv_folder)

    @cached_property
    def settings(self) -> CheckSettings:
        years = covering_years(self.raw["orders"], "order_purchase_timestamp").first()
        return CheckSettings(str(years["start"]), str(years["end"]))

    @cached_property
    def csv_folder(self) -> str:
        """The raw tables as CSV files in file order, named the way the file registry expects."""
        folder = scratch_path(self.spark, "csv")
        for name, df in self.raw.items():
            file = FILE_PATTERNS[name].replace("*", "market_")
            ordered = df.repartitionByRange(POS).sortWithinPartitions(POS).drop(POS, "line_number")
            writer = ordered.write.option("header", True).option("escape", '"').option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
            writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            writer.csv(f"{folder}/{file}")
        return folder


_workspaces: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    place = (spark.sparkContext.applicationId, folder)
    if place not in _workspaces:
        _workspaces[place] = Workspace(spark, folder)
    configure(spark)
    return _workspaces[place]


@dataclass(frozen=True)
class Query:
    id: str
    columns: dict[str, str]
    build: Callable[[Workspace], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(workspace(spark, folder))
        return df.select(*[F.col(c).cast(t).alias(c) for c, t in self.columns.items()])

    @property
    def oracle(self) -> str | None:
        """The SQL counterpart with the same column types, for another engine."""
        if self.sql is None:
            return None
        names = {"string": "varchar"}
        casts = ", ".join(f'cast("{c}" as {names.get(t, t)}) as "{c}"' for c, t in self.columns.items())
        return with_ctes(f"select {casts} from ({self.sql}) result")


QUERIES: dict[str, Query] = {}

# "n" marks an integer that may be null: as a double it looks the same in every client.
TYPES = {"i": "bigint", "n": "double", "d": "double", "s": "string", "b": "boolean"}


def columns_of(text: str) -> dict[str, str]:
    """``"year:i name:s share:d"`` as column names and types."""
    return {name: TYPES[kind] for name, kind in (item.split(":") for item in text.split())}


def query(id: str, columns: str, sql: str | None = None):
    """Register a query builder together with its result columns and SQL counterpart."""

    def register(build: Callable[[Workspace], DataFrame]):
        if id in QUERIES:
            raise ValueError(f"{id} is registered twice")
        QUERIES[id] = Query(id, columns_of(columns), build, sql)
        return build

    return register
