"""The load as a program: read raw files, ingest them, load the warehouse, publish it if it passes.

usage: spark-submit starloom/job.py RAW_FOLDER INGEST_FOLDER WAREHOUSE_FOLDER [--start DAY] [--end DAY] [--grain year|month] [--unchecked]
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.plans.quality import CheckSettings  # noqa: E402
from starloom.plans.warehouse import publishable, run_pipeline  # noqa: E402
from starloom.session import configure  # noqa: E402
from starloom.sources.dates import DATE_END, DATE_START, date_series  # noqa: E402
from starloom.sources.files import extract, ingest  # noqa: E402


def load(spark: SparkSession, raw: str, ingested: str, warehouse: str, start: str = DATE_START, end: str = DATE_END, grain: str | None = None, checked: bool = True) -> list[dict]:
    """One load from files to a published version; returns the metrics of its stages."""
    configure(spark)
    tables, report = ingest(extract(spark, raw), ingested)
    check = (lambda found: publishable(found, CheckSettings(start, end))) if checked else None
    metrics = run_pipeline(spark, tables, warehouse, date_series(spark, start, end), check, grain)
    return [{"stage": "extract", "tables": report}, *metrics]


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("raw", "ingested", "warehouse"):
        parser.add_argument(name)
    parser.add_argument("--start", default=DATE_START)
    parser.add_argument("--end", default=DATE_END)
    parser.add_argument("--grain", choices=("year", "month"))
    parser.add_argument("--unchecked", action="store_true", help="publish without constraints and checks")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("starloom-load").getOrCreate()
    for row in load(spark, given.raw, given.ingested, given.warehouse, given.start, given.end, given.grain, not given.unchecked):
        print(json.dumps(row))
    return 0


if __name__ == "__main__":
    sys.exit(main())
