"""Benchmark: load the warehouse, then time the headline queries. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2):
each query runs once to warm up, then BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from starloom.catalog import load_queries
from starloom.catalog.registry import Workspace
from starloom.plans.quality import check_report, run_gate
from starloom.plans.warehouse import run_pipeline
from starloom.session import local_session, scratch_path

# Every report, every exploratory question, all checks at once, and the row-heavy operators.
PREFIXES = ("QRY-", "XPL-", "DQC-21", "DQC-22", "DQC-25", "PRF-03", "PRF-10", "WIN-05", "WIN-06", "AGG-10", "JON-02", "JON-09", "FN-03")


def drain(df) -> None:
    """Compute all rows without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    started = time.monotonic()
    work()
    return round(time.monotonic() - started, 4)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    ws = Workspace(spark, folder)
    timings: dict[str, float] = {}

    root = scratch_path(spark, "bench")
    timings["ETL-13 first load"] = timed(lambda: run_pipeline(spark, ws.raw, root, ws.calendar_days, check=None))
    timings["ETL-13 same load again"] = timed(lambda: run_pipeline(spark, ws.raw, root, ws.calendar_days, check=None))
    ws.root = root
    drain(check_report(ws.dw, ws.settings))
    timings["DQC gate, 20 checks"] = timed(lambda: run_gate(ws.dw, ws.settings, strict=False))

    for name, query in load_queries().items():
        if not name.startswith(PREFIXES):
            continue
        drain(query.build(ws))
        timings[name] = statistics.median(timed(lambda: drain(query.build(ws))) for _ in range(runs))

    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "shuffle_partitions": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
