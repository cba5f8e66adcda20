"""Time every registered query at one scale factor; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each query
runs to completion with its result discarded. Loading the tables and building the
stored views come first and are timed on their own, as part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from basketry.plans.queries import queries, warehouse  # noqa: E402
from basketry.session import build_session  # noqa: E402


def _timed(action) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    w = warehouse(spark, folder)
    loads = {
        "load_tables": lambda: w.tables,
        "build_clean_views": lambda: (w.oil_clean, w.holidays_clean),
        "lay_out_sales_by_year": lambda: w.train_by_year,
        "build_master": lambda: w.master,
        "build_summaries": lambda: (w.daily, w.store_performance, w.family_performance),
        "build_rollups": lambda: w.summaries,
    }
    _timed(lambda: spark.read.parquet(f"{folder}/region.parquet").count())  # start the JVM
    times = {name: _timed(load) for name, load in loads.items()}
    for name, query in queries().items():
        times[name] = _timed(
            lambda query=query: query(spark, folder).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
