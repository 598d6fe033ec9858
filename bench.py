"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)

Each query is run once unmeasured and then timed as the best of two runs; the
jobs that write tables (cleaning, load) run once to warm up and are timed once.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from almacen.checks.derived import Derived
from almacen.plans import explore
from almacen.plans.cleaning_run import run_cleaning
from almacen.plans.reports import REPORTS
from almacen.plans.star_load import load_star
from almacen.session import configure
from almacen.sources.warehouse import Warehouse

EXPLORE = {
    "e01_sales_histogram": explore.sales_histogram,
    "e02_sales_box_plot": explore.sales_box_plot,
    "e06_country_category_sales": explore.country_category_sales,
    "k01_key_figures": explore.key_figures,
    "k03_sales_trend": explore.sales_trend,
    "k04_top_clients": explore.top_clients,
}


def seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("almacen-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    with tempfile.TemporaryDirectory(prefix="almacen-bench-") as folder:
        if not spark.conf.get("spark.checkpoint.dir", None):
            spark.conf.set("spark.checkpoint.dir", folder)
        inputs = Derived(spark, sf_dir)
        tidy, raw_path = inputs.tidy, inputs.raw_path
        out = inputs.folder
        for measured in (False, True):
            name = f"{out}/bench-{measured}"
            cleaning = seconds(lambda: run_cleaning(spark, raw_path, f"{name}-clean"))
            warehouse = Warehouse(spark, f"{name}-warehouse")
            load = seconds(lambda: load_star(tidy, warehouse))
        times |= {"f04_cleaning_pipeline": cleaning, "d09_load_pipeline": load}
        star = warehouse.read()
        for key, report in {**REPORTS, **EXPLORE}.items():
            report(star).collect()
            times[key] = min(seconds(lambda: report(star).collect()) for _ in range(2))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the cleaning run, the star load, 14 reports and 6 figures",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {key: round(t, 3) for key, t in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
