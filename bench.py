"""Time every registered query; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (names, comma-separated) may be set.
Each result is computed whole (``noop`` sink), after a warm-up of the session.

``compare`` holds the monthly report of all regions as one job and as a loop over
the regions, on the same data: the loop is the only other way to measure against.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workcal.operators.workdays import monthly_workdays  # noqa: E402
from workcal.plans.gold import region_days  # noqa: E402
from workcal.queries import QUERIES  # noqa: E402
from workcal.queries import inputs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def timed(build: Callable[[], DataFrame]) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def monthly(spark: SparkSession, region: str | None = None) -> DataFrame:
    states = inputs.states(spark, SF_DIR)
    if region is not None:
        states = states.filter(F.col("regiao") == region)
    span = inputs.years(spark, SF_DIR)
    days = region_days(inputs.calendar(spark, SF_DIR, span), states, *span)
    return monthly_workdays(days, ["regiao"])


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS if CPUS.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)

    for warm_up in ("rule_metrics_total", "monthly_workdays_by_region"):
        timed(lambda: QUERIES[warm_up](spark, SF_DIR))
    seconds = {name: timed(lambda: QUERIES[name](spark, SF_DIR)) for name in names}
    compare = {}
    if not chosen:
        regions = [r.r_name for r in inputs.table(spark, SF_DIR, "region").select("r_name").collect()]
        compare = {
            "all_regions_in_one_job": timed(lambda: monthly(spark)),
            "one_job_per_region": round(sum(timed(lambda: monthly(spark, r)) for r in regions), 3),
        }
    scale = re.search(r"sf([\d.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "compare": compare,
                "sf": float(scale.group(1)) if scale else SF_DIR,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
