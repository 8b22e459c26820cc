"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (every row is
computed, nothing is collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakevault.plans.queries import QUERIES  # noqa: E402
from lakevault.session import build_session  # noqa: E402

HEADLINE = (
    "hub_new_keys",
    "satellite_new_ever_seen",
    "satellite_new_latest",
    "latest_per_key",
    "current_entity_view",
    "scd1_merged",
    "pipeline_dimension",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def storage_pipeline(spark, sf_dir: str) -> float:
    """The production path: bronze on disk, two daily runs of the customer
    loads (appends + dimension versions) into a fresh scratch folder."""
    import tempfile

    from lakevault.plans import customer as cust
    from lakevault.plans.testdata import customer_bronze_two_days

    base = tempfile.mkdtemp(prefix="lakevault-bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    customer_bronze_two_days(spark, sf_dir).write.partitionBy("año", "mes", "dia").parquet(f"{base}/bronze")
    paths = cust.LakePaths(f"{base}/bronze", *[f"{base}/{n}" for n in ("hub", "general", "phone", "email", "dim")])
    t0 = time.perf_counter()
    for day in (19, 20):
        cust.run_customer_load(spark, paths, f"2024-01-{day} 06:00:00", "bronze/customers", f"2024-01-{day}", 3)
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    # warm-up: JVM, codegen caches and file listing are not what we measure
    run_once(spark, "hash_key_256", sf_dir)
    timings = {}
    for name in names:
        samples = [run_once(spark, name, sf_dir) for _ in range(repeats)]
        timings[name] = round(statistics.median(samples), 3)
    storage = round(storage_pipeline(spark, sf_dir), 3) if os.environ.get("BENCH_STORAGE", "1") == "1" else None
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf,
                "cpus": cpus,
                "repeats": repeats,
                "storage_pipeline_two_days_sec": storage,
            }
        )
    )


if __name__ == "__main__":
    main()
