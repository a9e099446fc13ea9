"""Benchmark: headline models on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed fully with the ``noop`` sink (no collect to the
driver): one warm-up run, then the median of three timed runs. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldnotes.params import FIXTURE_PARAMS  # noqa: E402
from fieldnotes.plans import jobs  # noqa: E402
from fieldnotes.plans.registry import QUERIES  # noqa: E402
from fieldnotes.schemas import RAW_OBSERVATION, conform  # noqa: E402
from fieldnotes.session import build_session, scratch_path  # noqa: E402
from fieldnotes.sources.testdata import raw_observations  # noqa: E402

HEADLINE = [
    "stg_observations",
    "daily_summary",
    "monthly_summary",
    "daily_species_summary",
    "monthly_species_summary",
    "monthly_species_summary_by_location",
    "weekly_species_summary",
    "forecast_prep_species",
    "forecast_prep_species_location",
    "day_of_week_summary",
    "forecast_all",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = build_session(master=f"local[{cpus}]", app="fieldnotes-bench", shuffle_partitions=shuffle,
                          **{"spark.driver.memory": "16g"})
    timings: dict[str, float] = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)  # warm-up
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    # The mapping of the test tables to the raw log is timed apart from the models.
    # The transform job builds every model in one run: staging is written once
    # to the shared folder and all models read it (seconds, not in "value").
    warehouse = scratch_path(spark, "bench-warehouse")
    t0 = time.perf_counter()
    conform(raw_observations(spark, sf_dir, FIXTURE_PARAMS), RAW_OBSERVATION).write.parquet(f"{warehouse}/observations")
    mapping_sec = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    jobs.transform(spark, FIXTURE_PARAMS, warehouse)
    transform_sec = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "mapping_and_raw_log_sec": mapping_sec,
        "transform_job_all_models_sec": transform_sec,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
