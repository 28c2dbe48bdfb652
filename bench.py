"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query runs
twice and the shorter time counts; the first run also pays for compiling its plan.
"""

from __future__ import annotations

import json
import os
import sys
import time

from siltworks.plans import registry
from siltworks.session import build_session

HEADLINE = (
    "scan_delimited_autodetect",
    "null_tokens",
    "tolerant_numeric_cast",
    "null_census",
    "binary_unmappable_census",
    "iqr_bounds",
    "flag_outliers_iqr",
    "clean_contacts",
    "scale_robust",
    "scale_standard",
    "one_hot",
    "feature_matrix",
    "fitted_params_reuse",
    "check_row_counts",
    "check_null_cells",
    "validation_status",
    "sink_parquet_roundtrip",
    "publish_projection",
    "keyed_upsert",
    "load_report",
    "alignment_check",
    "run_history_last_n",
    "kpi_availability",
    "kpi_performance",
    "cost_unit_economics",
    "kpi_missing_pct",
    "kpi_valid_columns",
    "kpi_quality_score",
    "health_score",
    "alerts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": "8g",
            # small tables still use all cores
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(run) -> float:
        started = time.perf_counter()
        run()
        return round(time.perf_counter() - started, 3)

    def execute(name: str) -> None:
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("count(*)").collect()  # starts the engine
    # deriving the contact table and landing it, which the other queries then scan
    seconds = {"land_contacts": timed(lambda: registry.contacts(spark, sf_dir))}
    # typed, cleaned and encoded tables, which validation and KPIs scan
    seconds["land_prepared"] = timed(lambda: registry.tables(spark, sf_dir))
    for name in sys.argv[1:] or HEADLINE:
        seconds[name] = min(timed(lambda: execute(name)) for _ in range(2))
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
