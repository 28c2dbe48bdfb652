"""Cost: what a run costs in compute, reading and storage, and per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltworks.config import CostModel, Thresholds
from siltworks.functions.lights import light

GB = float(1024**3)


def with_cost(runs: DataFrame, model: CostModel, limits: Thresholds) -> DataFrame:
    """Compute, IO, storage and total cost per run, with its light."""
    hours = F.col("secs") / 3600
    total = F.round(F.col("compute_usd") + F.col("io_usd") + F.col("storage_usd"), 8)
    limit = limits.max_cost_usd
    return (
        runs.withColumns(
            {
                "compute_usd": F.round(hours * model.compute_usd_per_hour * model.overhead_factor, 8),
                "io_usd": F.round(F.col("input_bytes") / GB * model.io_usd_per_gb, 8),
                "storage_usd": F.round(F.col("output_bytes") / GB * model.storage_usd_per_gb_month, 8),
            }
        )
        .withColumn("total_usd", total)
        .withColumn("light", light(F.col("total_usd"), limit * limits.green_cost_share, limit, lower_is_better=True))
    )


def with_unit_economics(costed: DataFrame, model: CostModel) -> DataFrame:
    """Cost of a thousand rows, rows per US cent and the efficiency score (at most 100)."""
    rows, total = F.col("rows_processed").cast("double"), F.col("total_usd")
    per_1k = F.when(rows > 0, F.round(total / (rows / 1000), 8)).otherwise(F.lit(0.0))
    per_cent = F.when(total > 0, F.round(rows / (total * 100), 1)).otherwise(F.lit(0.0))
    score: Column = F.least(
        F.lit(100.0), F.round(F.col("rows_per_cent") / model.rows_per_cent_at_full_score * 100, 1)
    )
    return (
        costed.withColumn("usd_per_1k_rows", per_1k)
        .withColumn("rows_per_cent", per_cent)
        .withColumn("efficiency_score", score)
    )
