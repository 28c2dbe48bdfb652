"""Phase times and the run log, derived from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltworks.config import PHASES, RAW_PHASES
from siltworks.kpi.performance import FINDINGS, OK_PHASE, RAISED_PHASE, outcome, secs, spent, total

PIPELINES = 20


def phase_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per executed phase: run, phase, seconds, status, time.

    An error event of a validation is one that ended and found errors; of any other phase, one that raised.
    """
    event = F.col("event_id")
    phases = F.array(*[F.lit(p) for p in RAW_PHASES])
    told = F.when(F.col("phase").startswith("validacion"), FINDINGS).otherwise(RAISED_PHASE)
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .withColumn("phase", F.element_at(phases, (event % 6 + 1).cast("int")))
        .select(
            F.floor(event / 6).cast("bigint").alias("run_id"),
            "phase",
            (F.col("value") / 10).alias("secs"),
            F.when(F.col("event_type") == "error", told).otherwise(OK_PHASE).alias("status"),
            "ts",
        )
    )


def run_log(phases: DataFrame, pipelines: int = PIPELINES, timed: bool = False) -> DataFrame:
    """One row per run with its outcome, seconds, rows and bytes; ``timed`` adds the seconds of each phase."""
    rows = F.lit(1000) + F.col("run_id") % 5000
    log = (
        phases.groupBy("run_id")
        .agg(
            F.min("ts").alias("ts"),
            outcome().alias("status"),
            F.round(F.sum("secs"), 6).alias("secs"),
            *(spent() if timed else ()),
        )
        .select(
            "run_id",
            (F.col("run_id") % pipelines).alias("pipeline_id"),
            "ts",
            "status",
            "secs",
            rows.alias("rows_processed"),
            (rows * 80).alias("input_bytes"),
            (rows * 280).alias("output_bytes"),
            *([secs(p) for p in PHASES] if timed else ()),
        )
    )
    return log.withColumn("total_secs", total()) if timed else log
