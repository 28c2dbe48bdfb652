"""Availability: how often the runs of a pipeline succeed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from siltworks.config import GREEN, RED, YELLOW, Thresholds
from siltworks.functions.scalars import percent

HISTORY = 100


def registry_aggregates() -> list[Column]:
    """Runs by outcome; an outcome that is neither success nor warning is an error."""
    status = F.col("status")
    good, fair = status == "success", status == "warning"
    return [
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(good).alias("n_success"),
        F.count_if(fair).alias("n_warning"),
        F.count_if(~F.coalesce(good | fair, F.lit(False))).alias("n_error"),
    ]


def with_rates(registry: DataFrame) -> DataFrame:
    """Share of successful and of not failed runs; 0 without runs."""
    runs = F.col("n_runs")

    def rate(part: Column) -> Column:
        return F.coalesce(percent(part, runs, 2), F.lit(0.0))

    return registry.withColumns(
        {
            "success_pct": rate(F.col("n_success")),
            "availability_pct": rate(F.col("n_success") + F.col("n_warning")),
        }
    )


def run_registry(runs: DataFrame) -> DataFrame:
    return runs.groupBy("pipeline_id").agg(*registry_aggregates())


def availability_rates(runs: DataFrame) -> DataFrame:
    return with_rates(run_registry(runs))


def run_history(runs: DataFrame, last: int = HISTORY) -> DataFrame:
    """The latest ``last`` runs of every pipeline.

    Spark limits each pipeline inside every task before the shuffle, so a pipeline with
    most of the runs does not end up whole in one task.
    """
    newest = W.partitionBy("pipeline_id").orderBy(F.col("ts").desc(), F.col("run_id").desc())
    return (
        runs.select("pipeline_id", "run_id", "ts", "status", "secs", F.row_number().over(newest).alias("age"))
        .filter(F.col("age") <= last)
    )


def availability_light(
    available: Column, readable: Column, status: Column, success_pct: Column, limits: Thresholds
) -> Column:
    """Red without a usable source or after an error, yellow if too few runs succeed."""
    usable = F.coalesce(available & readable, F.lit(False))
    return (
        F.when(~usable | (status == "error"), RED)
        .when(success_pct < limits.min_success_pct, YELLOW)
        .otherwise(GREEN)
    )


def availability(
    runs: DataFrame, limits: Thresholds, available: Column | bool = True, readable: Column | bool = True
) -> DataFrame:
    """Registry, rates, last outcome and light per pipeline, in one aggregation."""
    available = available if isinstance(available, Column) else F.lit(available)
    readable = readable if isinstance(readable, Column) else F.lit(readable)
    counted = runs.groupBy("pipeline_id").agg(
        *registry_aggregates(),
        F.max_by("status", F.struct("ts", "run_id")).alias("last_status"),
    )
    return with_rates(counted).withColumn(
        "light", availability_light(available, readable, F.col("last_status"), F.col("success_pct"), limits)
    )
