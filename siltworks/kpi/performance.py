"""Performance: seconds per phase and run, throughput and the slowest phase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltworks.config import PHASES, RAW_PHASES, Thresholds
from siltworks.functions.lights import light
from siltworks.operators.validate import ERROR, pipeline_status

# Which recorded phases make up a reported phase.
PHASE_PARTS = {
    "ingesta": ("ingesta",),
    "limpieza": ("limpieza",),
    "transformacion": ("transformacion",),
    "validacion": ("validacion_estructural", "validacion_semantica"),
    "carga": ("carga",),
}


def secs(phase: str) -> str:
    return f"{phase}_secs"


def run_keys(phases: DataFrame) -> list[str]:
    """What tells runs apart: numbers of runs may repeat among pipelines."""
    return [c for c in ("pipeline_id", "run_id") if c in phases.columns]


def spent() -> list[Column]:
    """Of the phases of a run: the seconds of each reported phase; an absent phase took 0.0."""
    name = F.col("phase")
    return [
        F.round(F.coalesce(F.sum(F.when(name.isin(*parts), F.col("secs"))), F.lit(0.0)), 4).alias(secs(phase))
        for phase, parts in PHASE_PARTS.items()
    ]


def total() -> Column:
    """The seconds of all reported phases of a run."""
    return F.round(sum((F.col(secs(p)) for p in PHASES[1:]), F.col(secs(PHASES[0]))), 4)


def phase_rollup(phases: DataFrame) -> DataFrame:
    """One row per run with the seconds of each reported phase; an absent phase took 0.0.

    Conditional sums need one shuffle with partial sums, where a pivot would need two.
    """
    return phases.groupBy(*run_keys(phases)).agg(*spent()).withColumn("total_secs", total())


def per_second(amount: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, F.round(amount / seconds, 1)).otherwise(F.lit(0.0))


def with_throughput(rollup: DataFrame, rows: Column, n_features: int) -> DataFrame:
    whole = F.col("total_secs")
    return rollup.withColumns(
        {
            "rows_per_sec": per_second(rows.cast("double"), whole),
            "features_per_sec": per_second(F.lit(float(n_features)), whole),
        }
    )


def slowest_phase() -> Column:
    """The phase that took longest; the first one in order if several did."""
    longest = F.greatest(*[F.col(secs(p)) for p in PHASES])
    chain = F.when(F.col(secs(PHASES[0])) == longest, PHASES[0])
    for phase in PHASES[1:]:
        chain = chain.when(F.col(secs(phase)) == longest, phase)
    return chain


def phase_light(phase: str, limits: Thresholds) -> Column:
    limit = limits.max_phase_secs[phase]
    return light(F.col(secs(phase)), limit * limits.green_phase_share, limit, lower_is_better=True)


def total_light(limits: Thresholds) -> Column:
    limit = limits.max_total_secs
    return light(F.col("total_secs"), limit * limits.green_total_share, limit, lower_is_better=True)


def performance(phases: DataFrame, runs: DataFrame, limits: Thresholds, n_features: int) -> DataFrame:
    """All performance figures per run. Both sides come hashed by run, so the join adds no shuffle."""
    keys = run_keys(phases)
    joined = phase_rollup(phases).join(runs.select(*keys, "rows_processed"), keys)
    return with_performance(joined, limits, n_features)


def with_performance(timed: DataFrame, limits: Thresholds, n_features: int) -> DataFrame:
    """Adds the performance figures to runs that have the seconds of their phases."""
    lights = {f"{p}_light": phase_light(p, limits) for p in PHASES}
    return (
        with_throughput(timed, F.col("rows_processed"), n_features)
        .withColumns({**lights, "slowest_phase": slowest_phase(), "light": total_light(limits)})
    )


# What a phase is recorded with: it ended, it raised, or it is a validation that ended and found errors.
OK_PHASE, RAISED_PHASE, FINDINGS = "ok", "error", "findings"


def raised() -> Column:
    """Of the phases of a run: did one raise, or was one never reached?"""
    failed = F.count_if(F.col("status") == RAISED_PHASE) > 0
    return failed | (F.count_if(F.col("phase").isin(*RAW_PHASES)) < len(RAW_PHASES))


def found_errors(phase: str) -> Column:
    """Of the phases of a run: the verdict of a validation, as far as the phases tell."""
    return F.when(F.count_if((F.col("phase") == phase) & (F.col("status") == FINDINGS)) > 0, ERROR)


def outcome() -> Column:
    """Of the phases of a run: error, warning or success, by the rule of :func:`pipeline_status`."""
    return pipeline_status(raised(), found_errors("validacion_estructural"), found_errors("validacion_semantica"))


def complete_phases(phases: DataFrame) -> DataFrame:
    """Per run: recorded phases, failed phases, outcome, and seconds with absent phases as 0.0.

    A run that stopped before its last phase is kept and counts as an error.
    """
    recorded = [
        F.count_if(F.col("phase").isin(*RAW_PHASES)).alias("n_recorded"),
        F.count_if(F.col("status") == RAISED_PHASE).alias("n_failed"),
        outcome().alias("outcome"),
    ]
    missing = F.lit(len(RAW_PHASES)) - F.col("n_recorded")
    return phases.groupBy(*run_keys(phases)).agg(*spent(), *recorded).withColumn("total_secs", total()).withColumns(
        {"n_absent": missing, "partial": missing > 0}
    )


def run_outcomes(phases: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Per run: did it raise, what validation says of it, and its status.

    ``phases`` and ``verdicts`` (structural, semantic) have a ``pipeline_id``. What a run's own
    validation found counts, and else the verdict on the tables of its pipeline.
    """
    own = {"structural": "validacion_estructural", "semantic": "validacion_semantica"}
    told = phases.groupBy(*run_keys(phases)).agg(raised().alias("raised"), *[found_errors(p).alias(f"own_{s}") for s, p in own.items()])
    joined = told.join(verdicts, "pipeline_id", "left")
    return joined.select(
        "pipeline_id", "run_id", "raised", *[F.coalesce(f"own_{s}", s).alias(s) for s in own]
    ).withColumn("status", pipeline_status(F.col("raised"), F.col("structural"), F.col("semantic")))
