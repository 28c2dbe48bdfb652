"""Health: the four indicators of every pipeline weighed into one score, with alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from siltworks.config import PHASES, RED, REPORT_VERSION, CostModel, Thresholds
from siltworks.functions.lights import light_points, score_light
from siltworks.kpi.availability import availability_light, registry_aggregates, with_rates
from siltworks.kpi.cost import with_cost, with_unit_economics
from siltworks.kpi.performance import phase_rollup, run_keys, secs, with_performance
from siltworks.operators.validate import ERROR, WARNING, verdicts

LAST_RUN = (
    "run_id",
    "ts",
    "status",
    "rows_processed",
    "input_bytes",
    "output_bytes",
    "total_secs",
    *[secs(p) for p in PHASES],
    *[f"{p}_light" for p in PHASES],
    "slowest_phase",
    "rows_per_sec",
    "features_per_sec",
    "performance_light",
    "compute_usd",
    "io_usd",
    "storage_usd",
    "total_usd",
    "usd_per_1k_rows",
    "rows_per_cent",
    "efficiency_score",
    "cost_light",
)


# of the quality figures, what the score and the alerts read; the report shows the others too
COUNTED = ("n_rows", "n_class")
QUALITY_FACTS = ("pipeline_id", "quality_score", "light", "x_null_pct", "types_ok", "aligned")


def run_figures(
    phases: DataFrame | None, runs: DataFrame, limits: Thresholds, model: CostModel, n_features: int
) -> DataFrame:
    """Performance and cost of every run that has phases.

    Without ``phases`` the runs bring the seconds of their phases along (``performance.spent``).
    """
    timed = runs if phases is None else runs.join(phase_rollup(phases), run_keys(phases))
    judged = with_performance(timed, limits, n_features).withColumnRenamed("light", "performance_light")
    return with_unit_economics(with_cost(judged, model, limits), model).withColumnRenamed("light", "cost_light")


def pipeline_figures(
    figures: DataFrame, quality: DataFrame, limits: Thresholds, available: Column | bool = True, readable: Column | bool = True
) -> DataFrame:
    """One row per pipeline: its registry, its latest run and the quality of its data.

    A pipeline without quality figures scores as one whose tables are empty.
    """
    available = available if isinstance(available, Column) else F.lit(available)
    readable = readable if isinstance(readable, Column) else F.lit(readable)
    counted = figures.groupBy("pipeline_id").agg(
        *registry_aggregates(), F.max_by(F.struct(*LAST_RUN), F.struct("ts", "run_id")).alias("last")
    )
    measured = quality.select(
        "pipeline_id",
        F.col("quality_score"),
        F.col("light").alias("quality_light"),
        "x_null_pct",
        "types_ok",
        "aligned",
        F.struct(*[c for c in quality.columns if c not in QUALITY_FACTS]).alias("quality_details")
        if set(quality.columns) - set(QUALITY_FACTS)
        else F.lit(None).alias("quality_details"),
    )
    known = with_rates(counted).select(
        "*", available.alias("source_available"), readable.alias("source_readable")
    )
    return (
        known.join(measured, "pipeline_id", "left")
        .withColumn("quality_score", F.coalesce("quality_score", F.lit(limits.score_without_data)))
        .withColumn("quality_light", F.coalesce("quality_light", score_light(F.col("quality_score"), limits)))
        .withColumn(
            "availability_light",
            availability_light(
                F.col("source_available"), F.col("source_readable"), F.col("last.status"), F.col("success_pct"), limits
            ),
        )
    )


def with_health(figures: DataFrame, limits: Thresholds) -> DataFrame:
    """Adds the four scores, the weighted health score and its light."""
    weights = limits.weights
    scores = {
        "availability_score": light_points(F.col("availability_light"), limits),
        "performance_score": light_points(F.col("last.performance_light"), limits),
        "cost_score": light_points(F.col("last.cost_light"), limits),
    }
    weighted = (
        F.col("availability_score") * weights["availability"]
        + F.col("performance_score") * weights["performance"]
        + F.col("quality_score") * weights["quality"]
        + F.col("cost_score") * weights["cost"]
    )
    return (
        figures.withColumns(scores)
        .withColumn("health_score", F.round(weighted, 1))
        .withColumn("health_light", score_light(F.col("health_score"), limits))
    )


def _raised_alerts() -> Column:
    """The alerts of one pipeline row; rules that do not apply leave nothing."""

    def rule(condition: Column, name: str, level: str, value: Column) -> Column:
        return F.when(
            F.coalesce(condition, F.lit(False)),
            F.struct(F.lit(name).alias("alert"), F.lit(level).alias("level"), value.cast("double").alias("value")),
        )

    last = F.col("last")
    return F.array_compact(
        F.array(
            rule(~F.col("source_available"), "source_missing", "critical", F.lit(None)),
            rule(F.col("availability_light") == RED, "availability_red", "red", F.col("success_pct")),
            rule(last["performance_light"] == RED, "performance_red", "red", last["total_secs"]),
            rule(F.col("quality_light") == RED, "quality_red", "red", F.col("quality_score")),
            rule(F.col("x_null_pct") > 0, "nulls_in_features", "red", F.col("x_null_pct")),
            rule(~F.col("types_ok"), "non_numeric_features", "red", F.lit(None)),
            rule(last["cost_light"] == RED, "cost_red", "red", last["total_usd"]),
            rule(~F.col("aligned"), "load_error", "critical", F.lit(None)),
        )
    )


def pipeline_alerts(figures: DataFrame) -> DataFrame:
    return figures.select("pipeline_id", F.inline(_raised_alerts()))


def check_alerts(checks: DataFrame) -> DataFrame:
    """Failed semantic warnings and structural errors; semantic errors only change the run status.

    A structural check that fails for several columns is one finding; its value is then
    the number of columns. Checks of whole tables belong to no pipeline.
    """
    pipeline = (F.col("pipeline_id") if "pipeline_id" in checks.columns else F.lit(None).cast("bigint")).alias("pipeline_id")
    semantic = (F.col("scope") == "semantic") & (F.col("severity") == WARNING)
    structural = (F.col("scope") == "structural") & (F.col("severity") == ERROR)
    column = F.when(semantic, F.col("column_name"))
    own_value = F.when(semantic | F.col("column_name").isNull(), F.col("value"))
    return (
        checks.filter(~F.col("ok") & (semantic | structural))
        .groupBy(
            pipeline,
            F.concat_ws(":", F.when(semantic, "semantic").otherwise("structural"), "check_name", column).alias("alert"),
            F.when(semantic, "warning").otherwise("critical").alias("level"),
        )
        .agg(F.coalesce(F.max(own_value), F.count("column_name").cast("double")).alias("value"))
        .select("pipeline_id", "alert", "level", "value")
    )


def alerts(figures: DataFrame, checks: DataFrame) -> DataFrame:
    """Alerts of all pipelines and those that the checks of their tables raise."""
    return pipeline_alerts(figures).unionByName(check_alerts(checks))


_ALERTS = "array<struct<alert: string, level: string, value: double>>"


def with_checks(scored: DataFrame, checks: DataFrame | None) -> DataFrame:
    """Adds what the checks of each pipeline's tables say: their alerts, a few at most for a column, and both verdicts.

    Without checks, as when a run has failed before, there are no alerts and no verdicts.
    """
    if checks is None:
        none = {"checked_alerts": F.expr(f"CAST(array() AS {_ALERTS})"), "structural": F.lit(None), "semantic": F.lit(None)}
        with_none = scored.withColumns(none)
        return with_none.withColumns({c: F.col(c).cast("string") for c in ("structural", "semantic")})
    raised = check_alerts(checks).groupBy("pipeline_id").agg(
        F.array_sort(F.collect_list(F.struct("alert", "level", "value"))).alias("checked_alerts")
    )
    joined = scored.join(raised, "pipeline_id", "left").join(verdicts(checks, ["pipeline_id"]), "pipeline_id", "left")
    return joined.withColumn("checked_alerts", F.coalesce("checked_alerts", F.expr(f"CAST(array() AS {_ALERTS})")))


def _all_alerts() -> Column:
    """The alerts of the pipeline and those that the checks of its tables have raised."""
    return F.concat(_raised_alerts(), F.col("checked_alerts"))


def summary(scored: DataFrame, n_features: int) -> DataFrame:
    """One line per pipeline (see :func:`with_checks`): score, light, parts, alerts, outcome and size of the latest run."""
    return scored.select(
        "pipeline_id",
        "health_score",
        "health_light",
        "availability_score",
        "performance_score",
        "quality_score",
        "cost_score",
        F.size(_all_alerts()).alias("n_alerts"),
        F.col("last.status").alias("status"),
        F.col("last.rows_processed").alias("rows_processed"),
        F.lit(n_features).alias("n_features"),
    )


def report(
    scored: DataFrame,
    n_features: int,
    source: str,
    version: str = REPORT_VERSION,
    load: Row | None = None,
    source_bytes: int | None = None,
    model: CostModel = CostModel(),
) -> DataFrame:
    """The consolidated report: one nested record per pipeline.

    ``scored`` comes from :func:`with_checks`; ``load`` is the row of a load report, where the run
    got that far.
    """
    last = F.col("last")

    def part(**columns: Column | str) -> Column:
        return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])

    details = scored.schema["quality_details"].dataType
    names = details.names if isinstance(details, T.StructType) else []
    loaded = load.asDict() if load is not None else {"status": "N/A"}
    return scored.select(
        "pipeline_id",
        part(
            timestamp=F.current_timestamp(),
            version=F.lit(version),
            run_id=last["run_id"],
            source=F.lit(source),
        ).alias("metadata"),
        part(
            available="source_available",
            readable="source_readable",
            source=F.lit(source),
            source_bytes=F.lit(source_bytes).cast("bigint"),
            status=last["status"],
            n_runs="n_runs",
            n_success="n_success",
            n_warning="n_warning",
            n_error="n_error",
            success_pct="success_pct",
            availability_pct="availability_pct",
            light="availability_light",
        ).alias("availability"),
        part(
            total_secs=last["total_secs"],
            **{secs(p): last[secs(p)] for p in PHASES},
            **{f"{p}_light": last[f"{p}_light"] for p in PHASES},
            slowest_phase=last["slowest_phase"],
            rows_per_sec=last["rows_per_sec"],
            features_per_sec=last["features_per_sec"],
            light=last["performance_light"],
        ).alias("performance"),
        part(
            score="quality_score",
            x_null_pct="x_null_pct",
            types_ok="types_ok",
            aligned="aligned",
            light="quality_light",
            structural_status=F.coalesce("structural", F.lit("N/A")),
            semantic_status=F.coalesce("semantic", F.lit("N/A")),
            **{n: F.col("quality_details")[n] for n in names},
        ).alias("quality"),
        part(
            compute_usd=last["compute_usd"],
            io_usd=last["io_usd"],
            storage_usd=last["storage_usd"],
            total_usd=last["total_usd"],
            usd_per_1k_rows=last["usd_per_1k_rows"],
            rows_per_cent=last["rows_per_cent"],
            efficiency_score=last["efficiency_score"],
            rows_processed=last["rows_processed"],
            n_features=F.lit(n_features),
            input_bytes=last["input_bytes"],
            output_bytes=last["output_bytes"],
            compute_usd_per_hour=F.lit(model.compute_usd_per_hour),
            io_usd_per_gb=F.lit(model.io_usd_per_gb),
            storage_usd_per_gb_month=F.lit(model.storage_usd_per_gb_month),
            overhead_factor=F.lit(model.overhead_factor),
            light=last["cost_light"],
        ).alias("cost"),
        part(**{n: F.lit(v).cast("bigint") if n.startswith(COUNTED) else F.lit(v) for n, v in loaded.items()}).alias("load"),
        part(
            health_score="health_score",
            light="health_light",
            alerts=_all_alerts(),
            n_alerts=F.size(_all_alerts()),
            status=last["status"],
            rows_processed=last["rows_processed"],
            n_features=F.lit(n_features),
        ).alias("summary"),
    )
