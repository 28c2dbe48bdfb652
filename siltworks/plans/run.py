"""One whole run: file to published table, timed, recorded and scored even if it fails."""

from __future__ import annotations

import secrets
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from siltworks.config import RAW_PHASES, CostModel, PrepConfig, Thresholds
from siltworks.kpi import health, quality
from siltworks.kpi.performance import FINDINGS
from siltworks.operators import features as fe, validate as val
from siltworks.operators.clean import clean, fit_fences
from siltworks.operators.ingest import ingest
from siltworks.operators.publish import load_report, publish_projection
from siltworks.sources import delimited, files, runlog, sinks, versions

PHASES_SCHEMA = "pipeline_id bigint, run_id bigint, phase string, secs double, status string, ts timestamp"
RUNS_SCHEMA = (
    "run_id bigint, pipeline_id bigint, ts timestamp, status string, secs double, "
    "rows_processed bigint, input_bytes bigint, output_bytes bigint"
)
TABLES = ("raw", "clean", "features")
VALIDATIONS = {"structural": "validacion_estructural", "semantic": "validacion_semantica"}


@dataclass
class Run:
    """The paths of a run and what is known about it so far."""

    out: str
    run_id: int
    timings: dict[str, tuple[float, str]] = field(default_factory=dict)
    done: set[str] = field(default_factory=set)
    published: str | None = None
    status: str = "success"
    loaded: Row | None = None
    verdicts: dict[str, str] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.out}/{table}"

    @contextmanager
    def phase(self, name: str) -> Iterator[None]:
        started = time.perf_counter()
        try:
            yield
        except BaseException:
            self.timings[name] = (round(time.perf_counter() - started, 4), "error")
            raise
        self.timings[name] = (round(time.perf_counter() - started, 4), "ok")

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Every step reads what the step before has written, not how it was computed."""
        df.write.mode("overwrite").parquet(self.path(table))
        self.done.add(table)
        return df.sparkSession.read.schema(df.schema).parquet(self.path(table))


def run(
    spark: SparkSession,
    source: str,
    out: str,
    log: str,
    cfg: PrepConfig,
    limits: Thresholds = Thresholds(),
    model: CostModel = CostModel(),
    pipeline_id: int = 0,
    run_id: int | None = None,
    published: str | None = None,
    export: Sequence[str] = (),
) -> Run:
    """Read, clean, encode, validate and publish a delimited source.

    ``out`` receives the tables and the report of this run, ``log`` collects the phase
    times and outcomes of all runs, ``published`` is the version of the served table to
    update, ``export`` the formats ("parquet", "csv") in which features and targets are
    exported besides. The source needs the key columns of ``cfg``. An exception is raised
    again after the run has been recorded and scored.
    """
    # runs that start in the same millisecond differ in the random part
    own_id = time.time_ns() // 1_000_000 << 20 | secrets.randbits(20)
    this = Run(out, run_id if run_id is not None else own_id, published=published)
    checks: DataFrame | None = None
    try:
        with this.phase("ingesta"):
            files.require_source(spark, source)
            raw = this.write("raw", ingest(delimited.read_delimited(spark, source), cfg))
        with this.phase("limpieza"):
            tidy = this.write("clean", clean(raw, cfg, fit_fences(raw, cfg)))
        with this.phase("transformacion"):
            fitted = fe.fit(tidy, cfg)
            fe.save_fitted(spark, fitted, this.path("fitted"))
            encoded = this.write("features", fe.transform(tidy, cfg, fitted))
        with this.phase("validacion_estructural"):
            structural = this.write("structural_checks", val.structural_checks(raw, tidy, encoded, cfg))
        with this.phase("validacion_semantica"):
            semantic = this.write("semantic_checks", val.semantic_checks(tidy, encoded, cfg, limits))
            checks = structural.unionByName(semantic)
        with this.phase("carga"):
            served = publish_projection(tidy, cfg)
            this.published = versions.upsert(spark, published, served, cfg.key, this.path("published"))
            if "parquet" in export:
                sinks.export_parquet(encoded, tidy, this.path("export/parquet"))
            if "csv" in export:
                sinks.export_csv(encoded, cfg, this.path("export/csv"))
            this.loaded = load_report(encoded, _targets(tidy, cfg), cfg).first()
        this.verdicts = {r["scope"]: r["status"] for r in val.status_by_scope(checks).collect()}
        for scope, phase in VALIDATIONS.items():
            if this.verdicts.get(scope) == val.ERROR:
                this.timings[phase] = (this.timings[phase][0], FINDINGS)
                this.status = "warning"
    except BaseException as error:
        this.status = "error"
        try:
            _finish(spark, this, source, log, cfg, limits, model, pipeline_id, checks)
        except Exception as second:  # the first failure is the one to tell
            error.add_note(f"and the run could not be recorded or scored: {second!r}")
        raise
    _finish(spark, this, source, log, cfg, limits, model, pipeline_id, checks)
    return this


def _finish(spark, this: Run, source: str, log: str, cfg, limits, model, pipeline_id: int, checks: DataFrame | None) -> None:
    _record(spark, this, source, log, pipeline_id)
    _score(spark, this, source, log, cfg, limits, model, pipeline_id, checks)


def _targets(tidy: DataFrame, cfg: PrepConfig) -> DataFrame:
    """The targets by key, from the cleaned table."""
    return tidy.select(*cfg.key, fe.target(tidy, cfg).alias("y"))


def _record(spark: SparkSession, this: Run, source: str, log: str, pipeline_id: int) -> None:
    """Append the phases, those never reached with 0.0 seconds, and the run."""
    now = datetime.now(timezone.utc)
    phases = [(pipeline_id, this.run_id, p, *this.timings.get(p, (0.0, "error")), now) for p in RAW_PHASES]
    rows = spark.read.parquet(this.path("raw")).count() if "raw" in this.done else 0
    n_bytes = [files.dir_bytes(spark, path).first()["size_bytes"] for path in (source, this.out)]
    ended = (this.run_id, pipeline_id, now, this.status, sum(p[3] for p in phases), rows, *n_bytes)
    for name, records, schema in (("phase_metrics", phases, PHASES_SCHEMA), ("run_log", [ended], RUNS_SCHEMA)):
        runlog.append(spark.createDataFrame(records, schema), log, name)


def _score(
    spark: SparkSession,
    this: Run,
    source: str,
    log: str,
    cfg: PrepConfig,
    limits: Thresholds,
    model: CostModel,
    pipeline_id: int,
    checks: DataFrame | None,
) -> None:
    """Write the report of this run from what it has left behind."""
    tables = {t: spark.read.parquet(this.path(t)) if t in this.done else None for t in TABLES}
    encoded = tables["features"]
    n_features = len(fe.feature_names(encoded, cfg)) if encoded is not None else 0
    # only the folders of this pipeline are read
    own_runs, own_phases = (
        spark.read.schema(schema).parquet(f"{log}/{name}").filter(F.col("pipeline_id") == pipeline_id)
        for name, schema in (("run_log", RUNS_SCHEMA), ("phase_metrics", PHASES_SCHEMA))
    )
    figures = health.run_figures(own_phases, own_runs, limits, model, n_features)
    if any(t is not None for t in tables.values()):
        measured = quality.quality(*tables.values(), cfg, limits, details=True, targets_in_clean=encoded is not None).withColumn(
            "pipeline_id", F.lit(pipeline_id).cast("bigint")
        )
    else:
        measured = spark.createDataFrame(
            [], "pipeline_id bigint, quality_score int, light string, x_null_pct double, types_ok boolean, aligned boolean"
        )
    available = not files.list_files(spark, source).isEmpty()
    # a strict read that has ended has read every row
    readable = available and ("raw" in this.done or delimited.can_read(spark, source))
    scored = health.with_health(health.pipeline_figures(figures, measured, limits, available, readable), limits)
    own_checks = checks.withColumn("pipeline_id", F.lit(pipeline_id).cast("bigint")) if checks is not None else None
    size = files.dir_bytes(spark, source).first()["size_bytes"]
    made = health.report(
        health.with_checks(scored, own_checks), n_features, source, load=this.loaded, source_bytes=size, model=model
    )
    sinks.export_report(made, this.path("report"))
