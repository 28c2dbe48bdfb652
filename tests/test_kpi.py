from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from table_dirs import SF_GOLDEN, SF_SMALL
from siltworks.config import CostModel, Thresholds
from siltworks.functions.lights import light
from siltworks.kpi import availability as avail, cost, health, performance as perf, quality as qual
from siltworks.operators import validate as val
from siltworks.plans.prepare import prepare
from siltworks.plans.registry import contacts
from siltworks.sources import runs as rn

LIMITS, MODEL = Thresholds(), CostModel()


@pytest.mark.parametrize(
    "value, higher, lower",
    [(95.0, "verde", "rojo"), (90.0, "amarillo", "amarillo"), (94.9, "amarillo", "amarillo"), (89.9, "rojo", "verde"),
     (None, "rojo", "rojo"), (float("nan"), "rojo", "rojo")],
)
def test_lights_have_inclusive_limits(spark, value, higher, lower):
    df = spark.createDataFrame([(value,)], "v double")
    row = df.select(light(F.col("v"), 95.0, 90.0), light(F.col("v"), 89.9, 94.9, lower_is_better=True)).first()
    assert tuple(row) == (higher, lower)


def run_log(spark, rows):
    start = datetime(2024, 1, 1)
    full = [(i, p, start + timedelta(hours=i), s, 1.0, 10, 100, 100) for i, (p, s) in enumerate(rows)]
    return spark.createDataFrame(
        full, "run_id bigint, pipeline_id bigint, ts timestamp_ntz, status string, secs double, rows_processed bigint, input_bytes bigint, output_bytes bigint"
    )


def test_registry_counts_anything_else_as_an_error(spark):
    log = run_log(spark, [(1, "success"), (1, "warning"), (1, "crashed"), (1, None)])
    row = avail.availability_rates(log).first()
    assert tuple(row)[1:] == (4, 1, 1, 2, 25.0, 50.0)


def test_availability_lights(spark):
    log = run_log(spark, [(1, "success")] * 3 + [(2, "error")] + [(2, "success")] * 2 + [(3, "success"), (3, "error")])
    found = {r["pipeline_id"]: r["light"] for r in avail.availability(log, LIMITS).collect()}
    assert found == {1: "verde", 2: "amarillo", 3: "rojo"}
    gone = {r["light"] for r in avail.availability(log, LIMITS, readable=False).collect()}
    assert gone == {"rojo"}


def test_history_keeps_the_latest_runs(spark):
    log = run_log(spark, [(i % 2, "success") for i in range(300)])
    kept = avail.run_history(log, last=100)
    assert {r["pipeline_id"]: (r["n"], r["first"]) for r in kept.groupBy("pipeline_id").agg(F.count("*").alias("n"), F.min("run_id").alias("first")).collect()} == {0: (100, 100), 1: (100, 101)}


def phases(spark, rows):
    return spark.createDataFrame(rows, "run_id bigint, phase string, secs double, status string")


def test_rollup_fills_absent_phases(spark):
    df = phases(spark, [(1, "ingesta", 2.0, "ok"), (1, "validacion_estructural", 1.5, "ok"), (1, "validacion_semantica", 0.5, "error")])
    row = perf.phase_rollup(df).first().asDict()
    assert row == {"run_id": 1, "ingesta_secs": 2.0, "limpieza_secs": 0.0, "transformacion_secs": 0.0, "validacion_secs": 2.0, "carga_secs": 0.0, "total_secs": 4.0}
    # ingest and validation took equally long: the first in order wins
    assert perf.phase_rollup(df).select(perf.slowest_phase()).first()[0] == "ingesta"
    done = perf.complete_phases(df).first()
    assert (done["n_recorded"], done["n_absent"], done["partial"], done["outcome"]) == (3, 3, True, "error")


def test_no_time_gives_no_throughput(spark):
    df = phases(spark, [(1, "ingesta", 0.0, "ok")])
    row = perf.with_throughput(perf.phase_rollup(df), F.lit(10), 35).first()
    assert (row["rows_per_sec"], row["features_per_sec"]) == (0.0, 0.0)


def test_phase_lights(spark):
    df = phases(spark, [(1, "ingesta", 6.0, "ok"), (1, "carga", 5.0, "ok"), (1, "limpieza", 15.1, "ok")])
    rolled = perf.phase_rollup(df)
    row = rolled.select(*[perf.phase_light(p, LIMITS).alias(p) for p in ("ingesta", "carga", "limpieza")], perf.total_light(LIMITS).alias("total")).first()
    assert tuple(row) == ("verde", "amarillo", "rojo", "verde")


def test_cost(spark):
    gb = 1024**3
    log = run_log(spark, [(1, "success")]).withColumns({"secs": F.lit(3600.0), "input_bytes": F.lit(gb), "output_bytes": F.lit(2 * gb), "rows_processed": F.lit(10_000)})
    row = cost.with_unit_economics(cost.with_cost(log, MODEL, LIMITS), MODEL).first()
    assert (row["compute_usd"], row["io_usd"], row["storage_usd"], row["total_usd"]) == (0.10925, 0.01, 0.04, 0.15925)
    assert (row["light"], row["usd_per_1k_rows"], row["rows_per_cent"], row["efficiency_score"]) == ("rojo", 0.015925, 627.9, 6.3)


def test_free_or_empty_runs(spark):
    log = run_log(spark, [(1, "success")])
    free = log.withColumns({"secs": F.lit(0.0), "input_bytes": F.lit(0), "output_bytes": F.lit(0)})
    row = cost.with_unit_economics(cost.with_cost(free, MODEL, LIMITS), MODEL).first()
    assert (row["total_usd"], row["rows_per_cent"], row["efficiency_score"], row["light"]) == (0.0, 0.0, 0.0, "verde")
    empty = cost.with_unit_economics(cost.with_cost(log.withColumn("rows_processed", F.lit(0)), MODEL, LIMITS), MODEL).first()
    assert empty["usd_per_1k_rows"] == 0.0


@pytest.fixture(scope="module")
def golden(spark, cfg):
    return prepare(contacts(spark, SF_GOLDEN), cfg)


def test_golden_quality(golden, cfg):
    row = qual.quality(golden.raw, golden.clean, golden.features, cfg, LIMITS).first()
    assert (row["raw_null_pct"], row["clean_null_pct"], row["x_null_pct"]) == (0.2557, 0.1916, 0.1259)
    assert (row["valid_columns_pct"], row["quality_score"], row["light"]) == (91.43, 90, "verde")


def test_groups_add_up(golden, cfg):
    split = [df.withColumn("part", F.col("contact_id") % 3) for df in (golden.raw, golden.clean, golden.features)]
    rows = qual.quality(*split, cfg, LIMITS, ["part"]).collect()
    assert sorted(r["part"] for r in rows) == [0, 1, 2]
    assert sum(r["n_rows"] for r in rows) == 15_000


def test_unaligned_targets_cost_points(golden, cfg):
    targets = golden.features.select("contact_id", "y").filter("contact_id > 50")
    row = qual.quality(golden.raw, golden.clean, golden.features, cfg, LIMITS, targets=targets).first()
    assert not row["aligned"] and row["quality_score"] == 65


def test_keys_of_the_cleaned_table_are_compared_by_digests(golden, cfg):
    """Lost, repeated, exchanged and null keys differ; another order does not."""
    key = F.col("contact_id")
    with_null = golden.features.withColumn("contact_id", F.when(key != 7, key))
    changed = {
        "same": (golden.features.orderBy(key.desc()), True),
        "lost": (golden.features.filter("contact_id != 7"), False),
        "repeated": (golden.features.unionAll(golden.features.filter("contact_id = 7")), False),
        "exchanged": (golden.features.withColumn("contact_id", F.when(key == 7, 8).otherwise(key)), False),
        "null": (with_null, False),
    }
    for name, (features, aligned) in changed.items():
        row = qual.quality(None, golden.clean, features, cfg, LIMITS, targets_in_clean=True).first()
        assert row["aligned"] == aligned, name
    assert qual.quality(None, golden.clean.withColumn("contact_id", F.when(key != 7, key)), with_null, cfg, LIMITS, targets_in_clean=True).first()["aligned"]


def test_a_group_that_one_table_lacks_is_not_aligned(golden, cfg):
    raw, clean, features = (df.withColumn("part", F.col("contact_id") % 3) for df in (golden.raw, golden.clean, golden.features))
    rows = qual.quality(raw, clean, features.filter("part != 1"), cfg, LIMITS, ["part"], targets_in_clean=True).collect()
    assert {r["part"]: r["aligned"] for r in rows} == {0: True, 1: False, 2: True}
    empty = [df.filter("1 = 0") for df in (golden.raw, golden.clean, golden.features)]
    assert qual.quality(*empty, cfg, LIMITS, targets_in_clean=True).first()["aligned"]


@pytest.mark.parametrize("by", [[], ["part"]])
def test_checks_from_facts_equal_checks_of_tables(golden, cfg, by):
    raw, clean, features = (df.withColumn("part", F.col("contact_id") % 3) for df in (golden.raw, golden.clean, golden.features))
    features = features.filter("part != 1 OR contact_id > 40").filter("part != 2")  # a group without features
    facts = qual.table_facts(raw, clean, features, cfg, by, checked=LIMITS)
    named = [*by, "scope", "check_name", "column_name", "value", "detail", "severity", "ok"]
    ours = qual.checks_of(facts, clean, features, cfg, by).select(*named)
    theirs = val.structural_checks(raw, clean, features, cfg, by).unionByName(val.semantic_checks(clean, features, cfg, LIMITS, by)).select(*named)
    assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))


def test_wide_features_are_scored_in_chunks(spark, cfg):
    wide = spark.range(12).selectExpr("id AS contact_id", "CAST(id % 2 AS INT) AS y", *[f"CAST(id * {k} AS DOUBLE) AS c{k}" for k in range(450)])
    row = qual.quality(None, None, wide, cfg, LIMITS, targets=wide.select("contact_id", "y")).first()
    assert (row["n_rows"], row["aligned"], row["valid_columns_pct"]) == (12, True, round(449 / 450 * 100, 2))


def test_figures_of_runs_that_carry_their_phases(spark):
    """One aggregation of the phases gives what a join of runs and phases gives."""
    metrics = rn.phase_metrics(spark, SF_SMALL)
    joined = health.run_figures(metrics, rn.run_log(metrics), LIMITS, MODEL, 35)
    carried = health.run_figures(None, rn.run_log(metrics, timed=True), LIMITS, MODEL, 35).select(*joined.columns)
    assert joined.count() and joined.exceptAll(carried).isEmpty() and carried.exceptAll(joined).isEmpty()


def test_text_features_cost_points(golden, cfg):
    with_text = golden.features.withColumn("note", F.lit("x"))
    row = qual.quality(golden.raw, golden.clean, with_text, cfg, LIMITS).first()
    assert not row["types_ok"] and row["quality_score"] == 65


def test_absent_tables_score_like_empty_ones(golden, cfg):
    assert LIMITS.score_without_data == 45
    assert qual.quality(golden.raw, None, None, cfg, LIMITS).first()["quality_score"] == 45
    empty = [df.filter("1 = 0") for df in (golden.raw, golden.clean, golden.features)]
    row = qual.quality(*empty, cfg, LIMITS).first()
    assert (row["x_null_pct"], row["null_light"], row["class_light"]) == (None, "rojo", "rojo")


def test_single_class(spark):
    df = spark.range(4).selectExpr("1 AS y")
    row = qual.class_balance(df, LIMITS).first()
    assert (row["class_1_pct"], row["class_0_pct"], row["imbalance_ratio"], row["light"], row["penalty"]) == (100.0, 0.0, 1.0, "verde", 0)


def test_aborted_run_is_scored(spark):
    """The last run of the golden events stops after four phases."""
    done = perf.complete_phases(rn.phase_metrics(spark, SF_GOLDEN)).filter("partial").collect()
    assert [(r["n_recorded"], r["outcome"]) for r in done] == [(4, "error")]
    assert done[0]["carga_secs"] == 0.0


def test_golden_run_outcomes(spark):
    log = rn.run_log(rn.phase_metrics(spark, SF_GOLDEN))
    assert {r["status"]: r["count"] for r in log.groupBy("status").count().collect()} == {"success": 417, "warning": 253, "error": 997}
    assert [r["status"] for r in log.filter("run_id = 1666").collect()] == ["error"]


def test_lost_rows_cost_points_and_raise_a_load_error(spark, golden, cfg):
    batch = [df.withColumn("pipeline_id", F.lit(0).cast("bigint")) for df in (golden.raw, golden.clean, golden.features.filter("contact_id > 50"))]
    targets = golden.clean.selectExpr("contact_id", "CAST(deposit AS INT) AS y", "0L AS pipeline_id")
    whole = qual.quality(*batch, cfg, LIMITS, ["pipeline_id"], targets)
    metrics = rn.phase_metrics(spark, SF_SMALL)
    figures = health.run_figures(metrics, rn.run_log(metrics), LIMITS, MODEL, 35)
    scored = health.pipeline_figures(figures, whole, LIMITS)
    assert not whole.first()["aligned"] and whole.first()["quality_score"] == 65
    assert "load_error" in {r["alert"] for r in health.pipeline_alerts(scored).filter("pipeline_id = 0").collect()}


def test_a_structural_finding_in_many_columns_is_one_alert(spark):
    checks = spark.createDataFrame(
        [("structural", "empty_column", c, 0.0, "", "ERROR", False) for c in "abc"],
        "scope string, check_name string, column_name string, value double, detail string, severity string, ok boolean",
    )
    assert [(r["alert"], r["value"]) for r in health.check_alerts(checks).collect()] == [("structural:empty_column", 3.0)]


def test_health_of_missing_quality(spark):
    metrics = rn.phase_metrics(spark, SF_SMALL)
    figures = health.run_figures(metrics, rn.run_log(metrics), LIMITS, MODEL, 35)
    none = spark.createDataFrame([], "pipeline_id bigint, quality_score int, light string, x_null_pct double, types_ok boolean, aligned boolean")
    scored = health.with_health(health.pipeline_figures(figures, none, LIMITS, available=False), LIMITS)
    row = scored.orderBy("pipeline_id").first()
    assert (row["quality_score"], row["availability_score"], row["quality_light"]) == (45, 0, "rojo")
    raised = {r["alert"] for r in health.pipeline_alerts(scored).filter("pipeline_id = 0").collect()}
    assert {"source_missing", "availability_red", "quality_red"} <= raised


def test_semantic_errors_raise_no_alert(spark):
    checks = spark.createDataFrame(
        [("semantic", "sentinel_flag", "pdays", 1.0, "", "ERROR", False), ("semantic", "cyclic_identity", "day", 2.0, "", "WARNING", False),
         ("structural", "null_cells", None, 3.0, "", "ERROR", False), ("structural", "zero_variance", "a", 0.0, "", "INFO", False)],
        "scope string, check_name string, column_name string, value double, detail string, severity string, ok boolean",
    )
    assert sorted(r["alert"] for r in health.check_alerts(checks).collect()) == ["semantic:cyclic_identity:day", "structural:null_cells"]
