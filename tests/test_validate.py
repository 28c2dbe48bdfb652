from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from table_dirs import SF_GOLDEN
from siltworks.config import Thresholds
from siltworks.operators import validate as val
from siltworks.operators.profile import column_profile
from siltworks.plans.prepare import prepare
from siltworks.plans.registry import contacts


@pytest.fixture(scope="module")
def prepared(spark, cfg):
    return prepare(contacts(spark, SF_GOLDEN), cfg)


@pytest.fixture(scope="module")
def checks(prepared, cfg):
    structural = val.structural_checks(prepared.raw, prepared.clean, prepared.features, cfg)
    return structural.unionByName(val.semantic_checks(prepared.clean, prepared.features, cfg, Thresholds()))


def named(checks, name):
    return {r["column_name"]: r for r in checks.filter(F.col("check_name") == name).collect()}


def test_golden_figures(checks):
    """Figures worked out by hand from the derived contact table."""
    rows = checks.collect()
    value = {(r["check_name"], r["column_name"]): r["value"] for r in rows}
    assert value["null_pct", None] == 0.1259
    assert value["double_debt_pct", None] == 8.23
    assert value["minority_class_pct", "deposit"] == 32.89
    assert value["sentinel_flag", "pdays"] == 1500
    assert value["row_counts", None] == 15_000
    failed = {(r["check_name"], r["severity"]) for r in rows if not r["ok"]}
    assert failed == {("null_cells", "ERROR"), ("null_pct", "INFO")}
    status = {r["scope"]: r["status"] for r in val.status_by_scope(checks).collect()}
    assert status == {"structural": "ERROR", "semantic": "OK"}


def test_golden_fences(prepared):
    fences = prepared.fitted.fences
    assert (fences["balance"].q1, fences["balance"].median, fences["balance"].q3) == (1695.31, 4296.41, 7366.0)
    assert (fences["campaign"].lower, fences["campaign"].upper) == (0, 8)
    assert (fences["previous"].lower, fences["previous"].upper) == (-5.5, 14.5)
    assert (fences["pdays"].lower, fences["pdays"].upper) == (-288, 648)
    sums = prepared.clean.agg(*[F.sum(f).alias(c) for c, f in {"balance": "flag_outlier_balance", "campaign": "flag_outlier_campaign", "previous": "flag_outlier_previous", "pdays": "flag_outlier_pdays", "negative": "flag_balance_negativo"}.items()]).first()
    assert tuple(sums) == (71, 300, 162, 640, 1231)
    age = prepared.fitted.standard["age"]
    assert (round(age.center, 6), round(age.scale, 6)) == (53.308273, 20.988217)


def test_lost_rows_are_an_error(prepared, cfg):
    fewer = prepared.features.filter("contact_id > 100")
    row = named(val.structural_checks(prepared.raw, prepared.clean, fewer, cfg), "row_counts")[None]
    assert not row["ok"] and row["severity"] == "ERROR" and row["detail"].startswith("raw=15000 clean=15000 features=")


def test_constant_columns(spark):
    df = spark.range(5).selectExpr(
        "id", "0.1D AS same", "CASE WHEN id = 1 THEN 3D END AS single", "CAST(NULL AS DOUBLE) AS none", "CAST(id AS DOUBLE) AS varied", "'x' AS text"
    )
    entries = column_profile(df, ["same", "single", "none", "varied", "text"]).select(F.inline("profile")).collect()
    assert {r["column_name"] for r in entries if r["is_constant"]} == {"same"}
    assert {r["column_name"] for r in entries if not r["is_numeric"]} == {"text"}


def test_empty_tables_do_not_fail(prepared, cfg):
    none = "1 = 0"
    tables = [df.filter(none) for df in (prepared.raw, prepared.clean, prepared.features)]
    checks = val.structural_checks(*tables, cfg).unionByName(val.semantic_checks(tables[1], tables[2], cfg, Thresholds()))
    rows = {(r["check_name"], r["column_name"]): r for r in checks.collect()}
    assert rows["row_counts", None]["ok"] and rows["null_pct", None]["value"] is None
    assert not rows["minority_class_pct", "deposit"]["ok"]
    assert not rows["empty_column", "age"]["ok"]


def test_broken_sentinel_and_circle(prepared, cfg):
    clean = prepared.clean.withColumn("pdays_flag_nuevo_cliente", F.lit(1))
    features = prepared.features.withColumn("day_cos", F.when(F.col("contact_id") < 100, 0.0).otherwise(F.col("day_cos")))
    checks = val.semantic_checks(clean, features, cfg, Thresholds())
    assert not named(checks, "sentinel_flag")["pdays"]["ok"]
    assert named(checks, "sentinel_flag")["pdays"]["detail"] == "values=1500 flags=15000"
    circles = named(checks, "cyclic_identity")
    assert not circles["day"]["ok"] and circles["month"]["ok"]
    assert {r["status"] for r in val.status_by_scope(checks).collect()} == {"ERROR"}


def test_small_minority_is_a_warning(prepared, cfg):
    checks = val.semantic_checks(prepared.clean, prepared.features, cfg, replace(Thresholds(), min_minority_pct=40.0))
    assert val.status_by_scope(checks).first()["status"] == "WARNING"


def test_single_class_is_no_minority(spark, cfg):
    df = spark.range(3).selectExpr("1.0D AS deposit", "0D AS day_sin", "1D AS day_cos")
    row = named(val.semantic_checks(df, df, cfg, Thresholds()), "minority_class_pct")["deposit"]
    assert row["value"] == 100.0 and row["ok"]


def test_flags_present(prepared, cfg):
    found = {r["column_name"]: r for r in val.flag_checks(prepared.clean.drop("flag_outlier_pdays"), cfg).collect()}
    assert not found["flag_outlier_pdays"]["ok"] and found["flag_outlier_balance"]["n_marked"] == 71


@pytest.mark.parametrize(
    "raised, structural, semantic, status",
    [(True, "OK", "OK", "error"), (False, "ERROR", "OK", "warning"), (False, "OK", "ERROR", "warning"),
     (False, "OK", "WARNING", "success"), (None, "OK", "OK", "success")],
)
def test_pipeline_status(spark, raised, structural, semantic, status):
    df = spark.createDataFrame([(raised, structural, semantic)], "r boolean, st string, se string")
    assert df.select(val.pipeline_status(F.col("r"), F.col("st"), F.col("se"))).first()[0] == status


def test_wide_tables_are_profiled_in_chunks(spark, cfg):
    wide = spark.range(30).selectExpr("id AS contact_id", *[f"CAST(CASE WHEN id % 7 != {k % 7} THEN id * {k} END AS DOUBLE) AS c{k}" for k in range(2000)])
    names = [f"c{k}" for k in range(2000)]
    row = column_profile(wide, names).first()
    assert row["n_rows"] == 30 and [p["column_name"] for p in row["profile"]] == names
    assert [p["column_name"] for p in row["profile"] if p["is_constant"]] == ["c0"]
    assert sum(p["n_null"] for p in row["profile"]) == sum(30 - sum(i % 7 != k % 7 for i in range(30)) for k in range(2000))
    by = column_profile(wide.withColumn("g", F.col("contact_id") % 2), names[:450], ["g"], each=100).collect()
    assert sorted((r["g"], r["n_rows"], len(r["profile"])) for r in by) == [(0, 15, 450), (1, 15, 450)]


def test_checks_of_each_pipeline(prepared, cfg):
    """Groups differ: one has lost rows, one has a constant class, the others are as they were."""
    raw, clean, features = (df.withColumn("p", F.col("contact_id") % 3) for df in (prepared.raw, prepared.clean, prepared.features))
    features = features.filter("NOT (p = 1 AND contact_id < 200)")
    clean = clean.withColumn("deposit", F.when(F.col("p") == 2, F.lit(1.0)).otherwise(F.col("deposit")))
    checks = val.structural_checks(raw, clean, features, cfg, ["p"]).unionByName(val.semantic_checks(clean, features, cfg, Thresholds(), ["p"]))
    rows = {(r["p"], r["check_name"]): r for r in checks.filter("column_name IS NULL OR check_name = 'minority_class_pct'").collect()}
    assert [rows[p, "row_counts"]["ok"] for p in range(3)] == [True, False, True]
    assert sum(rows[p, "row_counts"]["value"] for p in range(3)) == features.count()
    assert [rows[p, "minority_class_pct"]["ok"] for p in range(3)] == [True, True, True]
    assert rows[2, "minority_class_pct"]["value"] == 100
    whole = val.structural_checks(raw.drop("p"), clean.drop("p"), features.drop("p"), cfg)
    cells = {r["check_name"]: r["value"] for r in whole.filter("check_name = 'null_cells'").collect()}
    assert sum(rows[p, "null_cells"]["value"] for p in range(3)) == cells["null_cells"]
    assert {r["p"] for r in val.verdicts(checks, ["p"]).collect()} == {0, 1, 2}


def test_a_group_without_rows_in_one_table_is_an_error(prepared, cfg):
    raw, clean, features = (df.withColumn("p", F.col("contact_id") % 2) for df in (prepared.raw, prepared.clean, prepared.features))
    found = val.structural_checks(raw, clean, features.filter("p = 0"), cfg, ["p"]).filter("check_name = 'row_counts'").collect()
    assert {r["p"]: r["ok"] for r in found} == {0: True, 1: False}
