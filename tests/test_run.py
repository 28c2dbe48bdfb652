import json

import pytest
from pyspark.errors import PySparkException

from table_dirs import SF_SMALL
from siltworks.plans.run import run
from siltworks.sources import versions
from siltworks.sources.contacts import contacts_raw


def report_of(path):
    lines = [line for f in path.glob("report/*.json") for line in f.read_text().splitlines()]
    return json.loads(lines[0])


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source") / "contacts")
    contacts_raw(spark, SF_SMALL).write.options(sep=";", header=True, ignoreLeadingWhiteSpace=False).csv(path)
    return path


def test_whole_runs(spark, cfg, source, tmp_path):
    log = str(tmp_path / "log")
    # the key arrives as text and stays text
    first = run(spark, source, str(tmp_path / "1"), log, cfg, run_id=1)
    assert first.status == "warning"  # some features are missing
    second = run(spark, source, str(tmp_path / "2"), log, cfg, run_id=2, published=first.published)
    assert versions.read_version(spark, second.published).count() == 1500
    assert spark.read.parquet(f"{log}/phase_metrics").count() == 12
    report = report_of(tmp_path / "2")
    assert report["availability"]["n_runs"] == 2 and report["availability"]["n_warning"] == 2
    assert report["summary"]["n_features"] == 35 and report["summary"]["rows_processed"] == 1500
    assert report["quality"]["score"] == 83  # as the SQL of kpi_quality_score gives at this scale
    assert {a["alert"] for a in report["summary"]["alerts"]} >= {"nulls_in_features", "structural:null_cells"}
    assert report["performance"]["total_secs"] > 0 and report["cost"]["total_usd"] > 0


def test_missing_source_is_recorded_and_raised(spark, cfg, tmp_path):
    log = str(tmp_path / "log")
    with pytest.raises(FileNotFoundError):
        run(spark, str(tmp_path / "absent"), str(tmp_path / "out"), log, cfg, run_id=1)
    phases = {r["phase"]: (r["secs"], r["status"]) for r in spark.read.parquet(f"{log}/phase_metrics").collect()}
    assert len(phases) == 6 and phases["ingesta"][1] == "error" and phases["carga"] == (0.0, "error")
    report = report_of(tmp_path / "out")
    assert report["availability"]["n_error"] == 1 and not report["availability"]["available"]
    assert report["quality"]["score"] == 45
    assert "source_missing" in {a["alert"] for a in report["summary"]["alerts"]}


def test_failure_halfway_keeps_what_is_there(spark, cfg, source, tmp_path):
    untargeted = str(tmp_path / "untargeted")
    spark.read.options(sep=";", header=True).csv(source).drop("deposit").write.options(header=True, sep="|").csv(untargeted)
    log = str(tmp_path / "log")
    with pytest.raises(ValueError, match="deposit"):
        run(spark, untargeted, str(tmp_path / "out"), log, cfg, run_id=1)
    phases = {r["phase"]: r["status"] for r in spark.read.parquet(f"{log}/phase_metrics").collect()}
    assert [phases[p] for p in ("ingesta", "limpieza", "transformacion", "carga")] == ["ok", "ok", "error", "error"]
    report = report_of(tmp_path / "out")
    assert report["summary"]["rows_processed"] == 1500 and report["summary"]["n_features"] == 0
    assert report["quality"]["score"] == 45


def test_pipelines_with_the_same_run_number_score_apart(spark, cfg, source, tmp_path):
    log = str(tmp_path / "log")
    run(spark, source, str(tmp_path / "1"), log, cfg, run_id=1, pipeline_id=1)
    run(spark, source, str(tmp_path / "2"), log, cfg, run_id=1, pipeline_id=2, export=("parquet", "csv"))
    for p in (1, 2):
        report = report_of(tmp_path / str(p))
        spent = sum(r["secs"] for r in spark.read.parquet(f"{log}/phase_metrics").filter(f"pipeline_id = {p}").collect())
        assert report["availability"]["n_runs"] == 1 and abs(report["performance"]["total_secs"] - spent) < 0.01
        assert report["load"]["status"] == "OK" and report["load"]["n_rows_target"] == 1500
        assert report["quality"]["structural_status"] == "ERROR" and report["quality"]["invalid_columns"]
        assert report["availability"]["source_bytes"] > 0
    assert spark.read.parquet(str(tmp_path / "2" / "export" / "parquet" / "features")).count() == 1500


def test_damaged_source_is_reported(spark, cfg, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv.gz").write_bytes(b"no gzip at all")
    with pytest.raises(Exception):
        run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log"), cfg, run_id=1)
    report = report_of(tmp_path / "out")
    assert report["availability"]["available"] and not report["availability"]["readable"]
    assert report["load"]["status"] == "N/A" and report["summary"]["status"] == "error"


def test_long_row_fails_the_run(spark, cfg, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("contact_id,age,deposit\n1,2,yes\n2,3,no,4\n")
    with pytest.raises(PySparkException, match="too many fields"):
        run(spark, str(bad), str(tmp_path / "out"), str(tmp_path / "log"), cfg, run_id=1)
    report = report_of(tmp_path / "out")
    assert report["availability"]["available"] and not report["availability"]["readable"]


def test_a_failure_to_record_does_not_hide_the_first_one(spark, cfg, tmp_path, monkeypatch):
    from siltworks.plans import run as module

    def broken(*args):
        raise RuntimeError("no log")

    monkeypatch.setattr(module, "_record", broken)
    with pytest.raises(FileNotFoundError) as caught:
        run(spark, str(tmp_path / "absent"), str(tmp_path / "out"), str(tmp_path / "log"), cfg, run_id=1)
    assert any("no log" in n for n in caught.value.__notes__)


def test_findings_of_validations_are_recorded(spark, cfg, source, tmp_path):
    log = str(tmp_path / "log")
    made = run(spark, source, str(tmp_path / "1"), log, cfg, run_id=1)
    phases = {r["phase"]: r["status"] for r in spark.read.parquet(f"{log}/phase_metrics").collect()}
    assert made.status == "warning" and phases["validacion_estructural"] == "findings"
    assert {s for p, s in phases.items() if not p.startswith("validacion_e")} == {"ok"}
