"""The run log stays in few files and says the same."""

from datetime import datetime, timedelta, timezone

from siltworks.config import Thresholds
from siltworks.kpi import availability as avail
from siltworks.plans.run import RUNS_SCHEMA
from siltworks.sources import runlog


def test_many_runs_leave_few_files(spark, tmp_path):
    log, begun, rows = str(tmp_path / "log"), datetime(2024, 1, 1, tzinfo=timezone.utc), []
    for k in range(24):
        row = (k, 7 if k % 3 else 8, begun + timedelta(hours=k), ("success", "warning", "error")[k % 4 % 3], 1.5 * k, 10 * k, 5, 6)
        rows.append(row)
        runlog.append(spark.createDataFrame([row], RUNS_SCHEMA), log, "run_log", most_files=4)
        parts = {p: len(list((tmp_path / "log" / "run_log" / f"pipeline_id={p}").glob("*.parquet"))) for p in (7, 8)}
        assert max(parts.values()) <= 4
    kept = spark.read.schema(RUNS_SCHEMA).parquet(f"{log}/run_log")
    whole = spark.createDataFrame(rows, RUNS_SCHEMA)
    assert sorted(map(str, kept.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
    figures = [sorted(map(str, avail.availability(df, Thresholds()).collect())) for df in (kept, whole)]
    assert figures[0] == figures[1]


def test_a_part_with_few_files_is_left_alone(spark, tmp_path):
    log = str(tmp_path / "log")
    row = (1, 3, datetime(2024, 1, 1, tzinfo=timezone.utc), "success", 1.0, 1, 1, 1)
    runlog.append(spark.createDataFrame([row], RUNS_SCHEMA), log, "run_log")
    before = sorted((tmp_path / "log" / "run_log").rglob("*.parquet"))
    assert not runlog.compact(spark, log, "run_log", 3, RUNS_SCHEMA) and not runlog.compact(spark, log, "run_log", 4, RUNS_SCHEMA)
    assert sorted((tmp_path / "log" / "run_log").rglob("*.parquet")) == before
