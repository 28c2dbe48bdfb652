from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltworks.operators import features as fe
from siltworks.operators.features import Fitted, Scale
from siltworks.operators.quantiles import NumericSummary
from siltworks.plans.prepare import prepare
from siltworks.session import new_table_path


@pytest.fixture(scope="module")
def prepared(small, cfg):
    return prepare(small, cfg)


def test_all_features_in_order(prepared, cfg):
    names = fe.feature_names(prepared.features, cfg)
    assert len(names) == 35
    assert names[:5] == ["balance", "age", "pdays", "previous", "campaign"]
    assert names[-7:] == ["day_sin", "day_cos", "month_sin", "month_cos", "default", "housing", "loan"]
    assert "duration" not in names and prepared.features.columns[-1] == "y"
    assert {t for n, t in prepared.features.dtypes if n in names} == {"double"}


def test_scales_are_centred(prepared):
    row = prepared.features.agg(
        F.median("balance").alias("median"),
        *[F.avg(c).alias(f"{c}_mean") for c in ("age", "pdays")],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in ("age", "pdays")],
    ).first()
    assert row["median"] == pytest.approx(0, abs=1e-9)
    for c in ("age", "pdays"):
        assert row[f"{c}_mean"] == pytest.approx(0, abs=1e-9) and row[f"{c}_std"] == pytest.approx(1)


def test_one_hot_sums_to_one_and_circles_close(prepared, cfg):
    f = prepared.features
    sums = [sum((F.col(f"`{c}_{v}`") for v in prepared.fitted.levels[c]), F.lit(0.0)) for c in cfg.one_hot]
    circles = [F.col(f"{c}_sin") ** 2 + F.col(f"{c}_cos") ** 2 for c in cfg.cyclic]
    bad = [F.count_if(F.abs(c - 1) > 1e-9) for c in sums + circles]
    assert set(f.agg(*[b.alias(str(i)) for i, b in enumerate(bad)]).first()) == {0}


def test_result_does_not_depend_on_partitions(small, cfg, prepared):
    again = prepare(small.repartition(13, "age"), cfg)
    assert again.fitted.levels == prepared.fitted.levels
    assert again.fitted.fences == prepared.fitted.fences
    for c, scale in prepared.fitted.standard.items():
        assert again.fitted.standard[c].scale == pytest.approx(scale.scale)


def test_saved_fit_comes_back(spark, prepared):
    path = new_table_path(spark, "fitted")
    fe.save_fitted(spark, prepared.fitted, path)
    assert fe.load_fitted(spark, path) == prepared.fitted


def test_unknown_levels_and_names(spark, cfg):
    fitted = Fitted(levels={"job": ("a", "b")})
    only = replace(cfg, key=(), robust=(), standard=(), one_hot=("job",), flags=(), cyclic_numbers={}, binary=("deposit",))
    df = spark.createDataFrame([("a", "primary", "Jan ", 1.0), ("z", "phd", "xyz", 0.0)], "job string, education string, month string, deposit double")
    known, unknown = fe.transform(df, only, fitted).collect()
    assert (known["job_a"], known["job_b"], known["education"], known["y"]) == (1.0, 0.0, 0.0, 1)
    assert known["month_sin"] == pytest.approx(0.5)
    assert (unknown["job_a"], unknown["job_b"], unknown["education"]) == (0.0, 0.0, -1.0)
    assert unknown["month_sin"] is None


def test_columns_without_spread_are_only_centred():
    flat = NumericSummary(3, 5.0, 0.0, {0.25: 5.0, 0.5: 5.0, 0.75: 5.0})
    assert fe.robust_scale(flat) == fe.standard_scale(flat) == Scale(5.0, 1.0)
    empty = NumericSummary(0, None, None, {0.25: None, 0.5: None, 0.75: None})
    assert fe.robust_scale(empty) == Scale(None, None)


def test_infinite_values_cannot_be_scaled():
    with pytest.raises(ValueError, match="infinite"):
        fe.standard_scale(NumericSummary(3, float("inf"), float("nan")))


def test_any_number_of_levels_is_encoded(spark):
    df = spark.range(6000).selectExpr("CAST(id % 5000 AS STRING) AS job", "'x' AS contact")
    levels = fe.fit_levels(df, ["job", "contact"], "nan")
    assert len(levels["job"]) == 5000 and len(fe.one_hot("job", levels["job"], "nan")) == 5000
    rows = fe.one_hot_places(df, "job", fe.fit_vocabulary(df, "job", "nan"), "nan").collect()
    assert len(rows) == 6000
    assert all((r.job_hot.size, r.job_hot.place) == (5000, levels["job"].index(r.job)) for r in rows[::60])


def test_declared_levels_save_a_pass(prepared, cfg):
    fitted = fe.fit(prepared.raw, cfg, levels={c: ["x"] for c in cfg.one_hot})
    assert fitted.levels["job"] == ("x",)


def test_missing_target_column_fails_at_once(prepared, cfg):
    with pytest.raises(ValueError, match="deposit"):
        fe.transform(prepared.clean.drop("deposit"), cfg, prepared.fitted)


def test_missing_target_value_fails_the_job(prepared, cfg):
    holed = prepared.clean.withColumn("deposit", F.when(F.col("contact_id") != 1, F.col("deposit")))
    with pytest.raises(PySparkException, match="missing value"):
        fe.transform(holed, cfg, prepared.fitted).collect()
    kept = fe.transform(fe.drop_missing_target(holed, cfg), cfg, prepared.fitted)
    assert kept.count() == prepared.clean.count() - 1


def test_partial_schema(small, cfg):
    names = fe.feature_names(prepare(small.drop("previous", "poutcome", "day"), cfg).features, cfg)
    assert len(names) == 35 - 1 - 1 - 4 - 2
    assert not [n for n in names if "previous" in n or "poutcome" in n or n.startswith("day")]


def test_vector_output(prepared, cfg):
    row = fe.as_vector(prepared.features, cfg).first()
    assert row["features"].size == 35


def test_a_million_levels_stay_in_a_table(spark, cfg, monkeypatch):
    """Fitted, saved, loaded and applied; a third of the rows has one level; unseen levels have no place."""
    only = replace(cfg, key=("k",), robust=(), standard=(), one_hot=(), one_hot_sparse=("job",), ordinal={}, flags=(), outlier_flags={},
                   cyclic_numbers={}, cyclic_names={}, binary=("deposit",))
    job = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id = 7 THEN NULL ELSE concat('j', id) END"
    df = spark.range(0, 1_500_000, 1, 4).selectExpr("id AS k", f"{job} AS job", "1D AS deposit")
    fitted = fe.fit(df, only)
    assert fitted.levels == {} and fitted.vocabularies["job"].size == 1_000_001
    path = new_table_path(spark, "fitted")
    fe.save_fitted(spark, fitted, path)
    loaded = fe.load_fitted(spark, path)
    vocabulary = spark.read.parquet(loaded.vocabularies["job"].path)
    assert [r["level"] for r in vocabulary.filter("hot").collect()] == ["hot"]
    seen = df.filter("k < 3000").unionByName(spark.createDataFrame([(-1, "unseen", 1.0)], df.schema))
    rows = {r["k"]: r["job_hot"] for r in fe.transform(seen, only, loaded).collect()}
    assert len(rows) == 3001 and {r["size"] for r in rows.values()} == {1_000_001}
    assert rows[-1]["place"] is None and rows[0]["place"] == rows[3]["place"] == 0
    places = {r["level"]: r["place"] for r in vocabulary.filter("place < 5 OR level IN ('j1', 'j2999', 'nan')").collect()}
    assert (rows[1]["place"], rows[2999]["place"], rows[7]["place"]) == (places["j1"], places["j2999"], places["nan"])
    assert sorted(places, key=places.get)[:3] == ["hot", "j1", "j10"]
    plan = fe.transform(df, only, loaded)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
