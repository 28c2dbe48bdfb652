import pytest

from siltworks.operators import clean as cl


def test_categories(spark, cfg):
    df = spark.createDataFrame([("  Blue-Collar\t",), (None,), (" X ",), ("",)], "job string")
    assert [r["job"] for r in cl.normalize_categories(df, ["job", "absent"], "nan").collect()] == ["blue-collar", "nan", "x", ""]


@pytest.mark.parametrize("text", ["a", "a b", "é", "\u3000", "", "\x1f", "~!", "日本"])
@pytest.mark.parametrize("space", ["", " ", "\t", "\n ", " \x1f", "\u00a0", " \u3000\u2003", "\x85"])
def test_stripping_equals_python(spark, text, space):
    from pyspark.sql import functions as F

    from siltworks.functions.scalars import strip_sql

    df = spark.createDataFrame([(space + text + space,)], "v string")
    assert df.select(F.expr(strip_sql("v"))).first()[0] == (space + text + space).strip()


def test_yes_no_variants(spark, cfg):
    yes = ["yes", " YES", "Y", "1", "True\n"]
    no = ["no", "N ", "0", "FALSE"]
    other = ["maybe", "", None, "1.0"]
    df = spark.createDataFrame([(v,) for v in yes + no + other], "loan string")
    mapped = [r["loan"] for r in cl.map_binary(df, ["loan"], cfg.yes_tokens, cfg.no_tokens).collect()]
    assert mapped == [1.0] * 5 + [0.0] * 4 + [None] * 4


def test_unmappable_shows_five_tokens_and_counts_all(spark, cfg):
    tokens = ["yes", "no"] + [f"t{i}" for i in range(9)] * 2 + [None]
    df = spark.createDataFrame([(t,) for t in tokens], "loan string")
    row = cl.unmappable_census(df, cfg).first()
    assert (row["n_one"], row["n_zero"], row["n_unmappable"]) == (1, 1, 18)
    assert row["offenders"] == "t0|t1|t2|t3|t4"


def flags(spark, cfg, values, column="balance"):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{column} double")
    return [tuple(r)[1:] for r in cl.add_flags(df, cfg, cl.fit_fences(df, cfg)).collect()]


def test_outliers_lie_strictly_beyond_the_fence(spark, cfg):
    # quartiles 2 and 4, fence -1 to 7
    assert flags(spark, cfg, [1, 2, 3, 4, 7]) == [(0, 0)] * 5
    assert flags(spark, cfg, [1, 2, 3, 4, 7.5])[-1] == (0, 1)


def test_missing_values_are_never_flagged(spark, cfg):
    assert flags(spark, cfg, [None, -5, 1, 1, 1, 1, 1]) == [(0, 0), (1, 1)] + [(0, 0)] * 5


def test_nan_does_not_spoil_the_fence(spark, cfg):
    assert flags(spark, cfg, [float("nan"), 1, 2, 3])[1:] == [(0, 0)] * 3


def test_special_values_are_neither_fitted_nor_flagged(spark, cfg):
    df = spark.createDataFrame([(float(v),) for v in [-1] * 50 + [100, 110, 120, 130, 900]], "pdays double")
    fences = cl.fit_fences(df, cfg)
    assert (fences["pdays"].n, fences["pdays"].q1) == (5, 110.0)
    marked = cl.add_flags(df, cfg, fences).groupBy("pdays").agg({"flag_outlier_pdays": "max", "pdays_flag_nuevo_cliente": "max"})
    found = {r["pdays"]: (r["max(flag_outlier_pdays)"], r["max(pdays_flag_nuevo_cliente)"]) for r in marked.collect()}
    assert found == {-1.0: (0, 1), 100.0: (0, 0), 110.0: (0, 0), 120.0: (0, 0), 130.0: (0, 0), 900.0: (1, 0)}


def test_nothing_to_fit(spark, cfg):
    assert flags(spark, cfg, [None, None]) == [(0, 0)] * 2
    assert flags(spark, cfg, []) == []


def test_infinite_quartiles_flag_nothing(spark, cfg):
    inf = float("inf")
    assert flags(spark, cfg, [inf, inf, inf, 1, 2]) == [(0, 0)] * 5


def test_constant_column(spark, cfg):
    assert flags(spark, cfg, [5] * 8 + [6]) == [(0, 0)] * 8 + [(0, 1)]


def test_sketch_is_an_option(spark, cfg):
    df = spark.range(1, 1001).selectExpr("CAST(id AS DOUBLE) AS balance")
    fence = cl.fit_fences(df, cfg, accuracy=10_000)["balance"]
    assert abs(fence.q1 - 250.75) <= 1


def test_flag_order_and_untouched_input(small, cfg):
    from siltworks.operators.ingest import ingest

    typed = ingest(small, cfg)
    before = typed.columns
    cleaned = cl.clean(typed, cfg)
    assert typed.columns == before
    assert cleaned.columns == before + list(cfg.flags)
    assert cleaned.count() == small.count()


@pytest.mark.parametrize("missing", ["balance", "pdays"])
def test_absent_columns_are_skipped(small, cfg, missing):
    from siltworks.operators.ingest import ingest

    cleaned = cl.clean(ingest(small.drop(missing), cfg), cfg)
    assert not [f for f in cleaned.columns if f.startswith("flag") and missing in f]
