import pytest
from pyspark.sql import functions as F

from siltworks.operators import ingest as ing


def test_header_is_stripped_and_lower_cased(spark):
    df = spark.createDataFrame([("1", "2")], "` Age ` string, BALANCE string")
    assert ing.header_map(df.columns) == {" Age ": "age", "BALANCE": "balance"}
    assert ing.normalize_header(df).columns == ["age", "balance"]


def test_colliding_headers_are_refused_before_reading():
    with pytest.raises(ValueError, match="age"):
        ing.header_map(["Age", " age", "job"])


def test_only_the_four_tokens_become_null(spark, cfg):
    values = ["", " ", "NA", "N/A", "nan", "NULL", "None", "na", "  ", " NA"]
    df = spark.createDataFrame([(v,) for v in values], "v string").withColumn("i", F.monotonically_increasing_id())
    kept = ing.apply_null_tokens(df, cfg.null_tokens, ["v"]).orderBy("i").collect()
    assert [r["v"] for r in kept] == [None] * 4 + values[4:]


@pytest.mark.parametrize(
    "text, number",
    [
        ("12", 12.0), (" 12 ", 12.0), ("\t7\n", 7.0), ("-1.5e3", -1500.0), ("+.5", 0.5), ("5.", 5.0),
        ("inf", float("inf")), ("-Infinity", float("-inf")),
        ("nan", None), ("NaN", None), ("1.0d", None), ("1f", None), ("1_000", None), ("0x10", None),
        ("abc", None), ("", None), (None, None), ("1 2", None), ("1e", None),
    ],
)
def test_tolerant_cast(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert ing.cast_numeric(df, ["v"]).first()["v"] == number


def test_numeric_token_is_null_even_in_a_numeric_column(spark, cfg):
    from dataclasses import replace

    coded = replace(cfg, null_tokens=("-999",), numeric=("v",))
    df = spark.createDataFrame([("-999",), ("4",)], "v string")
    assert sorted(ing.ingest(df, coded).collect(), key=str) == [(4.0,), (None,)]


def test_schema_check_lists_missing_columns(small, cfg):
    found = ing.schema_check(small.drop("previous", "poutcome"), cfg).collect()
    assert [r["column_name"] for r in found if not r["present"]] == ["previous", "poutcome"]
    assert len(found) == 17


def test_null_census_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b string")
    rows = {r["column_name"]: r for r in ing.null_census(empty, ["a", "b"]).collect()}
    assert rows["*"]["n_null"] == 0 and rows["*"]["null_pct"] is None


def test_trace_counts_rows_while_the_job_runs(spark):
    trace = ing.Trace()
    df = spark.range(10).transform(trace.point("all")).filter("id < 4").transform(trace.point("some"))
    df.write.format("noop").mode("overwrite").save()
    assert trace.rows() == [("all", 10, 1, "id"), ("some", 4, 1, "id")]
