import pytest
from pyspark.sql import functions as F

from siltworks.operators import publish as pub
from siltworks.sources import sinks


def table(spark, rows):
    return spark.createDataFrame(rows, "k bigint, v string")


def contents(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


def test_upsert_replaces_and_adds(spark):
    merged = pub.upsert(table(spark, [(1, "a"), (2, "b")]), table(spark, [(2, "B"), (3, "c")]), ["k"])
    assert contents(merged) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_again_changes_nothing(spark):
    source = table(spark, [(2, "B"), (3, "c")])
    once = pub.upsert(table(spark, [(1, "a"), (2, "b")]), source, ["k"])
    assert contents(pub.upsert(once, source, ["k"])) == contents(once)


@pytest.mark.parametrize("rows", [[(1, "a"), (1, "b")], [(None, "a")]])
def test_bad_keys_are_refused(spark, rows):
    with pytest.raises(ValueError, match="keys"):
        pub.upsert(table(spark, [(1, "x")]), table(spark, rows), ["k"])


def test_upsert_needs_keys_and_equal_columns(spark):
    with pytest.raises(ValueError):
        pub.upsert(table(spark, []), table(spark, []), [])
    with pytest.raises(ValueError, match="columns"):
        pub.upsert(table(spark, []), table(spark, []).withColumn("w", F.lit(1)), ["k"])


def test_versions(spark, tmp_path):
    one, two = str(tmp_path / "1"), str(tmp_path / "2")
    assert sinks.upsert_version(spark, None, table(spark, []), ["k"], one) is None
    assert sinks.upsert_version(spark, None, table(spark, [(1, "a")]), ["k"], one) == one
    assert sinks.upsert_version(spark, one, table(spark, []), ["k"], two) == one
    assert sinks.upsert_version(spark, one, table(spark, [(1, "b"), (2, "c")]), ["k"], two) == two
    assert contents(spark.read.parquet(two)) == [(1, "b"), (2, "c")]
    assert contents(spark.read.parquet(one)) == [(1, "a")]


def test_alignment_counts_repeats(spark):
    left = table(spark, [(1, "a"), (1, "a"), (2, "b"), (3, "c")])
    right = table(spark, [(1, "a"), (2, "b"), (4, "d")])
    assert tuple(pub.alignment(left, right, ["k"]).first()) == (4, 3, 3, False)
    assert tuple(pub.alignment(left, left.orderBy(F.desc("k")), ["k"]).first()) == (4, 4, 0, True)
    assert tuple(pub.alignment(left.limit(0), right.limit(0), ["k"]).first()) == (0, 0, 0, True)


def test_alignment_counts_keys_of_differing_buckets_alone(spark, monkeypatch):
    monkeypatch.setattr(pub, "DIGESTS", 16)
    left = spark.range(2000).selectExpr("id AS k", "'a' AS v")
    right = left.filter("k != 77").unionByName(table(spark, [(5, "a"), (5, "b"), (-3, "c")]))
    assert tuple(pub.alignment(left, right, ["k"]).first()) == (2000, 2002, 3, False)
    swapped = left.filter("k != 77").unionByName(table(spark, [(-77, "a")]))
    assert tuple(pub.alignment(left, swapped, ["k"]).first()) == (2000, 2000, 2, False)
    # ints on one side, longs on the other
    assert pub.alignment(left, left.selectExpr("CAST(k AS INT) AS k", "v"), ["k"]).first()["aligned"]


def test_published_columns(spark, cfg):
    df = spark.createDataFrame([(1, None, 1.0, 0.0, 1.0, 7)], "contact_id bigint, default double, housing double, loan double, deposit double, other int")
    filled = pub.publish_projection(df, cfg)
    assert filled.columns == ["contact_id", "default_flag", "housing", "loan", "y", "other"]
    assert tuple(filled.first()) == (1, 0, 1, 0, 1, 7)
    assert pub.publish_projection(df, cfg, fill=None).first()["default_flag"] is None


def test_load_report_of_unaligned_tables(spark, cfg):
    features = spark.range(5).selectExpr("id AS contact_id", "1D AS a", "2D AS b", "1 AS y")
    targets = features.select("contact_id", "y").filter("contact_id < 4")
    row = pub.load_report(features, targets, cfg).first()
    assert (row["n_rows_features"], row["n_features"], row["n_rows_target"], row["n_class_1"], row["status"]) == (5, 2, 4, 4, "ERROR")


def test_statement():
    assert sinks.upsert_statement("t", ["k", "v"], ["k"]) == (
        'INSERT INTO t ("k", "v") VALUES (%s, %s) ON CONFLICT ("k") DO UPDATE SET "v" = EXCLUDED."v"'
    )
    assert sinks.upsert_statement("t", ["k"], ["k"], "?").endswith("DO NOTHING")


def test_database_upsert_sends_batches_from_the_tasks(spark, tmp_path):
    folder = str(tmp_path)

    def connect():
        import uuid

        class Recorder:
            """Stands in for a DB-API connection: appends what it is sent to a file."""

            def __init__(self):
                self.path, self.batches = f"{folder}/{uuid.uuid4().hex}", 0

            def cursor(self):
                return self

            def executemany(self, statement, rows):
                assert statement.startswith("INSERT INTO served") and len(rows) <= 10
                with open(self.path, "a") as out:
                    out.writelines(f"{k},{v}\n" for k, v in rows)

            def commit(self):
                self.batches += 1

            def close(self):
                with open(self.path + ".closed", "w") as out:
                    out.write(str(self.batches))

        return Recorder()

    df = spark.range(95).selectExpr("id AS k", "CAST(id AS STRING) AS v").repartition(3)
    sinks.upsert_database(df, "served", ["k"], connect, batch=10)
    sent = [line for f in tmp_path.iterdir() if f.suffix == "" for line in f.read_text().splitlines()]
    assert sorted(sent) == sorted(f"{i},{i}" for i in range(95))
    assert len(list(tmp_path.glob("*.closed"))) == 3
