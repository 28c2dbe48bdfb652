from pyspark.sql import functions as F

from table_dirs import SF_SMALL
from siltworks.kpi.availability import availability_rates
from siltworks.plans.prepare import prepare
from siltworks.sources import runs as rn
from siltworks.streaming import arrivals


def rows(df):
    return sorted(df.collect(), key=str)


def test_arrivals_are_encoded_like_a_batch(spark, cfg, small, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("landing", "out", "checkpoint"))
    batch = prepare(small, cfg)
    for part in (small.filter("contact_id < 700"), small.filter("contact_id >= 700")):
        part.write.mode("append").parquet(landing)
        stream = arrivals.encode_arrivals(arrivals.arriving_contacts(spark, landing, cfg), cfg, batch.fitted)
        arrivals.append_features(stream, out, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(batch.features)


def test_registry_follows_the_log(spark, tmp_path):
    log = str(tmp_path / "log")
    runs = rn.run_log(rn.phase_metrics(spark, SF_SMALL)).withColumn("ts", F.col("ts").cast("timestamp"))
    runs.filter("run_id < 50").write.mode("append").parquet(f"{log}/run_log")
    query = arrivals.live_registry(spark, log).writeStream.format("memory").queryName("registry").outputMode("complete").start()
    try:
        query.processAllAvailable()
        assert rows(spark.table("registry")) == rows(availability_rates(runs.filter("run_id < 50")))
        runs.filter("run_id >= 50").write.mode("append").parquet(f"{log}/run_log")
        query.processAllAvailable()
        assert rows(spark.table("registry")) == rows(availability_rates(runs))
    finally:
        query.stop()
