"""New contacts and new runs as they arrive.

With a saved fit the preparation is a projection, and the run registry is a count per
pipeline, so both work on a stream as they are. What is added here is reading the
folders that a batch run appends to, and writing with a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siltworks.config import PrepConfig
from siltworks.kpi.availability import availability_rates
from siltworks.operators.features import Fitted
from siltworks.plans.prepare import prepare
from siltworks.plans.run import RUNS_SCHEMA


def arriving_contacts(spark: SparkSession, path: str, cfg: PrepConfig) -> DataFrame:
    """Files of text columns that land in ``path``, as Parquet."""
    columns = [f"{k} bigint" for k in cfg.key] + [f"`{c}` string" for c in cfg.expected]
    return spark.readStream.schema(", ".join(columns)).parquet(path)


def encode_arrivals(text: DataFrame, cfg: PrepConfig, fitted: Fitted) -> DataFrame:
    """Features of the arriving contacts, encoded with the fit of an earlier run."""
    return prepare(text, cfg, fitted).features


def append_features(features: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what has arrived so far and stop; call again to go on from there."""
    return (
        features.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def live_registry(spark: SparkSession, log: str) -> DataFrame:
    """Runs by outcome and success rates of every pipeline, kept up to date.

    The state is one row per pipeline. Write it in complete or update mode.
    """
    return availability_rates(spark.readStream.schema(RUNS_SCHEMA).parquet(f"{log}/run_log"))
