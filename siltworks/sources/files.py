"""What is known about files without reading them, and samples of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

FILE_SCHEMA = "path string, size_bytes bigint, modified timestamp"


def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Path, size and time of every file under ``path``; contents are not read.

    Empty if the path does not exist.
    """
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
        )
    except AnalysisException:
        return spark.createDataFrame([], FILE_SCHEMA)
    return files.select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))


def require_source(spark: SparkSession, path: str) -> None:
    """Fail early if there is nothing to read."""
    if list_files(spark, path).isEmpty():
        raise FileNotFoundError(f"no input at {path}")


def source_inventory(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per source: does it exist, how many files and bytes does it hold."""
    found = None
    for path in paths:
        files = list_files(spark, path).withColumn("source", F.lit(path))
        found = files if found is None else found.unionByName(files)
    if found is None:
        raise ValueError("no sources given")
    counted = found.groupBy("source").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("size_bytes"))
    asked = spark.createDataFrame([(p,) for p in paths], "source string")
    return asked.join(counted, "source", "left").select(
        "source",
        F.col("n_files").isNotNull().alias("available"),
        F.coalesce("n_files", F.lit(0)).alias("n_files"),
        F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"),
    )


def dir_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes of a directory tree; zeros if it does not exist."""
    return list_files(spark, path).agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes")
    )


def table_sample(df: DataFrame, keys: Sequence[str], n: int = 1) -> DataFrame:
    """The first ``n`` rows by key. Each task keeps its own first ``n``, so nothing is sorted whole."""
    return df.orderBy(*keys).limit(n)
