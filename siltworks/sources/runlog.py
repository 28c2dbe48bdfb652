"""The log of runs, by pipeline, kept in few files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siltworks.session import stage
from siltworks.sources import files

#: files of a pipeline's part of a log table; with more, they become one
MOST_FILES = 64


def append(rows: DataFrame, log: str, name: str, most_files: int = MOST_FILES) -> None:
    """Add the rows of a run of one pipeline to a table of the log, and compact its part if it has got many files."""
    rows.coalesce(1).write.mode("append").partitionBy("pipeline_id").parquet(f"{log}/{name}")
    compact(rows.sparkSession, log, name, rows.select("pipeline_id").first()[0], rows.schema, most_files)


def compact(spark: SparkSession, log: str, name: str, pipeline_id: int, schema: T.StructType | str, most_files: int = MOST_FILES) -> bool:
    """Make one file of a pipeline's part of a log table if it has more than ``most_files``; was it done?

    The rows are written to the shared folder before they take the place of the old files, where they remain if
    that fails. Other pipelines are not touched; runs of one pipeline that end at the same time have to be
    kept apart by their scheduler, as they always had for their results.
    """
    if files.list_files(spark, f"{log}/{name}/pipeline_id={pipeline_id}").count() <= most_files:
        return False
    own = spark.read.schema(schema).parquet(f"{log}/{name}").filter(F.col("pipeline_id") == pipeline_id)
    kept = stage(own.coalesce(1), f"{name}_compacted")
    (
        kept.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("pipeline_id").parquet(f"{log}/{name}")
    )
    return True
