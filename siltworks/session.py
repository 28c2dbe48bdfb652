"""Session settings and the shared folder for tables written between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: longer generated methods are never compiled to machine code by the JVM; wide projections run several times
#: faster when Spark splits them up instead
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
UNSET_METHOD_LIMIT = "65535"


def build_session(app_name: str = "siltworks", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on and the UTC time zone.

    The number of shuffle partitions is left to the cluster: adaptive execution
    merges small ones, so a generous cluster default is safe.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        METHOD_LIMIT[0]: METHOD_LIMIT[1],
        # call sites of column expressions are for notebooks; they slow the building of wide plans
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def compile_wide(spark: SparkSession) -> None:
    """Sets the limit of generated methods in a session that somebody else has built; one set by its owner stays."""
    name, limit = METHOD_LIMIT
    if spark.conf.get(name) == UNSET_METHOD_LIMIT:
        spark.conf.set(name, limit)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own;
    on a cluster a folder of one machine would be lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="siltworks-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; no two calls return the same one."""
    return f"{shared_dir(spark)}/siltworks/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Use it for a table that several jobs read: later jobs scan only the columns
    they need, and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
