"""Sinks: Parquet and CSV exports, versioned upsert, database upsert, JSON report."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from siltworks.config import PrepConfig
from siltworks.operators.features import feature_names
from siltworks.operators.publish import upsert

MANIFEST_SCHEMA = "artifact string, format string, path string"


def export_parquet(features: DataFrame, clean: DataFrame, path: str) -> DataFrame:
    """Write both tables with their key; returns the manifest."""
    parts = {"features": features, "clean": clean}
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return features.sparkSession.createDataFrame(
        [(name, "parquet", f"{path}/{name}") for name in parts], MANIFEST_SCHEMA
    )


def export_csv(features: DataFrame, cfg: PrepConfig, path: str) -> DataFrame:
    """Write features and target as two files sets that share the key; returns the manifest."""
    parts = {
        "features": features.select(*cfg.key, *[f"`{c}`" for c in feature_names(features, cfg)]),
        "target": features.select(*cfg.key, "y"),
    }
    for name, df in parts.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
    return features.sparkSession.createDataFrame([(name, "csv", f"{path}/{name}") for name in parts], MANIFEST_SCHEMA)


def export_report(report: DataFrame, path: str) -> None:
    """One JSON record per line; the report has one row per pipeline."""
    report.write.mode("overwrite").json(path)


def upsert_version(
    spark: SparkSession, current: str | None, source: DataFrame, keys: Sequence[str], new_path: str
) -> str | None:
    """Write the upserted table as a new version and return the path that is now current.

    A Parquet table cannot be replaced while it is read, so the caller switches to the
    returned path once the write has succeeded; a failed job leaves the old version as it
    was. An empty source writes nothing.
    """
    if source.isEmpty():
        return current
    if current is None:
        merged = upsert(source.limit(0), source, keys)
    else:
        merged = upsert(spark.read.parquet(current), source, keys)
    merged.write.parquet(new_path)
    return new_path


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str], mark: str = "%s") -> str:
    """INSERT with a conflict clause on the key, as PostgreSQL and others understand it."""

    def quoted(names: Sequence[str]) -> str:
        return ", ".join('"' + n.replace('"', '""') + '"' for n in names)

    rest = [c for c in columns if c not in keys]
    updates = ", ".join(f"{quoted([c])} = EXCLUDED.{quoted([c])}" for c in rest)
    action = f"DO UPDATE SET {updates}" if rest else "DO NOTHING"
    marks = ", ".join([mark] * len(columns))
    return f"INSERT INTO {table} ({quoted(columns)}) VALUES ({marks}) ON CONFLICT ({quoted(keys)}) {action}"


def upsert_database(
    source: DataFrame, table: str, keys: Sequence[str], connect: Callable[[], object], batch: int = 5000, mark: str = "%s"
) -> None:
    """Upsert through DB-API connections, one per partition, in batches.

    ``connect`` runs in the tasks. Every batch is its own transaction and writing a row
    twice gives the same table, so a task that is run again does no harm. The number of
    partitions of ``source`` is the number of connections.
    """
    columns = source.columns
    statement = upsert_statement(table, columns, keys, mark)

    def send(rows) -> None:
        connection = None
        waiting: list[tuple] = []
        try:
            for row in rows:
                connection = connection or connect()
                waiting.append(tuple(row))
                if len(waiting) >= batch:
                    connection.cursor().executemany(statement, waiting)
                    connection.commit()
                    waiting = []
            if waiting:
                connection.cursor().executemany(statement, waiting)
                connection.commit()
        finally:
            if connection is not None:
                connection.close()

    source.foreachPartition(send)
