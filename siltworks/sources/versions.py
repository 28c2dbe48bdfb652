"""A served table in versions that cost what their change costs.

Rows lie in partitions by a hash of the key, and each version has a manifest that tells
where each partition lies. An upsert rewrites the partitions that arriving rows meet, as files of the
new version; the manifest goes on naming the old files for all others. The manifest is written last,
so that a failed job leaves no version, and readers of older versions are not disturbed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

#: rows of a partition when a table begins; a partition is one task's work
ROWS_PER_PARTITION = 1_000_000
#: fewer rows are not worth a partition
LEAST_ROWS = 10_000

PART, PLACE, SIDE, SENT = "_part", "_place", "_side", "_sent"
#: tasks of a merge at most
MOST_TASKS = 1 << 15


class Manifest(NamedTuple):
    """Key, number of hash partitions, columns, and the folder of each partition that has rows."""

    keys: list[str]
    partitions: int
    schema: T.StructType
    folders: dict[int, str]


def manifest(spark: SparkSession, version: str) -> Manifest:
    """The manifest of a version: a line for the table and one for each partition."""
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{version}/manifest").collect()]
    [table] = [x for x in lines if "keys" in x]
    folders = {x["part"]: x["folder"] for x in lines if "part" in x}
    return Manifest(table["keys"], table["partitions"], T.StructType.fromJson(table["schema"]), folders)


def _write_manifest(spark: SparkSession, version: str, m: Manifest) -> None:
    lines = [json.dumps({"keys": m.keys, "partitions": m.partitions, "schema": m.schema.jsonValue()})]
    lines += [json.dumps({"part": p, "folder": f}) for p, f in sorted(m.folders.items())]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{version}/manifest")


def read_version(spark: SparkSession, version: str) -> DataFrame:
    """All rows of a version."""
    m = manifest(spark, version)
    return _read(spark, m, sorted(m.folders))


def _read(spark: SparkSession, m: Manifest, parts: Sequence[int]) -> DataFrame:
    folders = [m.folders[p] for p in parts if p in m.folders]
    return spark.read.schema(m.schema).parquet(*folders) if folders else spark.createDataFrame([], m.schema)


def _part(keys: Sequence[str], partitions: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(partitions)).cast("int")


def upsert(
    spark: SparkSession,
    current: str | None,
    source: DataFrame,
    keys: Sequence[str],
    new_path: str,
    rows_per_partition: int = ROWS_PER_PARTITION,
) -> str | None:
    """Add the rows of ``source`` to the table or put them in place of those with the same key.

    Returns the path of the version that is now current: ``new_path``, or ``current`` if nothing
    arrives. A key that is null or arrives twice fails the job. ``source`` should be a
    written table; it is read twice, once for the partitions it meets and once for its rows. Key check
    and merge are one shuffle, by partition. A table begins with a partition for each
    ``rows_per_partition`` rows, or for each core if it is smaller, and keeps their number.
    """
    if not keys:
        raise ValueError("an upsert needs its key columns")
    if current is None:
        rows = source.count()
        if not rows:
            return None
        # small tables still use all cores
        least = min(spark.sparkContext.defaultParallelism, rows // LEAST_ROWS)
        m = Manifest(list(keys), max(1, least, -(-rows // rows_per_partition)), source.schema, {})
        arriving = source
        met = range(m.partitions)
    else:
        m = manifest(spark, current)
        if list(keys) != m.keys:
            raise ValueError(f"the table is kept by {m.keys}, not by {list(keys)}")
        if set(m.schema.names) != set(source.columns):
            raise ValueError(f"different columns: {sorted(set(m.schema.names) ^ set(source.columns))}")
        # keys of one type have one hash
        arriving = source.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in m.schema.fields])
        # as many rows as the table has partitions
        met = sorted(r[PART] for r in arriving.select(_part(keys, m.partitions).alias(PART)).distinct().collect())
        if not met:
            return current
    sides = arriving.withColumn(SIDE, F.lit(1))
    if current is not None:
        sides = _read(spark, m, met).withColumn(SIDE, F.lit(0)).unionByName(sides)
    # each partition that is met has its own task: a hash of their few numbers would deal one task several
    place = PART
    if len(met) < m.partitions:
        places = dict(zip(met, range(len(met))))
        place = f"element_at(array({', '.join(str(places.get(p, 0)) for p in range(m.partitions))}), {PART} + 1)"
    placed = sides.withColumn(PART, _part(keys, m.partitions)).withColumn(PLACE, F.expr(place))
    dealt = placed.repartitionById(min(len(met), MOST_TASKS), F.col(PLACE))
    # dealt by partition already, so the window adds no shuffle
    same_key = Window.partitionBy(PART, PLACE, *[F.col(f"`{k}`") for k in keys])
    told = F.concat_ws(", ", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("null")) for k in keys])
    bad = (F.col(SENT) > 1) | F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys))
    refused = F.raise_error(F.concat(F.lit(f"missing or duplicate keys {tuple(keys)}: "), told)).cast("boolean")
    merged = (
        dealt.withColumn(SENT, F.sum(SIDE).over(same_key))
        .filter(F.when(F.col(SIDE) == 1, F.when(bad, refused).otherwise(F.lit(True))).otherwise(F.col(SENT) == 0))
        .select(*[F.col(f"`{n}`") for n in m.schema.names], PART)
    )
    merged.write.partitionBy(PART).parquet(f"{new_path}/rows")
    # a partition that is met has rows; at the beginning some may have none
    written = {int(p) for p in met} if current is not None else {
        r[PART] for r in spark.read.parquet(f"{new_path}/rows").select(PART).distinct().collect()
    }
    folders = {**m.folders, **{p: f"{new_path}/rows/{PART}={p}" for p in written}}
    _write_manifest(spark, new_path, m._replace(folders=folders))
    return new_path
