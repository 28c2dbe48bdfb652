"""What the operators share: tables, Arrow batches and text in pieces that fit a worker."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: rows that a Python worker turns into Python objects at once
SLICE_ROWS = 256
#: bytes of Arrow data that a worker turns into Python objects at once; one row may be larger
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str):
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are Python objects at any time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        per_row = max(1, batch.nbytes // batch.num_rows)
        step = max(1, min(rows, SLICE_BYTES // per_row))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def text_hash(text: str = "text"):
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(F.coalesce(col(text), F.lit("")), col(text).isNull())


def partitions_for(rows: int, rows_each: int, least: int = 1, most: int = 1 << 16) -> int:
    return max(least, min(most, -(-rows // rows_each)))


def map_text(df: DataFrame, text: str, added: str, work) -> DataFrame:
    """``df`` with columns that ``work`` makes from its texts, whole rows in, whole rows out.

    ``added`` is their schema; ``work`` takes a list of texts and returns one Arrow array
    for each added column. Other columns may have any names and types; a column named
    like an added one is replaced.
    """
    schema = T.StructType.fromDDL(added)
    new = {n.lower() for n in schema.names}
    kept = [c for c in df.columns if c.lower() not in new]
    # rows travel as one struct, so that no column name has to be resolved on the way
    packed = df.select(F.struct(*[col(c) for c in kept]).alias("row"), col(text).alias("t"))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = work(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["row", *schema.names])

    out = T.StructType([packed.schema["row"], *schema.fields])
    row = [F.col("row").getField(c).alias(c) for c in kept]
    return packed.mapInArrow(mapped, out).select(*row, *schema.names)
