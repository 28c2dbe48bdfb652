"""Shards by jump consistent hashing.

The shard of a row depends on its key and the number of shards only, without any table:
the hash jumps from one shard number to the next larger one at which the key would move
as shards are appended, and stops before the number of shards. One more shard takes rows
only into itself, each with probability one in the new number.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltworks.llm.common import col
from siltworks.session import stage

SHARDS = 24
#: bytes that a row takes besides its text
ROW_BYTES = 8

# Fixed value: the multiplier of the published generator.
_MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to ``shards`` - 1, of each 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), dtype=np.int64)
    going = np.arange(len(state))
    landing = shard.copy()
    while going.size:
        shard[going] = landing[going]
        state[going] = state[going] * _MULTIPLIER + np.uint64(1)
        draw = ((state[going] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        landing[going] = ((shard[going] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        going = going[landing[going] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of an integer key. Rows without a key go where key 0 goes."""

    @F.pandas_udf(T.IntegerType())
    def jumped(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return jumped(F.coalesce(key.cast("long"), F.lit(0)))


def key_of(columns: Sequence[str]) -> Column:
    """An integer key for columns of any type."""
    return F.xxhash64(*[col(c) for c in columns])


def place(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", shards: int = SHARDS) -> DataFrame:
    """(id, size, text_crc32, shard, slot, grown_shard) for every row of ``df``.

    ``size`` is the UTF-8 length of the text (null: none) plus 8, ``slot`` numbers the
    rows of a shard without gaps in the order of their ids, ``grown_shard`` is the shard
    with one more. Null texts have the checksum of an empty one; null ids come first.

    Slots need no window over a shard: rows are sorted into ranges of (shard, id, input
    order), a range knows its rows' places, and the few ranges' counts add up to where
    each range of a shard begins. Repeated ids are split over ranges like others.
    """
    text = F.coalesce(col(text_column), F.lit(""))
    key = col(id_column).cast("long")
    small = df.select(
        key.alias("id"),
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("came"),
    )
    small = stage(
        small.withColumns({"shard": shard_of(F.col("id"), shards), "grown_shard": shard_of(F.col("id"), shards + 1)}),
        "shards",
    )
    order = ["shard", F.col("id").asc_nulls_first(), "came"]
    # the high bits of the increasing id are the range, the low ones the place in it
    ranged = small.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stage(ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.expr("at >> 33")), "ranges")
    before = (
        "coalesce(sum(n) OVER (PARTITION BY shard ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    begins = (
        ranged.groupBy("shard", "part")
        .agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
        .selectExpr("shard", "part", f"first - {before} AS origin")
    )
    # one row for each range and shard border: as many as tasks and shards together
    return ranged.join(F.broadcast(begins), ["shard", "part"]).select(
        "id", "size", "text_crc32", "shard", (F.col("at") - F.col("origin")).alias("slot"), "grown_shard"
    )
