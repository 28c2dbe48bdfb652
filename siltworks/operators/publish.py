"""Publishing a cleaned table: projection, keyed upsert, alignment and load report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siltworks.config import PrepConfig
from siltworks.operators.features import feature_names


#: buckets of keys in which two tables are compared
DIGESTS = 1024


def publish_projection(clean: DataFrame, cfg: PrepConfig, fill: int | None = 0) -> DataFrame:
    """Yes/no columns and flags as ints under their published names.

    By default what is missing or was not mappable becomes 0, which loses that
    difference; ``fill=None`` keeps it null.
    """
    whole = [c for c in (*cfg.binary, *cfg.flags) if c in clean.columns]
    typed = {}
    for c in whole:
        value = F.col(c).try_cast("int")
        typed[c] = value if fill is None else F.coalesce(value, F.lit(fill))
    return clean.withColumns(typed).withColumnsRenamed(dict(cfg.published_names))


def require_unique_key(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key is null or occurs twice. Counts per key are combined before the shuffle."""
    bad = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) | F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys)))
        .limit(5)
        .collect()
    )
    if bad:
        raise ValueError(f"missing or duplicate keys {tuple(keys)}: {[tuple(r) for r in bad]}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """``target`` with the rows of ``source`` added or put in place of those with the same key.

    Spark broadcasts the keys of the source if its own size estimate allows that and
    otherwise shuffles both sides on the key, which is unique on the source side.
    """
    if not keys:
        raise ValueError("an upsert needs its key columns")
    if set(target.columns) != set(source.columns):
        raise ValueError(f"different columns: {sorted(set(target.columns) ^ set(source.columns))}")
    if check:
        require_unique_key(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source).select(*target.columns)


def _sides(left: DataFrame, right: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    """Keys of both tables with l = 1 or r = 1, and a hash of the key."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = left.select(*keys, one.alias("l"), none.alias("r"), *more).unionByName(
        right.select(*keys, none.alias("l"), one.alias("r"), *more)
    )
    return both.withColumn("h", F.xxhash64(*keys)).withColumn("bucket", F.pmod("h", F.lit(DIGESTS)))


def _compared(sides: DataFrame, keys: Sequence[str], *counts: Column) -> DataFrame:
    """One row: n_left, n_right, ``counts`` and n_unmatched, the keys that the tables hold differently often.

    Keys are dealt to buckets by hash, and a bucket is told by its number of keys and the
    sums of both halves of their hashes, which tables with the same keys share whatever their
    order. These few numbers are all that is shuffled; only keys of buckets that differ are
    shuffled and counted one by one. Two tables that differ agree in a bucket by chance once in 2 ** 64 cases.
    """
    side = F.col("l") - F.col("r")
    digests = sides.groupBy("bucket").agg(
        F.sum("l").alias("n_left"),
        F.sum("r").alias("n_right"),
        F.sum(side * F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(side * F.shiftrightunsigned("h", 32)).alias("high"),
        *counts,
    )
    # no more rows than there are buckets
    differing = digests.filter("n_left != n_right OR low != 0 OR high != 0").select("bucket")
    per_key = sides.join(F.broadcast(differing), "bucket", "left_semi").groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    unmatched = per_key.agg(F.count_if(F.col("l") != F.col("r")).alias("n_unmatched"))
    totals = [n for n in digests.columns if n not in ("bucket", "low", "high")]
    summed = digests.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in totals])
    whole = summed.unionByName(unmatched, allowMissingColumns=True)
    return whole.agg(*[F.max(n).alias(n) for n in (*totals, "n_unmatched")])


def alignment(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Do two tables hold the same keys, each equally often? One row. See :func:`_compared` for what is shuffled."""
    return _compared(_sides(left, right, keys), keys).withColumn("aligned", F.col("n_unmatched") == 0)


def load_report(features: DataFrame, targets: DataFrame, cfg: PrepConfig) -> DataFrame:
    """Shapes, class counts, alignment and status of a load. One row; the class counts ride along."""
    sides = _sides(features.select(*cfg.key, F.lit(None).cast("int").alias("y")), targets.select(*cfg.key, "y"), cfg.key, "y")
    classes = [F.count_if(F.col("y") == k).alias(f"n_class_{k}") for k in (0, 1)]
    aligned = F.col("n_unmatched") == 0
    return _compared(sides, cfg.key, *classes).select(
        F.col("n_left").alias("n_rows_features"),
        F.lit(len(feature_names(features, cfg))).alias("n_features"),
        F.col("n_right").alias("n_rows_target"),
        "n_class_0",
        "n_class_1",
        aligned.alias("aligned"),
        F.when(aligned, "OK").otherwise("ERROR").alias("status"),
    )
