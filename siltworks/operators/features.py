"""Fit once, apply anywhere: scalers, one-hot, ordinal and cyclic encoding.

``fit`` reads the table and returns a few numbers and the category levels.
``transform`` puts them into expressions as literals, so applying them is one narrow
projection without a join, on a table or on a stream. Only columns of ``one_hot_sparse``,
whose levels stay in a table, are joined with them.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltworks.config import PrepConfig
from siltworks.functions import sql
from siltworks.functions.scalars import canonical_text, cyclic, place_sql, strip_sql, without_nan_sql
from siltworks.operators.clean import Fence, fence, fence_columns
from siltworks.operators.quantiles import NumericSummary, summarize
from siltworks.session import new_table_path, stage

NUMBERS_SCHEMA = (
    "role string, column_name string, n bigint, q1 double, median double, q3 double, "
    "lower double, upper double, center double, scale double"
)
LEVELS_SCHEMA = "column_name string, position int, level string"
VOCABULARY_SCHEMA = "level string, place bigint, hot boolean"
VOCABULARIES_SCHEMA = "column_name string, path string, size bigint"

#: a level is hot if more than one row in so many has it; there are fewer hot levels than that
HOT_SHARE = 1000


@dataclass(frozen=True)
class Scale:
    """``(x - center) / scale``; both are null for a column without values."""

    center: float | None
    scale: float | None


@dataclass(frozen=True)
class Vocabulary:
    """The levels of a sparse one-hot column as a table (level, place, hot), and how many there are."""

    path: str
    size: int


@dataclass(frozen=True)
class Fitted:
    """Everything learned from a table."""

    fences: Mapping[str, Fence] = field(default_factory=dict)
    robust: Mapping[str, Scale] = field(default_factory=dict)
    standard: Mapping[str, Scale] = field(default_factory=dict)
    levels: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    vocabularies: Mapping[str, Vocabulary] = field(default_factory=dict)


# ---- fit -------------------------------------------------------------------


def _scale(center: float | None, scale: float | None) -> Scale:
    """A column without spread is centred only; one with infinite values cannot be scaled."""
    if center is None or scale is None:
        return Scale(None, None)
    if not (math.isfinite(center) and math.isfinite(scale)):
        raise ValueError("a column with infinite values cannot be scaled")
    return Scale(center, scale if scale >= 10 * sys.float_info.epsilon else 1.0)


def robust_scale(summary: NumericSummary) -> Scale:
    q1, median, q3 = (summary.quantiles[p] for p in (0.25, 0.5, 0.75))
    return _scale(median, None if q1 is None or q3 is None else q3 - q1)


def standard_scale(summary: NumericSummary) -> Scale:
    return _scale(summary.mean, summary.stddev_pop)


def fit_vocabulary(df: DataFrame, column: str, missing: str) -> Vocabulary:
    """The sorted levels of a column as a written table; none of them reaches the driver.

    Levels are sorted in ranges; ranges count their own, and their few counts add up. A level is hot
    if more than one row in ``HOT_SHARE`` has it.
    """
    counted = df.select(canonical_text(column, missing).alias("level")).groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    ranged = counted.repartitionByRange("level").sortWithinPartitions("level")
    ranged = stage(ranged.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.expr("at >> 33")), "levels")
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("first"), F.sum("n").alias("rows"))
    before = "coalesce(sum(size) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    origins = parts.selectExpr("part", f"first - {before} AS origin")
    size, rows = parts.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    placed = ranged.join(origins, "part").select(
        "level", (F.col("at") - F.col("origin")).alias("place"), (F.col("n") * HOT_SHARE > F.lit(rows)).alias("hot")
    )
    path = new_table_path(df.sparkSession, "vocabulary")
    placed.write.parquet(path)
    return Vocabulary(path, size)


def fit_levels(df: DataFrame, columns: Sequence[str], missing: str) -> dict[str, tuple[str, ...]]:
    """The sorted levels of every column, all of them, found in one pass.

    Each level becomes an output column of :func:`one_hot`, so the levels are known to the
    driver as column names are. A column of very many levels belongs to ``one_hot_sparse`` of the
    configuration, which keeps its levels in a table.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    # different values are found first, by column, so that few texts are stripped and lowered
    values = [df.select(F.lit(c).alias("column_name"), F.col(sql.name(c)).alias("v")).distinct() for c in present]
    level = canonical_text("v", missing).alias("level")
    found: dict[str, list[str]] = {c: [] for c in present}
    for row in reduce(DataFrame.unionAll, values).select("column_name", level).distinct().collect():
        found[row["column_name"]].append(row["level"])
    return {c: tuple(sorted(levels)) for c, levels in found.items()}


def fit_scales(df: DataFrame, cfg: PrepConfig) -> tuple[dict[str, Scale], dict[str, Scale]]:
    robust = {c: without_nan_sql(c) for c in cfg.robust if c in df.columns}
    standard = {c: without_nan_sql(c) for c in cfg.standard if c in df.columns}
    summary = summarize(df, robust, standard)
    return {c: robust_scale(summary[c]) for c in robust}, {c: standard_scale(summary[c]) for c in standard}


def fit(df: DataFrame, cfg: PrepConfig, levels: Mapping[str, Sequence[str]] | None = None) -> Fitted:
    """Fences, scales and levels of a typed or a cleaned table, sharing their passes.

    ``levels`` may declare the categories and so save the pass that looks for them.
    """
    quantile_columns = {f"fence:{c}": v for c, v in fence_columns(df, cfg).items()}
    for c in cfg.robust:
        if c in df.columns and not (c in cfg.outlier_flags and c not in cfg.outlier_excluded):
            quantile_columns[f"robust:{c}"] = without_nan_sql(c)
    moments = {f"standard:{c}": without_nan_sql(c) for c in cfg.standard if c in df.columns}
    summary = summarize(df, quantile_columns, moments)
    return Fitted(
        fences={c: fence(summary[f"fence:{c}"], cfg.fence_width) for c in cfg.outlier_flags if c in df.columns},
        robust={
            c: robust_scale(summary.get(f"robust:{c}") or summary[f"fence:{c}"]) for c in cfg.robust if c in df.columns
        },
        standard={c: standard_scale(summary[f"standard:{c}"]) for c in cfg.standard if c in df.columns},
        levels=(
            {c: tuple(v) for c, v in levels.items()}
            if levels is not None
            else fit_levels(df, cfg.one_hot, cfg.missing_category)
        ),
        vocabularies={c: fit_vocabulary(df, c, cfg.missing_category) for c in cfg.one_hot_sparse if c in df.columns},
    )


# ---- the fitted numbers as tables -------------------------------------------


def fitted_tables(spark: SparkSession, fitted: Fitted) -> tuple[DataFrame, DataFrame]:
    """The fit as two small tables: numbers per column, and category levels in order."""
    numbers = [
        ("fence", c, f.n, f.q1, f.median, f.q3, f.lower, f.upper, None, None) for c, f in fitted.fences.items()
    ]
    for role, scales in (("robust", fitted.robust), ("standard", fitted.standard)):
        numbers += [(role, c, None, None, None, None, None, None, s.center, s.scale) for c, s in scales.items()]
    levels = [(c, i, level) for c, found in fitted.levels.items() for i, level in enumerate(found)]
    return spark.createDataFrame(numbers, NUMBERS_SCHEMA), spark.createDataFrame(levels, LEVELS_SCHEMA)


def save_fitted(spark: SparkSession, fitted: Fitted, path: str) -> None:
    numbers, levels = fitted_tables(spark, fitted)
    numbers.coalesce(1).write.mode("overwrite").parquet(f"{path}/numbers")
    levels.coalesce(1).write.mode("overwrite").parquet(f"{path}/levels")
    sparse = []
    for i, (c, v) in enumerate(fitted.vocabularies.items()):
        spark.read.schema(VOCABULARY_SCHEMA).parquet(v.path).write.mode("overwrite").parquet(f"{path}/vocabulary_{i}")
        sparse.append((c, f"{path}/vocabulary_{i}", v.size))
    spark.createDataFrame(sparse, VOCABULARIES_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocabularies")


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    """Read a saved fit; its size is the number of columns and dense levels, not of rows."""
    fences, scales = {}, {"robust": {}, "standard": {}}
    for r in spark.read.schema(NUMBERS_SCHEMA).parquet(f"{path}/numbers").collect():
        if r["role"] == "fence":
            fences[r["column_name"]] = Fence(r["n"], r["q1"], r["median"], r["q3"], r["lower"], r["upper"])
        else:
            scales[r["role"]][r["column_name"]] = Scale(r["center"], r["scale"])
    levels: dict[str, list[str]] = {}
    for r in sorted(spark.read.schema(LEVELS_SCHEMA).parquet(f"{path}/levels").collect(), key=lambda r: r["position"]):
        levels.setdefault(r["column_name"], []).append(r["level"])
    sparse = spark.read.schema(VOCABULARIES_SCHEMA).parquet(f"{path}/vocabularies").collect()
    vocabularies = {r["column_name"]: Vocabulary(r["path"], r["size"]) for r in sparse}
    return Fitted(fences, scales["robust"], scales["standard"], {c: tuple(v) for c, v in levels.items()}, vocabularies)


# ---- apply -------------------------------------------------------------------


def drop_leakage(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    return df.drop(*cfg.leakage)


def target(df: DataFrame, cfg: PrepConfig) -> Column:
    """The target as an int. A missing column fails now, a missing value when it is read."""
    if cfg.target not in df.columns:
        raise ValueError(f"target column {cfg.target!r} not found")
    message = sql.text(f"target column '{cfg.target}' holds a missing value")
    return F.expr(f"coalesce(CAST({without_nan_sql(cfg.target)} AS INT), CAST(raise_error({message}) AS INT))")


def drop_missing_target(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """Opt-in alternative to failing on a missing target."""
    return df.filter(F.col(cfg.target).isNotNull())


def scaled(column: str, by: Scale) -> Column:
    if by.center is None or by.scale is None:
        return F.lit(None).cast("double")
    return F.expr(f"({sql.name(column)} - {sql.number(by.center)}) / {sql.number(by.scale)}")


def one_hot(column: str, levels: Sequence[str], missing: str) -> dict[str, Column]:
    """One 0/1 column per known level of a cleaned column; an unknown level is 0 in all of them."""
    text = f"coalesce({sql.name(column)}, {sql.text(missing)})"
    return {f"{column}_{level}": F.expr(f"CAST({text} = {sql.text(level)} AS DOUBLE)") for level in levels}


def one_hot_places(df: DataFrame, column: str, vocabulary: Vocabulary, missing: str, name: str | None = None) -> DataFrame:
    """``df`` with the one-hot vector of a cleaned column as a sparse one: its size and the place of its 1.

    An unknown level has no place, which is an empty vector. Levels meet the rows in joins: the hot
    ones, of which there are few, go to the rows; rows of all others are shuffled by level.
    """
    spark = df.sparkSession
    text = F.expr(f"coalesce({sql.name(column)}, {sql.text(missing)})")
    levels = spark.read.schema(VOCABULARY_SCHEMA).parquet(vocabulary.path)
    hot = levels.filter("hot").select(F.col("level").alias("_level"), F.col("place").alias("_hot"))
    cold = levels.filter("NOT hot").select(F.lit(False).alias("_met"), F.col("level").alias("_level"), F.col("place").alias("_cold"))
    # fewer than HOT_SHARE rows are broadcast
    met = df.withColumn("_level", text).join(F.broadcast(hot), "_level", "left").withColumn("_met", F.col("_hot").isNotNull())
    # rows that have met their level go anywhere
    spread = F.when(F.col("_met"), F.monotonically_increasing_id().cast("string")).otherwise(F.col("_level"))
    joined = met.withColumn("_level", spread).join(cold, ["_met", "_level"], "left")
    vector = F.struct(F.lit(vocabulary.size).cast("bigint").alias("size"), F.coalesce("_hot", "_cold").alias("place"))
    return joined.withColumn(name or f"{column}_hot", vector).drop("_level", "_met", "_hot", "_cold")


def ordinal(column: str, levels: Sequence[str]) -> Column:
    """Place of the level in the declared order; -1 for any other value."""
    return F.expr(f"coalesce({place_sql(sql.name(column), levels, start=0)}, -1D)")


def cyclic_number(column: str, period: int) -> dict[str, Column]:
    sine, cosine = cyclic(sql.name(column), period)
    return {f"{column}_sin": sine, f"{column}_cos": cosine}


def cyclic_name(column: str, names: Sequence[str]) -> dict[str, Column]:
    """The place of a name in its cycle; an unknown name is missing."""
    sine, cosine = cyclic(place_sql(f"lower({strip_sql(column)})", names, start=1), len(names))
    return {f"{column}_sin": sine, f"{column}_cos": cosine}


def passthrough(df: DataFrame, cfg: PrepConfig) -> dict[str, Column]:
    """Flags, cyclic pairs and yes/no columns, in this order, as doubles."""
    columns: dict[str, Column] = {f: F.expr(f"CAST({sql.name(f)} AS DOUBLE)") for f in cfg.flags if f in df.columns}
    for c, period in cfg.cyclic_numbers.items():
        if c in df.columns:
            columns.update(cyclic_number(c, period))
    for c, names in cfg.cyclic_names.items():
        if c in df.columns:
            columns.update(cyclic_name(c, names))
    columns.update({b: F.expr(f"CAST({sql.name(b)} AS DOUBLE)") for b in cfg.binary_features if b in df.columns})
    return columns


def feature_columns(df: DataFrame, cfg: PrepConfig, fitted: Fitted) -> dict[str, Column]:
    """Name -> expression of every feature in its final order; absent columns are skipped."""
    columns: dict[str, Column] = {}
    for c in cfg.robust:
        if c in df.columns:
            columns[c] = scaled(c, fitted.robust[c])
    for c in cfg.standard:
        if c in df.columns:
            columns[c] = scaled(c, fitted.standard[c])
    for c in cfg.one_hot:
        if c in df.columns:
            columns.update(one_hot(c, fitted.levels[c], cfg.missing_category))
    for c, levels in cfg.ordinal.items():
        if c in df.columns:
            columns[c] = ordinal(c, levels)
    columns.update(passthrough(df, cfg))
    return columns


def transform(df: DataFrame, cfg: PrepConfig, fitted: Fitted) -> DataFrame:
    """Cleaned table -> key, features, target ``y``. Rows without a target fail the job."""
    y = target(df, cfg)
    columns = feature_columns(drop_leakage(df, cfg), cfg, fitted)
    keys = [F.col(k) for k in cfg.key if k in df.columns]
    sparse = [c for c in cfg.one_hot_sparse if c in df.columns]
    for c in sparse:
        df = one_hot_places(df, c, fitted.vocabularies[c], cfg.missing_category)
    return df.select(*keys, *[c.alias(name) for name, c in columns.items()], *[F.col(sql.name(f"{c}_hot")) for c in sparse], y.alias("y"))


def feature_names(features: DataFrame, cfg: PrepConfig) -> list[str]:
    return [c for c in features.columns if c not in cfg.key and c != "y"]


def as_vector(features: DataFrame, cfg: PrepConfig, output: str = "features") -> DataFrame:
    """The features as one vector column, for consumers of ``pyspark.ml``."""
    from pyspark.ml.feature import VectorAssembler

    names = feature_names(features, cfg)
    assembler = VectorAssembler(inputCols=names, outputCol=output, handleInvalid="keep")
    return assembler.transform(features).select(*[k for k in cfg.key if k in features.columns], output, "y")
