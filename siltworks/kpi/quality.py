"""Quality: nulls, outliers, class balance, valid columns, and the score they add up to.

All figures may be taken over a whole table or per group (``by``), for example per
delivery batch. Each table is aggregated once to one row per group, and only these rows
are put together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, functions as F

from siltworks.config import PrepConfig, Thresholds
from siltworks.functions import sql
from siltworks.functions.lights import light, penalty, score_light
from siltworks.functions.scalars import percent
from siltworks.operators.features import feature_names
from siltworks.operators.profile import column_profile, invalid_columns, numeric_columns, total_nulls
from siltworks.operators.validate import semantic_aggregates, structural_of


# what the figures read; null where a table is absent
FACTS = {
    "raw_rows": "bigint",
    "raw_cells": "bigint",
    "raw_nulls": "bigint",
    "clean_rows": "bigint",
    "clean_cells": "bigint",
    "clean_nulls": "bigint",
    "feature_rows": "bigint",
    "profile": "array<struct<column_name: string, is_numeric: boolean, n_values: bigint, n_null: bigint, "
    "is_constant: boolean, spread: double>>",
    "n_class_0": "bigint",
    "n_class_1": "bigint",
}

#: keys are told by their number and the sums of the four parts of their hashes, which do not depend on the order of rows
HASH_PARTS = 4
NO_MORE: Mapping[str, Column] = MappingProxyType({})


def key_digest(keys: Sequence[str]) -> Column:
    """Aggregate: equal for tables with the same keys, each equally often. Others agree by chance once in 2 ** 64 cases.

    The sums stay within 64 bits for 2 ** 47 rows of a group.
    """
    h = F.xxhash64(*keys, *[F.col(k).isNull() for k in keys])
    parts = [F.coalesce(F.sum(F.shiftrightunsigned(h, 16 * p).bitwiseAND(F.lit(0xFFFF))), F.lit(0)) for p in range(HASH_PARTS)]
    return F.array(F.count(F.lit(1)), *parts)


def _data_columns(df: DataFrame, cfg: PrepConfig, by: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in cfg.key and c not in by]


def _null_cells(columns: Sequence[str]) -> Column:
    counted = " + ".join(["0L", *[f"count({sql.name(c)})" for c in columns]])
    return F.expr(f"count(1) * {len(columns)} - ({counted})")


def raw_facts(raw: DataFrame, cfg: PrepConfig, by: Sequence[str] = ()) -> DataFrame:
    columns = _data_columns(raw, cfg, by)
    return raw.groupBy(*by).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        (F.count(F.lit(1)) * len(columns)).alias("raw_cells"),
        _null_cells(columns).alias("raw_nulls"),
    )


def clean_facts(clean: DataFrame, cfg: PrepConfig, by: Sequence[str] = (), more: Mapping[str, Column] = NO_MORE) -> DataFrame:
    """Rows, null cells and marked rows per flag of the cleaned table, and ``more`` aggregates of it by name."""
    columns = _data_columns(clean, cfg, by)
    marked = [F.sum(f).alias(f"n_{f}") for f in cfg.flags if f in clean.columns]
    return clean.groupBy(*by).agg(
        F.count(F.lit(1)).alias("clean_rows"),
        (F.count(F.lit(1)) * len(columns)).alias("clean_cells"),
        _null_cells(columns).alias("clean_nulls"),
        *marked,
        *[c.alias(name) for name, c in more.items()],
    )


def feature_facts(features: DataFrame, cfg: PrepConfig, by: Sequence[str] = (), more: Mapping[str, Column] = NO_MORE) -> DataFrame:
    """Rows, column profile and class counts of the features, and ``more`` aggregates of them by name."""
    names = [c for c in feature_names(features, cfg) if c not in by]
    classes = {f"n_class_{k}": F.count_if(F.col("y") == k) for k in (0, 1)}
    return column_profile(features, names, by, more={**classes, **more}).withColumnRenamed("n_rows", "feature_rows")


def combine(facts: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """One row per group from tables that hold one row per group each, without a join.

    So a table without rows in a group, or without any rows, leaves nulls there.
    """
    together = facts[0]
    for more in facts[1:]:
        together = together.unionByName(more, allowMissingColumns=True)
    values = [c for c in together.columns if c not in by]
    return together.groupBy(*by).agg(*[F.any_value(c, ignoreNulls=True).alias(c) for c in values])


# ---- figures as column expressions over the combined facts -----------------


def null_figures(n_features: int, limits: Thresholds) -> dict[str, Column]:
    x_cells = F.col("feature_rows") * n_features
    exact = F.try_divide(total_nulls(F.col("profile")).cast("double"), x_cells.cast("double")) * 100
    return {
        "raw_null_pct": percent(F.col("raw_nulls"), F.col("raw_cells"), 4),
        "clean_null_pct": percent(F.col("clean_nulls"), F.col("clean_cells"), 4),
        "x_null_pct": F.round(exact, 4),
        "null_light": light(exact, limits.max_null_pct_features, limits.max_null_pct_clean, lower_is_better=True),
    }


def outlier_light(pct: Column, limits: Thresholds) -> Column:
    return light(pct, limits.green_outlier_pct, limits.max_outlier_pct, lower_is_better=True)


def class_figures(limits: Thresholds) -> dict[str, Column]:
    """Counts, shares, imbalance and light; a class that does not occur is no minority."""
    n0, n1 = F.col("n_class_0"), F.col("n_class_1")
    total = n0 + n1
    smallest = F.least(F.when(n0 > 0, n0), F.when(n1 > 0, n1))
    largest = F.greatest(n0, n1)
    share = F.try_divide(smallest.cast("double"), total.cast("double")) * 100
    return {
        "class_0_pct": F.coalesce(percent(n0, total, 2), F.lit(0.0)),
        "class_1_pct": F.coalesce(percent(n1, total, 2), F.lit(0.0)),
        "imbalance_ratio": F.round(F.try_divide(largest.cast("double"), smallest.cast("double")), 2),
        "class_light": light(share, limits.min_minority_pct, limits.yellow_minority_pct),
    }


def column_figures(n_features: int, limits: Thresholds) -> dict[str, Column]:
    """Share of the columns without nulls and with variance."""
    if n_features == 0:
        valid = F.lit(0.0)
    else:
        n_valid = F.lit(n_features) - F.size(invalid_columns(F.col("profile")))
        valid = percent(n_valid, F.lit(n_features), 2)
    return {
        "valid_columns_pct": valid,
        "columns_light": light(valid, limits.min_valid_columns_pct, limits.yellow_valid_columns_pct),
    }


def missing_pct(raw: DataFrame, clean: DataFrame, features: DataFrame, cfg: PrepConfig, limits: Thresholds, by: Sequence[str] = ()) -> DataFrame:
    """Null share of the raw table, the cleaned table and the features, with the light of the last."""
    names = [c for c in feature_names(features, cfg) if c not in by]
    x = features.groupBy(*by).agg(F.count(F.lit(1)).alias("feature_rows"), _null_cells(names).alias("x_nulls"))
    facts = combine([raw_facts(raw, cfg, by), clean_facts(clean, cfg, by).drop(*[f"n_{f}" for f in cfg.flags]), x], by)
    exact = F.try_divide(F.col("x_nulls").cast("double"), (F.col("feature_rows") * len(names)).cast("double")) * 100
    nulls = light(exact, limits.max_null_pct_features, limits.max_null_pct_clean, lower_is_better=True)
    return facts.select(
        *by,
        percent(F.col("raw_nulls"), F.col("raw_cells"), 4).alias("raw_null_pct"),
        percent(F.col("clean_nulls"), F.col("clean_cells"), 4).alias("clean_null_pct"),
        F.round(exact, 4).alias("x_null_pct"),
        nulls.alias("light"),
        penalty(nulls, limits.null_penalty).alias("penalty"),
    )


def _marked(clean: DataFrame, named_flags: dict[str, str], by: Sequence[str]) -> DataFrame:
    """Rows (group, name, marked rows, all rows) for the flags that are present."""
    rows = [
        f"named_struct('column_name', {sql.text(name)}, 'n', sum({sql.name(flag)}), 'n_rows', count(1))"
        for name, flag in named_flags.items()
        if flag in clean.columns
    ]
    return clean.groupBy(*by).agg(F.expr(f"array({', '.join(rows)})").alias("marked")).select(*by, F.inline("marked"))


def outlier_pct(clean: DataFrame, cfg: PrepConfig, limits: Thresholds, by: Sequence[str] = ()) -> DataFrame:
    """Outliers per flagged column: count, share, light and penalty."""
    share = percent(F.col("n"), F.col("n_rows"), 2)
    return _marked(clean, dict(cfg.outlier_flags), by).select(
        *by,
        "column_name",
        F.coalesce("n", F.lit(0)).alias("n"),
        share.alias("pct"),
        outlier_light(share, limits).alias("light"),
        penalty(outlier_light(share, limits), limits.outlier_penalty).alias("penalty"),
    )


def flag_activation(clean: DataFrame, cfg: PrepConfig, by: Sequence[str] = ()) -> DataFrame:
    """Marked rows per business flag: count and share."""
    return _marked(clean, {f: f for f in cfg.flags}, by).select(
        *by,
        "column_name",
        F.coalesce("n", F.lit(0)).alias("n"),
        percent(F.col("n"), F.col("n_rows"), 2).alias("pct"),
    )


def class_balance(features: DataFrame, limits: Thresholds, by: Sequence[str] = ()) -> DataFrame:
    counted = features.groupBy(*by).agg(
        F.count_if(F.col("y") == 0).alias("n_class_0"), F.count_if(F.col("y") == 1).alias("n_class_1")
    )
    figures = counted.withColumns(class_figures(limits)).withColumnRenamed("class_light", "light")
    return figures.withColumn("penalty", penalty(F.col("light"), limits.balance_penalty))


def valid_columns(features: DataFrame, cfg: PrepConfig, limits: Thresholds, by: Sequence[str] = ()) -> DataFrame:
    names = [c for c in feature_names(features, cfg) if c not in by]
    profiled = column_profile(features, names, by)
    figures = column_figures(len(names), limits)
    return profiled.select(
        *by,
        F.lit(len(names)).alias("n_columns"),
        F.size(invalid_columns(F.col("profile"))).alias("n_invalid"),
        F.array_join(F.array_sort(invalid_columns(F.col("profile"))), ",").alias("invalid_columns"),
        figures["valid_columns_pct"].alias("valid_pct"),
        figures["columns_light"].alias("light"),
        penalty(figures["columns_light"], limits.columns_penalty).alias("penalty"),
    )


def quality(
    raw: DataFrame | None,
    clean: DataFrame | None,
    features: DataFrame | None,
    cfg: PrepConfig,
    limits: Thresholds,
    by: Sequence[str] = (),
    targets: DataFrame | None = None,
    details: bool = False,
    targets_in_clean: bool = False,
) -> DataFrame:
    """All quality figures, their penalties, the score and its light; one row per group.

    ``details`` adds what a report shows besides: class shares, the invalid columns, and
    outliers and marked rows by flag.

    ``features`` carries the target of each row, so both are aligned unless a separate
    table of ``targets`` is given to compare with, or the cleaned table holds the targets
    (``targets_in_clean``). Keys are compared by their digests, which the tables' own
    aggregations bring along; no key is shuffled. A table that a failed run did not get
    to write is ``None`` and scored like an empty one.
    """
    facts = table_facts(raw, clean, features, cfg, by, targets, targets_in_clean)
    return quality_of(facts, clean, features, cfg, limits, by, details)


def table_facts(
    raw: DataFrame | None,
    clean: DataFrame | None,
    features: DataFrame | None,
    cfg: PrepConfig,
    by: Sequence[str] = (),
    targets: DataFrame | None = None,
    targets_in_clean: bool = False,
    checked: Thresholds | None = None,
) -> DataFrame:
    """One row per group with all that the figures, and with limits (``checked``) the checks, read: one aggregation per table."""
    keys = list(dict.fromkeys([*cfg.key, *by]))
    of_clean: dict[str, Column] = {}
    of_features: dict[str, Column] = {}
    tables = [raw_facts(raw, cfg, by)] if raw is not None else []
    if features is not None and (targets is not None or targets_in_clean):
        of_features["feature_keys"] = key_digest(keys)
        if targets is not None:
            tables.append(targets.groupBy(*by).agg(key_digest(keys).alias("target_keys")))
        elif clean is not None:
            of_clean["target_keys"] = key_digest(keys)
    if checked is not None:
        found = semantic_aggregates(clean.columns, features.columns, cfg, checked)
        for name, into, checks in zip(("clean_checks", "feature_checks"), (of_clean, of_features), found):
            if checks is not None:
                into[name] = checks
    if clean is not None:
        tables.append(clean_facts(clean, cfg, by, of_clean))
    if features is not None:
        tables.append(feature_facts(features, cfg, by, of_features))
    if not tables:
        raise ValueError("a quality score needs at least one table")
    facts = combine(tables, by)
    absent = {c: kind for c, kind in FACTS.items() if c not in facts.columns}
    return facts.withColumns({c: F.lit(None).cast(kind) for c, kind in absent.items()})


def checks_of(facts: DataFrame, clean: DataFrame, features: DataFrame, cfg: PrepConfig, by: Sequence[str] = ()) -> DataFrame:
    """The structural and semantic checks of each group from its facts, which were taken with limits; the tables give their columns only."""
    names = [c for c in feature_names(features, cfg) if c not in by]
    # a group that a table lacks has no rows there
    rows = {"raw": "raw_rows", "clean": "clean_rows", "features": "feature_rows"}
    sides = facts.select(*by, *[F.coalesce(n, F.lit(0).cast("bigint")).alias(name) for name, n in rows.items()], "profile")
    checks = structural_of(sides, names, clean.columns, cfg, by)
    for name in ("clean_checks", "feature_checks"):
        if name in facts.columns:
            checks = checks.unionByName(facts.select(*by, F.inline(name)))
    return checks


def quality_of(
    facts: DataFrame,
    clean: DataFrame | None,
    features: DataFrame | None,
    cfg: PrepConfig,
    limits: Thresholds,
    by: Sequence[str] = (),
    details: bool = False,
) -> DataFrame:
    """The figures of :func:`quality` from the facts of the tables, which give their columns only."""
    names = [c for c in feature_names(features, cfg) if c not in by] if features is not None else []
    flags = {c: f for c, f in cfg.outlier_flags.items() if clean is not None and f in clean.columns}
    facts = facts.withColumns(
        {**null_figures(len(names), limits), **class_figures(limits), **column_figures(len(names), limits)}
    )
    outlier_points = sum(
        (
            penalty(outlier_light(percent(F.col(f"n_{f}"), F.col("clean_rows"), 2), limits), limits.outlier_penalty)
            for f in flags.values()
        ),
        F.lit(0),
    )
    all_numeric = features is None or set(names) <= numeric_columns(features)
    compared = "feature_keys" in facts.columns
    same_keys = F.col("feature_keys") == F.col("target_keys") if "target_keys" in facts.columns else F.lit(False)
    # a group that one of them lacks is not aligned
    aligned = F.coalesce(same_keys, F.lit(False)) if compared else F.lit(True)
    lost = (
        penalty(F.col("null_light"), limits.null_penalty)
        + outlier_points
        + penalty(F.col("class_light"), limits.balance_penalty)
        + penalty(F.col("columns_light"), limits.columns_penalty)
        + F.lit(0 if all_numeric else limits.types_penalty)
        + F.when(aligned, 0).otherwise(limits.alignment_penalty)
    )
    scored = facts.withColumns({"lost_points": lost, "quality_score": F.greatest(F.lit(0), F.lit(100) - lost)})
    return scored.select(
        *by,
        F.coalesce("feature_rows", F.lit(0)).alias("n_rows"),
        "raw_null_pct",
        "clean_null_pct",
        "x_null_pct",
        "null_light",
        "class_light",
        "valid_columns_pct",
        "columns_light",
        outlier_points.alias("outlier_penalty"),
        F.lit(all_numeric).alias("types_ok"),
        aligned.alias("aligned"),
        "lost_points",
        "quality_score",
        score_light(F.col("quality_score"), limits).alias("light"),
        *(_details(clean, cfg) if details else ()),
    )


def _details(clean: DataFrame | None, cfg: PrepConfig) -> list[Column]:
    present = [f for f in cfg.flags if clean is not None and f in clean.columns]
    shares = {f: percent(F.col(f"n_{f}"), F.col("clean_rows"), 2) for f in present}
    return [
        "class_0_pct",
        "class_1_pct",
        "imbalance_ratio",
        F.array_join(F.array_sort(invalid_columns(F.col("profile"))), ",").alias("invalid_columns"),
        *[shares[f].alias(f"outlier_pct_{c}") for c, f in cfg.outlier_flags.items() if f in shares],
        *[F.coalesce(f"n_{f}", F.lit(0)).alias(f"n_{f}") for f in present],
        *[shares[f].alias(f"pct_{f}") for f in present],
    ]
