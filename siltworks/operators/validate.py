"""Structural and semantic validation as tables of checks.

A check is a row ``(scope, check_name, column_name, value, detail, severity, ok)``. Each
table under test is scanned once, whatever the number of checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siltworks.config import PrepConfig, Thresholds
from siltworks.functions import sql
from siltworks.operators.features import feature_names
from siltworks.operators.profile import column_profile

ERROR, WARNING, OK, INFO = "ERROR", "WARNING", "OK", "INFO"


def _check(
    scope: str, name: str, value: str, ok: str, severity: str, column: str = "CAST(NULL AS STRING)", detail: str = "''"
) -> str:
    """One check as a struct; ``value``, ``ok``, ``column`` and ``detail`` are SQL."""
    return (
        f"named_struct('scope', '{scope}', 'check_name', '{name}', 'column_name', {column}, "
        f"'value', CAST({value} AS DOUBLE), 'detail', {detail}, 'severity', '{severity}', 'ok', coalesce({ok}, false))"
    )


def _share(part: str, whole: str) -> str:
    return f"try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE)) * 100"


def _counted(df: DataFrame, scope: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.lit(scope).alias("scope"))


def structural_checks(
    raw: DataFrame, clean: DataFrame, features: DataFrame, cfg: PrepConfig, by: Sequence[str] = ()
) -> DataFrame:
    """Row counts, nulls, types, flags, constant and empty columns of a prepared table.

    ``features`` may hold any columns next to the key and ``y``; they are all checked. With
    ``by``, columns that all three tables have, every group has checks of its own.
    """
    names = [n for n in feature_names(features, cfg) if n not in by]
    profiled = column_profile(features, names, by).withColumn("scope", F.lit("features"))
    sides = (
        _counted(raw, "raw", by)
        .unionByName(_counted(clean, "clean", by))
        .unionByName(profiled, allowMissingColumns=True)
        .groupBy(*by)
        .agg(
            # a group that a table lacks has no rows there
            *[F.expr(f"coalesce(max(CASE WHEN scope = '{s}' THEN n_rows END), 0L) AS {s}") for s in ("raw", "clean", "features")],
            F.expr("any_value(profile, true) AS profile"),
        )
    )
    return structural_of(sides, names, clean.columns, cfg, by)


def structural_of(
    sides: DataFrame, names: Sequence[str], clean_columns: Sequence[str], cfg: PrepConfig, by: Sequence[str] = ()
) -> DataFrame:
    """The structural checks of groups whose rows are counted (``raw``, ``clean``, ``features``) and whose columns are profiled."""
    sides = sides.selectExpr(
        "*",
        "aggregate(profile, 0L, (total, c) -> total + c.n_null) AS nulls",
        f"features * {len(names)} AS cells",
        "raw = clean AND clean = features AS equal_rows",
    )
    whole_table = [
        _check(
            "structural", "row_counts", "features", "equal_rows", ERROR,
            detail="concat('raw=', raw, ' clean=', clean, ' features=', features)",
        ),
        _check("structural", "null_cells", "nulls", "nulls = 0", ERROR),
        # the share tells the same finding again, so it is no error of its own
        _check("structural", "null_pct", f"round({_share('nulls', 'cells')}, 4)", "nulls = 0", INFO),
    ]
    for flag in cfg.flags:
        there = flag in clean_columns
        whole_table.append(
            _check("structural", "flag_present", str(int(there)), str(there).lower(), INFO, column=sql.text(flag))
        )
    each_column = ", ".join(
        [
            _check("structural", "zero_variance", "round(c.spread, 6)", "NOT c.is_constant", INFO, "c.column_name"),
            _check("structural", "numeric_type", "c.n_values", "c.is_numeric", ERROR, "c.column_name"),
            _check("structural", "empty_column", "c.n_values", "c.n_values > 0", ERROR, "c.column_name"),
        ]
    )
    # a group without features has no columns to check
    whole = f"array({', '.join(whole_table)})"
    columns = f"coalesce(flatten(transform(profile, c -> array({each_column}))), slice({whole}, 1, 0))"
    return sides.selectExpr(*map(sql.name, by), f"inline(concat({whole}, {columns}))")


def flag_checks(clean: DataFrame, cfg: PrepConfig) -> DataFrame:
    """Which declared flags the cleaned table has, and how many rows each one marks."""
    rows = []
    for flag in cfg.flags:
        there = flag in clean.columns
        n_marked = f"sum({sql.name(flag)})" if there else "CAST(NULL AS BIGINT)"
        rows.append(f"named_struct('column_name', {sql.text(flag)}, 'ok', {str(there).lower()}, 'n_marked', {n_marked})")
    return clean.agg(F.expr(f"array({', '.join(rows)})").alias("flags")).select(F.inline("flags"))


def semantic_checks(
    clean: DataFrame, features: DataFrame, cfg: PrepConfig, limits: Thresholds, by: Sequence[str] = ()
) -> DataFrame:
    """Sentinel flags, cyclic identity, double debt and the minority class, of each group of ``by``."""
    found = semantic_aggregates(clean.columns, features.columns, cfg, limits)
    tables = [
        df.groupBy(*by).agg(checks.alias("checks")).select(*by, F.inline("checks"))
        for df, checks in zip((clean, features), found)
        if checks is not None
    ]
    if not tables:
        raise ValueError("the tables hold none of the columns that the semantic checks look at")
    checks = tables[0]
    for more in tables[1:]:
        checks = checks.unionByName(more)
    return checks


def semantic_aggregates(
    clean_columns: Sequence[str], feature_columns: Sequence[str], cfg: PrepConfig, limits: Thresholds
) -> tuple[Column | None, Column | None]:
    """Aggregates of the cleaned table and of the features: the semantic checks of each as an array, none without their columns."""
    clean_facts: list[str] = []
    for c, (flag, sentinel) in cfg.sentinel_flags.items():
        if c in clean_columns and flag in clean_columns:
            n_values = f"count_if({sql.name(c)} = {sql.number(sentinel)})"
            n_flags = f"coalesce(sum({sql.name(flag)}), 0L)"
            detail = f"concat('values=', {n_values}, ' flags=', {n_flags})"
            clean_facts.append(
                _check("semantic", "sentinel_flag", n_flags, f"{n_values} = {n_flags}", ERROR, sql.text(c), detail)
            )
    if set(cfg.debt_columns) <= set(clean_columns):
        owed = " AND ".join(f"{sql.name(c)} = 1" for c in cfg.debt_columns)
        both = _share(f"count_if({owed})", "count(1)")
        clean_facts.append(_check("semantic", "double_debt_pct", f"round({both}, 2)", "true", INFO))
    if cfg.target in clean_columns:
        zeros, ones = (f"count_if({sql.name(cfg.target)} = {y})" for y in (0, 1))
        # only classes that occur count as the minority
        share = _share(f"least(nullif({zeros}, 0L), nullif({ones}, 0L))", f"({zeros} + {ones})")
        ok = f"{share} >= {sql.number(limits.min_minority_pct)}"
        clean_facts.append(
            _check("semantic", "minority_class_pct", f"round({share}, 2)", ok, WARNING, sql.text(cfg.target))
        )
    feature_facts: list[str] = []
    for c in cfg.cyclic:
        if {f"{c}_sin", f"{c}_cos"} <= set(feature_columns):
            sine, cosine = sql.name(f"{c}_sin"), sql.name(f"{c}_cos")
            broken = f"count_if({sine} * {sine} + {cosine} * {cosine} < {sql.number(limits.min_cyclic_identity)})"
            feature_facts.append(_check("semantic", "cyclic_identity", broken, f"{broken} = 0", WARNING, sql.text(c)))
    clean_checks, feature_checks = (F.expr(f"array({', '.join(facts)})") if facts else None for facts in (clean_facts, feature_facts))
    return clean_checks, feature_checks


def status_by_scope(checks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ERROR if any error check failed, else WARNING if any warning check failed, else OK; for each group of ``by``."""
    failed = ~F.col("ok")
    errors = F.count_if(failed & (F.col("severity") == ERROR))
    warnings = F.count_if(failed & (F.col("severity") == WARNING))
    return checks.groupBy(*by, "scope").agg(
        F.when(errors > 0, ERROR).when(warnings > 0, WARNING).otherwise(OK).alias("status"),
        errors.alias("n_errors"),
        warnings.alias("n_warnings"),
    )


def pipeline_status(raised: Column, structural: Column, semantic: Column) -> Column:
    """Outcome of a run: an exception is an error, a failed validation a warning."""
    return (
        F.when(F.coalesce(raised, F.lit(False)), "error")
        .when((structural == ERROR) | (semantic == ERROR), "warning")
        .otherwise("success")
    )


def verdicts(checks: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group with the columns ``structural`` and ``semantic``."""
    statuses = [F.max(F.when(F.col("scope") == s, F.col("status"))).alias(s) for s in ("structural", "semantic")]
    return status_by_scope(checks, by).groupBy(*by).agg(*statuses)
