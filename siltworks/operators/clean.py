"""Cleaning: categories, yes/no columns and business flags.

``fit_fences`` reads the table; everything else is a projection that stays inside
one scan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from siltworks.config import PrepConfig
from siltworks.functions import sql
from siltworks.functions.scalars import canonical_text, strip_sql, without_nan_sql, yes_no
from siltworks.operators.quantiles import NumericSummary, approximate_quantiles, summarize


@dataclass(frozen=True)
class Fence:
    """Quartiles of a column and the limits beyond which a value is an outlier."""

    n: int
    q1: float | None
    median: float | None
    q3: float | None
    lower: float | None
    upper: float | None


def normalize_categories(df: DataFrame, columns: Sequence[str], missing: str) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: canonical_text(c, missing) for c in present})


def map_binary(df: DataFrame, columns: Sequence[str], yes: Sequence[str], no: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: yes_no(c, yes, no) for c in present})


def unmappable_census(df: DataFrame, cfg: PrepConfig, show: int = 5) -> DataFrame:
    """Per yes/no column: ones, zeros, values that map to neither, and the first of those.

    Tokens are counted before the shuffle, so a token that fills a third of the table
    is one row per task; only ``show`` tokens per column are ever put in a list.
    """
    columns = [c for c in cfg.binary if c in df.columns]
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            yes_no(c, cfg.yes_tokens, cfg.no_tokens).alias("mapped"),
            F.expr(f"lower({strip_sql(c)})").alias("token"),
        )
        for c in columns
    ]
    tokens = (
        df.select(F.inline(F.array(*entries)))
        .groupBy("column_name", "mapped", "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    unmapped = F.col("token").isNotNull() & F.col("mapped").isNull()
    counts = tokens.groupBy("column_name").agg(
        F.expr("coalesce(sum(n) FILTER (WHERE mapped = 1), 0L)").alias("n_one"),
        F.expr("coalesce(sum(n) FILTER (WHERE mapped = 0), 0L)").alias("n_zero"),
        F.coalesce(F.sum(F.when(unmapped, F.col("n"))), F.lit(0)).alias("n_unmappable"),
    )
    by_token = W.partitionBy("column_name").orderBy("token")
    shown = (
        tokens.filter(unmapped)
        .select("column_name", "token", F.row_number().over(by_token).alias("place"))
        .filter(F.col("place") <= show)
        .groupBy("column_name")
        .agg(F.array_join(F.array_sort(F.collect_list("token")), "|").alias("offenders"))
    )
    return counts.join(shown, "column_name", "left").withColumn("offenders", F.coalesce("offenders", F.lit("")))


def negative_flag(column: str) -> Column:
    return F.expr(f"coalesce(CAST({sql.name(column)} < 0 AS INT), 0)")


def sentinel_flag(column: str, sentinel: float) -> Column:
    return F.expr(f"coalesce(CAST({sql.name(column)} = {sql.number(sentinel)} AS INT), 0)")


def fence_columns(df: DataFrame, cfg: PrepConfig) -> dict[str, str]:
    """The values that the fences are fitted on: special values are left out."""
    chosen = {}
    for c in cfg.outlier_flags:
        if c in df.columns:
            value, special = without_nan_sql(c), cfg.outlier_excluded.get(c, ())
            chosen[c] = f"CASE WHEN {value} NOT IN ({sql.numbers(special)}) THEN {value} END" if special else value
    return chosen


def fence(summary: NumericSummary, width: float) -> Fence:
    """The limits; an end that infinite quartiles leave undefined is no limit."""
    q1, median, q3 = (summary.quantiles[p] for p in (0.25, 0.5, 0.75))
    lower = upper = None
    if q1 is not None and q3 is not None:
        reach = width * (q3 - q1)
        lower, upper = _defined(q1 - reach), _defined(q3 + reach)
    return Fence(summary.n, q1, median, q3, lower, upper)


def _defined(value: float) -> float | None:
    return None if math.isnan(value) else value


def fit_fences(df: DataFrame, cfg: PrepConfig, accuracy: int | None = None) -> dict[str, Fence]:
    """Outlier limits of all flagged columns; exact unless an ``accuracy`` is given."""
    columns = fence_columns(df, cfg)
    if accuracy is not None:
        summary = approximate_quantiles(df, columns, accuracy=accuracy)
    else:
        summary = summarize(df, columns)
    return {c: fence(s, cfg.fence_width) for c, s in summary.items()}


def outlier_flag(column: str, limits: Fence, excluded: Sequence[float] = ()) -> Column:
    """1 beyond the limits; 0 for missing and excluded values, or if nothing could be fitted."""
    c, sides = sql.name(column), []
    if limits.lower is not None:
        sides.append(f"{c} < {sql.number(limits.lower)}")
    if limits.upper is not None:
        sides.append(f"{c} > {sql.number(limits.upper)}")
    if not sides:
        return F.lit(0)
    beyond = f"({' OR '.join(sides)})"
    if excluded:
        beyond += f" AND {c} NOT IN ({sql.numbers(excluded)})"
    return F.expr(f"coalesce(CAST({beyond} AS INT), 0)")


def add_flags(df: DataFrame, cfg: PrepConfig, fences: Mapping[str, Fence]) -> DataFrame:
    """All business flags whose source column is present, in the declared order."""
    flags: dict[str, Column] = {}
    for c, name in cfg.negative_flags.items():
        if c in df.columns:
            flags[name] = negative_flag(c)
    for c, (name, sentinel) in cfg.sentinel_flags.items():
        if c in df.columns:
            flags[name] = sentinel_flag(c, sentinel)
    for c, name in cfg.outlier_flags.items():
        if c in df.columns:
            flags[name] = outlier_flag(c, fences[c], cfg.outlier_excluded.get(c, ()))
    return df.withColumns({name: flags[name] for name in cfg.flags if name in flags})


def clean(df: DataFrame, cfg: PrepConfig, fences: Mapping[str, Fence] | None = None) -> DataFrame:
    """The whole cleaning step on a typed table. Fits the fences only if none are given."""
    if fences is None:
        fences = fit_fences(df, cfg)
    tidy = normalize_categories(df, cfg.categorical, cfg.missing_category)
    return add_flags(map_binary(tidy, cfg.binary, cfg.yes_tokens, cfg.no_tokens), cfg, fences)


def fence_rows(fences: Mapping[str, Fence]) -> list[tuple]:
    return [(c, f.n, f.q1, f.median, f.q3, f.lower, f.upper) for c, f in fences.items()]
